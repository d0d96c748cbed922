"""Relational operators, filings, graphs, sources and incremental runs on small fixtures."""

import json
import os
import time
import zipfile

import pytest
from pyspark.sql import Observation
from pyspark.sql import functions as F

from filigree import catalog
from filigree.operators import forms, lookup, prose, reshape, scope
from filigree.plans import blueprint, tables
from filigree.sources import archive, datasets, files, sinks
from filigree.streaming import landing, refresh


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def test_slice_and_buckets(spark):
    f = spark.createDataFrame([("1", "4", "2024-01-01"), ("1", "4/A", "2024-01-01"), ("2", "4", "20x4"), ("1", "4", "2019-01-01")], "cik string, form string, filed string")
    assert f.where(scope.in_slice(F.col("cik"), F.col("form"), F.col("filed"), ["1"], ["4"], (2020, 2024))).count() == 1
    assert f.where(scope.in_slice(F.col("cik"), F.col("form"), F.col("filed"))).count() == 4
    assert scope.resolve_buckets(None)[0] == scope.LEAN
    assert scope.resolve_buckets(["10-K", "4", "4/A", "ARS"]) == (["form4", "form10k"], ["ARS"])


def test_licence_keys(spark):
    """The petroleum-registry joins: keys in file order, handed to children; parents by name."""
    parent = spark.createDataFrame([(0, "g-1", "PL001"), (1, "g-2", "PL002")], "o int, guid string, name string")
    child = spark.createDataFrame([("g-1", "A"), ("g-2", "B"), ("g-1", "C"), ("g-9", "D")], "guid string, who string")
    keyed = lookup.sequential_key(parent, ["o"], "ptl_id")
    assert [r.ptl_id for r in keyed.orderBy("o").collect()] == [1, 2]
    assert {r.who: r.ptl_id for r in lookup.propagate_key(keyed, child, "guid", "ptl_id").collect()} == {"A": 1, "B": 2, "C": 1, "D": None}
    chrono = spark.createDataFrame([("100", "TOP", ""), ("200", "MID", "TOP"), ("300", "LOW", "MID")], "id string, name string, parent string")
    assert {r.id: r.p for r in lookup.parent_key(chrono, "id", "name", "parent", "p").collect()} == {"100": None, "200": "100", "300": "200"}


def test_lookup_last_wins(spark):
    dim = spark.createDataFrame([(1, "a", "x"), (2, "a", "y"), (3, "b", ""), (4, "", "z")], "o int, k string, v string")
    got = lookup.lookup(spark.createDataFrame([("a",), ("b",), ("",)], "n string"), dim, "n", "k", "v", "o", "f")
    assert rows(got) == [("", None), ("a", "y"), ("b", None)] and lookup.unmatched(got, "f").first()[0] == 2


@pytest.mark.parametrize("parts", ["2", "7"])
def test_partitions_do_not_matter(spark, parts):
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", parts)
    try:
        df = spark.range(500).select((F.col("id") % 17).alias("k"), "id")
        assert rows(lookup.first_wins(df, ["k"], ["id"])) == sorted(((k, k) for k in range(17)), key=str)
        assert rows(lookup.sequential_key(df, ["k", "id"], "n").agg(F.min("n"), F.max("n"), F.countDistinct("n"))) == [(1, 500, 500)]
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)


FORM4 = """<ownershipDocument><documentType>4</documentType><issuer><issuerCik>0000660412</issuerCik><issuerName>ELI&#32;LILLY &amp; Co</issuerName></issuer>
<reportingOwner><reportingOwnerId><rptOwnerCik>0000000007</rptOwnerCik></reportingOwnerId></reportingOwner>
<reportingOwner><reportingOwnerId><rptOwnerCik>0000777123</rptOwnerCik></reportingOwnerId><reportingOwnerRelationship><isOfficer>1</isOfficer><officerTitle>CEO</officerTitle></reportingOwnerRelationship></reportingOwner>
<nonDerivativeTable><nonDerivativeTransaction><transactionAmounts><transactionShares><value>100</value></transactionShares><transactionPricePerShare><value>2204750</value><footnoteId id="F2"/></transactionPricePerShare><transactionAcquiredDisposedCode><value>D</value></transactionAcquiredDisposedCode></transactionAmounts></nonDerivativeTransaction></nonDerivativeTable>
<derivativeTable><derivativeTransaction><transactionAmounts><transactionShares><value>5</value></transactionShares><transactionAcquiredDisposedCode><value>A</value></transactionAcquiredDisposedCode></transactionAmounts></derivativeTransaction></derivativeTable>
<footnotes><footnote id="F2">Prices ranging from $2,204.00 to $2,205.50, inclusive.</footnote></footnotes></ownershipDocument>"""


def test_form4(spark):
    docs = spark.createDataFrame([(FORM4,), ("<ownershipDocument/>",), ("<broken",), (None,)], "text string")
    got = forms.ownership_transactions(docs).orderBy("lot").collect()
    assert [(r.person_nid, r.issuer_cik, r.shares, r.is_derivative) for r in got] == [("cik-777123", "660412", 100.0, 0), ("cik-777123", "660412", 5.0, 1)]
    assert got[0].price_per_share == pytest.approx(2204.75) and got[1].total_value == 0
    assert [(r.role_type, r.officer_title) for r in forms.ownership_roles(docs).collect()] == [("officer", "CEO")]
    assert [r.kind for r in forms.classify(docs).collect()] == ["form4", "failed", "failed", "failed"]


def test_facts_with_nulls(spark):
    doc = json.dumps({"cik": 1, "facts": {"us-gaap": {"Assets": {"units": {"USD": [{"end": "2020-12-31", "val": 5, "fy": None, "fp": None, "accn": "a", "frame": "CY2020"}]}}}}})
    got = forms.company_facts(spark.createDataFrame([(doc,)], "text string")).first()
    assert (got.tag, got.qtrs, got.value, got.dimensional_context) == ("us-gaap:Assets", 0, 5.0, "CY2020")


def test_prose(spark):
    one = lambda c, h: spark.createDataFrame([(h,)], "h string").select(c(F.col("h")).alias("x")).first().x
    subs = one(prose.subsidiaries, "Larkmoor Mills Abroad    Ireland\nPinecask Funding, Inc.  Nevada\nVoltbarn Storage, Inc.\nNevada\n\n")
    assert [tuple(s) for s in subs] == [("Larkmoor Mills Abroad", "Ireland"), ("Pinecask Funding, Inc.", "Nevada"), ("Voltbarn Storage, Inc.", "")]
    assert one(prose.max_percent, "owns 7.5% or 250% of it") == 7.5
    assert one(prose.beneficial_owners, "nothing here") == [] and one(prose.officer_changes, "Mr. Smith resigns") == []
    assert one(prose.related_parties, "Item 13. incorporated by reference, $5 million. x") == []
    assert one(prose.offering, "a memo of $5 million") is None and one(prose.earnings, "no figures") is None


def test_reshape(spark):
    ev = spark.createDataFrame([("a", 1, "x"), ("a", 2, None), ("a", 3, "y"), ("b", 1, None)], "g string, o int, v string")
    assert rows(reshape.carry_forward(ev, "v", ["g"], ["o"])) == [("a", 1, "x"), ("a", 2, "x"), ("a", 3, "y"), ("b", 1, None)]
    assert rows(reshape.star(ev.where("g = 'a'"), "g", "o", "o").select("hub", "o", "position")) == [(1, 2, 1), (1, 3, 2)]
    assert reshape.sorted_columns(spark.range(1).selectExpr("1 as wkt_geometry", "2 as b", "3 as a")).columns == ["a", "b", "wkt_geometry"]
    assert len(reshape.provenance(*[F.lit("x")] * 4)) == 8


def test_blueprint(spark):
    t = {"company": spark.createDataFrame([("1", "A"), ("2", "B"), ("2", "B2")], "cik string, name string"), "filing": spark.createDataFrame([("f1", "1", "2024-01-02"), ("f2", "1", "2024-01-01"), ("f3", "9", "bad"), ("f4", None, "2024-01-03")], "acc string, cik string, day string")}
    spec = {"nodes": {"Company": {"csv": "x/company.csv", "pk": "cik", "title": "name"}, "Filing": {"csv": "filing.csv", "pk": "acc", "connections": {"fk_edges": {"FILED_BY": {"target": "Company", "fk": "cik"}}}}}, "compute": [{"op": "chain", "from": "Filing", "group_by": ["cik"], "order_by": "day", "edge": "NEXT"}]}
    g = blueprint.compile_blueprint(t, spec)
    assert rows(g.edge_rows.select("src", "type", "dst")) == [("f1", "FILED_BY", "1"), ("f2", "FILED_BY", "1"), ("f2", "NEXT", "f1")]
    assert g.nodes("Company").count().first().n == 2 and g.nodes("Filing").out("FILED_BY", "Company").count().first().n == 2
    assert blueprint.dangling(t["filing"], "cik", t["company"], "cik").count() == 1
    assert blueprint.tables_used(spec) == ["company", "filing"]
    assert blueprint.deep_merge({"a": {"b": 1}, "c": [1]}, {"a": {"b": 2, "d": 3}, "c": [2]}) == {"a": {"b": 1, "d": 3}, "c": [1]}
    assert blueprint.deep_merge({"a": {"b": 1}, "c": [1]}, {"a": {"b": 2}, "c": [2]}, True) == {"a": {"b": 2}, "c": [2]}
    with pytest.raises(ValueError):
        blueprint.expression("drop(table)")


def test_sources(spark, tmp_path):
    tree = tmp_path / "filings" / "660412" / "0000660412-24-000123"
    tree.mkdir(parents=True)
    (tree / "lkm-8k.htm").write_bytes(b"Item 9.01 Exhibits")
    (tree / "bad.htm").write_bytes(b"\xff\xfe")
    got = files.filing_tree(spark, str(tmp_path / "filings"))
    assert rows(got.select("cik", "document", "valid")) == [("660412", "bad.htm", False), ("660412", "lkm-8k.htm", True)]
    nt = ['<http://e/B7> <http://www.w3.org/2000/01/rdf-schema#label> "Bramble"@en .', '<http://e/B7> <http://www.w3.org/2000/01/rdf-schema#label> "Brombeere"@de .', "<http://e/B7> <http://e/prop/direct/G3> <http://e/B9> .", "# no triple"]
    nodes, edges = files.entity_graph(files.triples(spark.createDataFrame([(x,) for x in nt], "value string"), ["en"]))
    assert rows(nodes) == [("B7", "Bramble")] and rows(edges) == [("B7", "G3", "B9")]
    seen = Observation("lines")
    assert files.triples(spark.createDataFrame([(x,) for x in [*nt, None]], "value string"), seen=seen).count() == 3 and seen.get == {"lines": 5, "bad": 2}
    plan = files.triples(spark.createDataFrame([(nt[0],)], "value string"))._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("[A-Za-z0-9-]+") == 1  # the pattern stands in the plan once
    (tmp_path / "r.csv").write_text("a,b\n1,2\n3\n")
    assert rows(files.ragged_csv(spark, str(tmp_path / "r.csv"))) == [("1", "2"), ("3", None)] and files.line_count(spark, str(tmp_path / "r.csv")) == 2


def test_archive(spark, tmp_path):
    path = str(tmp_path / "submissions.zip")
    with zipfile.ZipFile(path, "w") as z:
        for cik in (1, 22, 333):
            z.writestr(f"CIK{cik:010}.json", json.dumps({"cik": str(cik), "name": f"C{cik}", "filings": {"recent": {"accessionNumber": ["a"], "form": ["4"]}}}))
        z.writestr("readme.txt", "no")
    archive.register(spark)
    df = spark.read.format("submissions_zip").option("path", path).option("entriesPerPartition", "2").load()
    assert sorted(r.cik for r in df.collect()) == [1, 22, 333]
    uri = spark.read.format("submissions_zip").option("path", f"file://{path}").load()
    assert sorted(r.cik for r in uri.where("cik in (1, 333, 4)").collect()) == [1, 333] and uri.where("error is not null").count() == 0
    whole = bytearray((tmp_path / "submissions.zip").read_bytes())
    whole[whole.index(b"CIK0000000022.json") + 20] ^= 0xFF  # a damaged entry is a row, the others stay
    (tmp_path / "bad.zip").write_bytes(whole)
    bad = spark.read.format("submissions_zip").option("path", str(tmp_path / "bad.zip")).load().collect()
    assert sorted((r.cik, r.value is None, r.error is None) for r in bad) == [(1, False, True), (22, True, False), (333, False, True)]
    one = forms.filing_index(forms.submissions(df.where("cik = 22")))
    assert rows(one.select("accession_number", "cik")) == [("a", "22")]


def test_generations(spark, tmp_path):
    root = str(tmp_path / "graph")
    assert sinks.current_generation(spark, root) is None
    sinks.write_generation({"nodes": spark.range(3)}, root, "gen_1")
    sinks.write_generation({"nodes": spark.range(5)}, root, "gen_2")
    assert sinks.current_generation(spark, root) == "gen_2" and sinks.read_generation(spark, root, "nodes").count() == 5
    with open(os.path.join(root, "CURRENT"), "w", encoding="utf-8") as f:
        f.write("../x")
    assert sinks.current_generation(spark, root) is None
    sinks.export_csv(spark.createDataFrame([(1.0, 0.0, "a")], "x double, y double, z string").coalesce(1), str(tmp_path / "csv"))
    assert spark.read.text(str(tmp_path / "csv")).count() == 2


def test_a_failed_swap_keeps_the_old_table(spark, tmp_path, monkeypatch):
    root = str(tmp_path)
    sinks.write_table(spark.range(3), root, "t")
    sinks.rewrite(spark, root, "t", lambda t: t.where("id > 0"))
    assert sinks.open_table(spark, root, "t").count() == 2 and len(sinks.Store(spark, root).names()) == 2  # the table and the pointers
    sinks.write_generation({"t": spark.range(1)}, root, "g1")

    def broken(self, name, to):
        raise OSError("no rename today")

    with monkeypatch.context() as m:
        m.setattr(sinks.Store, "move", broken)
        for attempt in (lambda: sinks.rewrite(spark, root, "t", lambda t: t.limit(0)), lambda: sinks.write_generation({"t": spark.range(9)}, root, "g2"), lambda: sinks.save_manifest(spark, root, {"a": 1})):
            with pytest.raises(OSError, match="today"):
                attempt()
    assert sinks.open_table(spark, root, "t").count() == 2 and sinks.current_generation(spark, root) == "g1" and sinks.load_manifest(spark, root) == {}
    assert len(sinks.sweep(spark, root, "t")) == 1 and sinks.open_table(spark, root, "t").count() == 2
    with pytest.raises(ValueError):  # the change fails before anything is swapped
        sinks.rewrite(spark, root, "t", lambda t: 1 / 0 if t is None else (_ for _ in ()).throw(ValueError()))
    sinks.save_manifest(spark, root, {"a": 1})
    sinks.save_manifest(spark, root, {"a": 2})
    assert sinks.load_manifest(spark, root) == {"a": 2} and not [n for n in os.listdir(root) if n.endswith(".part")]
    sinks.export_one_csv(spark.range(2), root, "r.csv")
    sinks.export_one_csv(spark.range(1), root, "r.csv")
    assert (tmp_path / "r.csv").read_text() == "id\n0\n"
    assert sinks.extracted(spark, root, "t") and not sinks.extracted(spark, root, "t", force=True) and not sinks.extracted(spark, root, "u")


def collection(*ids):
    return json.dumps({"type": "FeatureCollection", "features": [{"type": "Feature", "properties": {"id": i}, "geometry": {"type": "Point", "coordinates": [i, 1]}} for i in ids]})


@pytest.mark.parametrize("size", [1, 3, 4, 50])
def test_pages_of_any_size_give_the_same_rows(spark, tmp_path, size):
    ids = list(range(12))
    for at in range(0, len(ids) + size, size):
        (tmp_path / f"{at}.json").write_text(collection(*ids[at : at + size]))
    (tmp_path / "9000.json").write_text(collection(77, 78))  # behind the end
    (tmp_path / "notes.json").write_text("{}")
    got = datasets.feature_rows(datasets.paged_features(spark, str(tmp_path), size))
    assert sorted((int(r.properties["id"]), r.wkt_geometry) for r in got.collect()) == [(i, f"POINT({i} 1)") for i in ids]


def test_dataset_catalog(spark):
    found = datasets.catalog(spark)
    assert found.count() == 149 and [tuple(r) for r in found.groupBy("kind").count().orderBy("kind").collect()] == [("factmaps", 39), ("layer", 39), ("table", 71)]
    one = lambda xs: spark.createDataFrame([(x,) for x in xs], "stem string")
    got = datasets.plan(one(["field", "field", "mine", "nobody", None]), found, one(["mine", "field"]))
    assert rows(got.select("stem", "standing", "layer")) == [("field", "served", 7100), ("mine", "user_supplied", None), ("nobody", "unfetchable", None)]


def test_a_refresh_that_is_stopped_goes_on(spark, tmp_path):
    root, stems, fetched, events = str(tmp_path), ["company", "field", "play", "tuf", "wellbore"], [], []

    def fetch(stem):
        if stem == "play" and "play" not in fetched:
            fetched.append(stem)
            raise KeyboardInterrupt
        fetched.append(stem)
        return spark.range(len(stem))

    with pytest.raises(KeyboardInterrupt):
        datasets.refresh(spark, root, stems, fetch, "2024-03-01T00:00:00", workers=1, on_event=events.append)
    assert fetched[:3] == ["company", "field", "play"] and set(datasets.Log(spark, root).entries()) == {"company", "field"}
    assert [e["event"] for e in events] == ["start", "update", "update", "complete"]
    report = datasets.refresh(spark, root, stems, fetch, "2024-03-01T00:00:00", workers=2)
    assert sorted(report["fetched"]) == ["play", "tuf", "wellbore"] and sorted(report["cached"]) == ["company", "field"] and fetched.count("company") == 1
    log = datasets.Log(spark, root)
    log.compact()
    assert log.entries()["wellbore"]["rows"] == 8 and sinks.open_table(spark, root, "wellbore").count() == 8 and len(log.store.names(datasets.LOG)) == 5

    def broken(stem):
        raise ValueError("gone")

    later = datasets.refresh(spark, root, stems, broken, "2024-03-02T00:00:00", remote_rows=lambda s: 8 if s == "wellbore" else 0, sweep=True)
    assert later["unchanged"] == ["wellbore"] and len(later["errors"]) == 4 and sinks.open_table(spark, root, "tuf").count() == 3  # what was there stays


def test_a_cache_follows_the_pointer(spark, tmp_path):
    root, cache = str(tmp_path), sinks.Cache()
    assert cache.get(spark, root, "t") is None
    sinks.write_generation({"t": spark.range(3)}, root, "g1")
    first = cache.get(spark, root, "t")
    assert cache.get(spark, root, "t") is first and first.storageLevel.useMemory and cache.get(spark, root, "t", 2).count() == 2
    sinks.write_generation({"t": spark.range(5)}, root, "g2")
    assert cache.get(spark, root, "t").count() == 5 and not first.storageLevel.useMemory
    cache.clear()


def test_open_period_is_replaced_and_closed_ones_stay(spark, tmp_path):
    land, table, mark, events = str(tmp_path / "land"), str(tmp_path / "table"), str(tmp_path / "mark"), []
    listener = landing.Progress(events.append)
    spark.streams.addListener(listener)
    try:
        for values in ([("2023Q4", 1), ("2024Q1", 2)], [("2023Q4", 9), ("2024Q1", 3), ("2024Q1", 4)]):
            df = spark.createDataFrame(values, "quarter string, v int")
            df.coalesce(1).write.mode("append").parquet(land)
            landing.ingest_periods(spark, land, df.schema, table, mark, "quarter", "2024Q1")
        for _ in range(100):  # listeners hear of an end a little later
            if [e["event"] for e in events].count("complete") == 2:
                break
            time.sleep(0.1)
    finally:
        spark.streams.removeListener(listener)
    assert rows(spark.read.parquet(table).select("quarter", "v")) == [("2023Q4", 1), ("2024Q1", 3), ("2024Q1", 4)]
    assert [e["event"] for e in events if e["event"] != "update"] == ["start", "complete"] * 2 and sum(e["rows"] for e in events if e["event"] == "update") >= 5


def test_refresh(spark):
    m = spark.createDataFrame([("a", None, None), ("b", "2024-02-28T00:00:00", 100), ("c", "2024-02-28T00:00:00", 3), ("d", "2020-01-01T00:00:00", 100), ("e", "junk", 9)], "name string, fetched_at string, size_bytes int")
    now = F.lit("2024-03-01T00:00:00")
    assert {r.name: r.action for r in refresh.dataset_action(m, now, F.lit(False)).collect()} == {"a": "fetch", "b": "skip", "c": "fetch", "d": "fetch", "e": "fetch"}
    assert {r.action for r in refresh.dataset_action(m.where("name = 'b'"), now, F.lit(True)).collect()} == {"probe"}


def test_ingest(spark, tmp_path):
    land, table, mark = (str(tmp_path / x) for x in ("land", "table", "mark"))
    first = spark.createDataFrame([("a", 1), ("b", 2)], "accession string, v int")
    first.write.parquet(land)
    landing.ingest(spark, land, first.schema, table, mark, "accession")
    spark.createDataFrame([("b", 9), ("c", 3)], "accession string, v int").write.mode("append").parquet(land)
    landing.ingest(spark, land, first.schema, table, mark, "accession")
    assert rows(spark.read.parquet(table)) == [("a", 1), ("b", 2), ("c", 3)]


def registry(spark):
    table_13f = "<informationTable><infoTable><nameOfIssuer>LARKMOOR</nameOfIssuer><cusip>55X0001A1</cusip><value>700</value><shrsOrPrnAmt><sshPrnamt>31000</sshPrnamt></shrsOrPrnAmt></infoTable><infoTable><nameOfIssuer>PINECASK</nameOfIssuer><cusip>55X0002B2</cusip><value>90</value></infoTable></informationTable>"
    docs = spark.createDataFrame([
        ("660412", "a-10k", "lkm-ex21.htm", "Larkmoor Mills Abroad    Ireland\nPinecask Funding, Inc.   Nevada"),
        ("660412", "a-4", "form4.xml", FORM4.replace("<value>2204750</value>", "<value>2204.5</value>")),
        ("660412", "a-8k", "lkm-8k.htm", "<p>Item 5.02 Departure of Directors</p><p>Item 9.01 Financial Statements</p>"),
        ("4410", "b-13f", "13f-infotable.xml", table_13f),
        ("4410", "b-13f", "cover.xml", "<edgarSubmission/>"),
        ("1", "stray", "form4.xml", FORM4),
        ("1", "a-8k", "empty.htm", None),
    ], "cik string, accession_number string, document string, text string")
    index = spark.createDataFrame([("a-10k", "660412", "10-K", "2024-11-01", "", "x"), ("a-4", "660412", "4", "2024-09-15", "", "x"), ("a-8k", "660412", "8-K", "2024-09-01", "", "x"), ("b-13f", "4410", "13F-HR", "2024-08-01", "", "x")], "accession_number string, cik string, form_type string, filed_date string, report_date string, primary_document string")
    parsed = forms.submissions(spark.createDataFrame([(json.dumps({"cik": "0000660412", "name": "Larkmoor", "sic": "3571", "sicDescription": "Computers"}),)], "value string"))
    return tables.build(docs, index, parsed, extracted_at="now")


def test_registry_tables(spark, tmp_path):
    """An insider form, a manager's table, a current report and an exhibit become facts with keys and provenance; stored facts give the same tables."""
    got = registry(spark)
    assert len(tables.NAMES) == 35
    stored, counts = got.written(str(tmp_path))
    few = ("company", "sic", "insider_transaction", "role", "institutional_holding", "security", "institutional_manager", "corporate_event", "subsidiary", "merger", "metric_fact")
    want = {"company": 1, "sic": 1, "insider_transaction": 2, "role": 1, "institutional_holding": 2, "security": 2, "institutional_manager": 1, "corporate_event": 2, "subsidiary": 2, "merger": 0, "metric_fact": 0}
    assert {r.table: r.rows for r in tables.report(stored, few).collect()} == want
    assert {t: counts[t] for t in few if t in counts} == {t: n for t, n in want.items() if t in counts}  # counted by the job that wrote them
    assert sorted(os.listdir(tmp_path / "facts"))[:2] == ["._SUCCESS.crc", "_SUCCESS"] and (tmp_path / "facts" / "table=subsidiary").is_dir()
    for t in ("insider_transaction", "person"):
        assert rows(got[t]) == rows(stored[t])
    tx = stored["insider_transaction"].orderBy("transaction_nid").collect()
    assert [r.transaction_nid for r in tx] == ["a-4-0-sale", "a-4-1-purchase"] and tx[0].source_url == "/Archives/edgar/data/777123/a4/form4.xml" and tx[0].source_extracted_at == "now"
    assert [r.event_nid for r in stored["corporate_event"].orderBy("event_nid").collect()] == ["a-8k-5.02", "a-8k-9.01"]
    assert dict(stored["insider_transaction"].dtypes)["shares"] == "double" and [r.officer_title for r in stored["role"].collect()] == ["CEO"]


def test_only_wanted_parsers_are_planned(spark):
    plan = lambda name: registry(spark)[name]._jdf.queryExecution().optimizedPlan().toString()
    assert "from_xml" not in plan("subsidiary").lower() and "xmltostructs" not in plan("subsidiary").lower() and "infoTable" in plan("security")


def test_first_named_identity_wins(spark):
    """Stages come before paths, paths before places; each kind of identity by its own key."""
    variant = F.to_variant_object(F.struct(F.col("n").alias("display_name")))
    facts = spark.createDataFrame([("person", "p-a", 5, "1", 0, "late"), ("person", "p-a", 4, "2", 3, "first"), ("person", "p-a", 4, "2", 9, "third"), ("security", "p-a", 1, "0", 0, "other"), ("role", "p-a", 0, "0", 0, "no")], "table string, nid string, stage int, path string, place int, n string").withColumn("cells", variant)
    assert rows(tables.identities(facts).select("table", "nid", F.variant_get("cells", "$.display_name", "string"))) == [("person", "p-a", "first"), ("security", "p-a", "other")]


def test_summary_table_is_found_by_its_labels(spark):
    table = "<table><tr><th>Name</th><th>Year</th><th>Sal<b>ary</b> Salary</th><th>Total</th></tr><tr><td>Jane Q Doe</td><td>2023</td><td>$1,000</td><td>2,000</td></tr></table>"
    docs = ["<p>SUMMARY Compensation Table 12</p>" + "<p>filler</p>" * 4000 + "<p>See the Summary Compensation Table.</p>" + "words " * 1100 + "<h2>Summary compensation table</h2>" + table, "<p>Summary Compensation Table</p>", table, None]
    rows = spark.createDataFrame(list(enumerate(docs)), "id int, html string").select("id", F.explode(prose.compensation_rows(F.col("html"))).alias("x"))
    assert [(r.id, r.x.name, r.x.fiscal_year, r.x.amounts) for r in rows.collect()] == [(0, "Jane Q Doe", 2023, [1000.0, 2000.0])]


def test_selling_holder_behind_other_cells(spark):
    html = "<h2>Selling Stockholders</h2><table><tr><td>Name of holder</td><td>5,000</td><td>6,000</td></tr><tr><td>1</td><td>*</td><td>River Stone Partners</td><td>2,500</td><td>1,000</td></tr></table>"
    rows = spark.createDataFrame([(html,)], "html string").select(F.explode(prose.selling_holders(F.col("html"))).alias("x"))
    assert [(r.x.holder_name, r.x.shares_before, r.x.shares_offered) for r in rows.collect()] == [("River Stone Partners", 2500.0, 1000.0)]


@pytest.mark.parametrize("name", ["q_ownership", "q_comp_table", "q_exhibit21", "q_offering"])
def test_documents_of_few_splits_are_dealt_to_all_cores(spark, name):
    rows = catalog.QUERIES[name](spark, "/root/testdata/sf0.001")
    assert rows.rdd.getNumPartitions() >= spark.sparkContext.defaultParallelism > 1


def test_ownership_forms_read_as_maps_or_structs(spark):
    """Small elements are maps; text in place of their elements, other prefixes and broken forms give what structs give, and other parts are left alone."""
    assert "nonDerivativeTransaction:array<struct<securityTitle:map<string,string>" in forms._ownership_schema(False, holdings=False) and "Holding" not in forms._ownership_schema(False, holdings=False)
    shares, owner = "<transactionShares><value>100</value></transactionShares>", "<reportingOwnerId><rptOwnerCik>0000777123</rptOwnerCik></reportingOwnerId>"
    texts = [FORM4, FORM4.replace(shares, "<transactionShares>100</transactionShares>"), FORM4.replace(shares, "<transactionShares>x<value> 7\n</value></transactionShares>"), FORM4.replace(shares, "<transactionShares/>"), FORM4.replace(shares, shares + shares.replace("100", "200")), FORM4.replace(owner, "<reportingOwnerId>7</reportingOwnerId>"), FORM4.replace("<issuerCik>", "<q><z>1</z></q><n:issuerCik>").replace("</issuerCik>", "</n:issuerCik>"), FORM4[:-9], None]
    docs = spark.createDataFrame(list(enumerate(texts)), "i int, text string")
    got = {(r.i, r.lot): (r.person_nid, r.issuer_cik, r.shares) for r in forms.ownership_transactions(docs).collect()}
    cik = "cik-777123"
    assert got == {(0, 0): (cik, "660412", 100.0), (1, 0): (cik, "660412", 0.0), (2, 0): (cik, "660412", 7.0), (3, 0): (cik, "660412", 0.0), (4, 0): (cik, "660412", 200.0), (5, 0): ("cik-0", "660412", 100.0), (6, 0): (cik, "660412", 100.0)} | {(i, 1): ("cik-0" if i == 5 else cik, "660412", 5.0) for i in range(7)}
    structs = docs.withColumn("d", F.from_xml("text", forms.OWNERSHIP, {"ignoreNamespace": "true"}))
    for emit in (forms.ownership_transactions, forms.ownership_roles, forms.ownership_holdings):
        assert rows(emit(docs)) == rows(emit(structs))

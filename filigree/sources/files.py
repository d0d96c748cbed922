"""Filing trees, delimited files, tickers, triples and features, as DataFrames."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from filigree.functions import dates, ids
from filigree.operators.lookup import sequential_key


def filing_tree(spark: SparkSession, root: str, content: bool = True) -> DataFrame:
    """Documents at root/{cik}/{accession}/{document}, exactly two folders deep; without content only the listing is read."""
    files = spark.read.format("binaryFile").load(f"{root}/*/*/*")
    parts = ids.filing_path_parts(F.col("path"))
    out = files.select("path", parts["cik"].alias("cik"), parts["accession"].alias("accession_number"), parts["document"].alias("document"), *(["content"] if content else []))
    if content:
        out = out.withColumns({"valid": F.is_valid_utf8(F.col("content").cast("string")), "text": F.col("content").cast("string")}).drop("content")
    return out


def corpus_ciks(spark: SparkSession, filings_root: str, facts_root: str) -> DataFrame:
    """Company numbers that a folder of filings or a facts file exists for; names only are read."""
    a = filing_tree(spark, filings_root, content=False).select(F.col("cik").try_cast("bigint").alias("cik"))
    b = spark.read.format("binaryFile").load(facts_root).select(F.regexp_extract("path", r"CIK(\d+)\.json$", 1).try_cast("bigint").alias("cik"))
    return a.union(b).where("cik is not null").distinct()


def ragged_csv(spark: SparkSession, path: str) -> DataFrame:
    """All-text columns; short rows are filled up with nulls."""
    return spark.read.csv(path, header=True, mode="PERMISSIVE", multiLine=True, escape='"')


def typed_csv(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """Rows that don't fit the schema are left out."""
    return spark.read.schema(schema).csv(path, header=True, mode="DROPMALFORMED")


def line_count(spark: SparkSession, path: str) -> int:
    """Physical lines below the header."""
    return max(spark.read.text(path).count() - 1, 0)


def tickers(raw: DataFrame, column: str = "value") -> DataFrame:
    """(ticker, cik) of a JSON map of {cik_str, ticker, title}; null entries and empty tickers are left out, of repeated tickers the last entry stays."""
    entries = F.from_json(column, "map<string,struct<cik_str:bigint,ticker:string,title:string>>")
    rows = raw.select(F.monotonically_increasing_id().alias("_r"), F.posexplode(F.map_values(entries)).alias("_n", "x")).where("x.ticker <> '' and x.cik_str is not null")
    return rows.groupBy(F.upper("x.ticker").alias("ticker")).agg(F.max_by("x.cik_str", F.struct("_r", "_n")).alias("cik"))


def resolve_companies(spark: SparkSession, wanted: list[int | str], known: DataFrame) -> list[int]:
    """The company numbers of numbers and tickers, in their order; a ticker that known (ticker, cik) lacks is an error."""
    asked = sorted({w.upper() for w in wanted if isinstance(w, str)})
    found = {r["ticker"]: r["cik"] for r in known.where(F.col("ticker").isin(asked)).collect()} if asked else {}
    unknown = [w for w in asked if w not in found]
    if unknown:
        raise ValueError(f"unknown tickers: {', '.join(unknown)}")
    return [found[w.upper()] if isinstance(w, str) else w for w in wanted]


def resolved(requests: DataFrame, known: DataFrame) -> DataFrame:
    """requests (name) with cik: digits stand for themselves, other names are tickers; null where there is no such ticker."""
    by_name = known.select(F.col("ticker").alias("_t"), F.col("cik").alias("_c"))
    return requests.join(by_name, F.upper("name") == F.col("_t"), "left").select(*requests.columns, F.coalesce(F.col("name").try_cast("bigint"), "_c").alias("cik"))


def triples(lines: DataFrame, languages: list[str] | None = None, column: str = "value", seen: Observation | None = None) -> DataFrame:
    """(subject, predicate, object, is_iri, lang) of N-Triples lines; literals in other languages go, those without one stay.

    One evaluation of one pattern cuts a line into its five parts. seen counts lines and those that are no triples (comments too).
    """
    form = r'^\s*<([^>]*)>\s+<([^>]*)>\s+(?:<([^>]*)>|"((?:[^"\\]|\\.)*)"(?:@([A-Za-z0-9-]+))?(?:\^\^<[^>]*>)?)\s*\.\s*$'
    cut = F.when(~F.contains(column, F.lit("\x01")), F.regexp_replace(column, form, "\x01".join(f"${i}" for i in range(1, 6))))
    part = F.split(cut, "\x01")
    # Behind a generator, so that no filter takes the pattern along.
    rows = lines.select(F.explode(F.array(part)).alias("p"))
    good = F.coalesce(F.size("p") == 5, F.lit(False))
    if seen is not None:
        rows = rows.observe(seen, F.count("*").alias("lines"), F.count_if(~good).alias("bad"))
    p = lambda i: F.col("p")[i]
    out = rows.where(good).select(p(0).alias("subject"), p(1).alias("predicate"), F.when(p(2) != "", p(2)).otherwise(unescaped(p(3))).alias("object"), (p(2) != "").alias("is_iri"), F.nullif(p(4), F.lit("")).alias("lang"))
    return out.where(F.col("lang").isNull() | F.col("lang").isin(languages)) if languages else out


def unescaped(text: Column) -> Column:
    """A literal's text with \\uXXXX, \\UXXXXXXXX and one-letter escapes resolved."""
    plain = F.transform(F.regexp_extract_all(text, F.lit(r"(?s)(\\u[0-9A-Fa-f]{4}|\\U[0-9A-Fa-f]{8}|\\.|[^\\]+)"), F.lit(1)), _unescaped)
    return F.when(F.contains(text, F.lit("\\")), F.array_join(plain, "")).otherwise(text)


def _unescaped(part: Column) -> Column:
    code = F.conv(F.regexp_extract(part, r"^\\[uU]([0-9A-Fa-f]+)$", 1), 16, 10).try_cast("int")
    letters = F.try_element_at(F.create_map(*[F.lit(x) for kv in {"\\t": "\t", "\\n": "\n", "\\r": "\r"}.items() for x in kv]), part)
    point = F.decode(F.unhex(F.lpad(F.hex(code), 8, "0")), "utf-32")
    return F.when(code.isNotNull(), point).otherwise(F.coalesce(letters, F.regexp_replace(part, r"^\\(.)$", "$1")))


#: Up to so many subjects the first are found by a merge of each task's first; beyond, all are numbered.
MERGED = 100_000


def first_entities(found: DataFrame, order: str, most: int) -> DataFrame:
    """The triples of the first `most` subjects by where they first stand (order). However many those are, no task sees them all."""
    seen = found.groupBy("subject").agg(F.min(order).alias("_first"))
    kept = seen.orderBy("_first", "subject").limit(most) if most <= MERGED else sequential_key(seen, ["_first", "subject"], "_n").where(F.col("_n") <= most)
    return found.join(kept.select("subject"), "subject", "left_semi")


def entity_id(iri: Column) -> Column:
    return F.substring_index(iri, "/", -1)


def entity_graph(found: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(nodes: id, title; edges: src, type, dst) of triples: labels give titles, direct properties give edges."""
    label = F.col("predicate").endswith("rdf-schema#label")
    ids_ = found.select(entity_id(F.col("subject")).alias("id"), F.when(label, F.col("object")).alias("title"))
    edges = found.where(F.col("is_iri") & F.col("predicate").contains("/prop/direct/")).select(entity_id(F.col("subject")).alias("src"), entity_id(F.col("predicate")).alias("type"), entity_id(F.col("object")).alias("dst"))
    return ids_.groupBy("id").agg(F.min("title").alias("title")), edges


def features(raw: DataFrame, column: str = "value") -> DataFrame:
    """(properties: map<string,string>, geometry: string) of GeoJSON feature collections."""
    parsed = F.from_json(column, "features array<struct<properties:map<string,string>,geometry:string>>")
    return raw.select(F.explode(parsed["features"]).alias("f")).select("f.properties", "f.geometry")


def quarters(spark: SparkSession, first: int, last: int) -> DataFrame:
    """(year, quarter) of the years; the index begins with the third quarter of 1993."""
    days = F.explode(F.sequence(F.make_date(F.lit(first), F.lit(1), F.lit(1)), F.make_date(F.lit(last), F.lit(10), F.lit(1)), F.expr("interval 3 month")))
    return spark.range(1).select(days.alias("d")).where("d >= date'1993-07-01'").select(F.year("d").alias("year"), F.quarter("d").alias("quarter"))


def with_dates(rows: DataFrame, order: str) -> DataFrame:
    """rows in which date columns (by name) are dates where their first value, by order, is a time in milliseconds; other columns stay."""
    names = [c for c in rows.columns if dates.is_date_column(c)]
    if not names:
        return rows
    number = {c: F.col(c).try_cast("bigint") for c in names}
    first = rows.agg(*[F.min_by(number[c], F.when(F.col(c).isNotNull(), F.col(order))).alias(c) for c in names]).first()  # one row
    turned = [c for c in names if first[c] is not None and first[c] >= dates.EPOCH_MS_FROM]
    return rows.withColumns({c: dates.epoch_ms_date(number[c]) for c in turned})


def empty_layer(spark: SparkSession, description: DataFrame, column: str = "value") -> DataFrame:
    """A table without rows, with the columns that a layer's JSON description names; one row of description."""
    names = description.select(F.from_json(column, "fields array<struct<name:string>>")["fields"]["name"].alias("n")).first()["n"] or []
    return spark.createDataFrame([], T.StructType([T.StructField(n, T.StringType()) for n in names]))


def cell_text(value: Column) -> Column:
    """A JSON value (variant) as a table's cell: text as it is, nothing for null, nested values as JSON."""
    kind = F.schema_of_variant(value)
    return F.when(value.isNull() | (kind == "VOID"), F.lit("")).when(kind == "STRING", F.try_variant_get(value, "$", "string")).otherwise(F.to_json(value))

"""Secret scans over an incremental blob ledger, with built-in functions only.

Every version of a text is addressed by its content (SHA-256). The ledger has one row for each blob and rule
version that has been scanned, with the spans found, so a blob is scanned once for each rule version, however
many paths or historical versions carry it, and a later run scans only pairs that the ledger doesn't have.
Findings are joined back to every path of a blob.

Rules give leftmost non-overlapping matches; a rule may ask for a least length of the match or of a group, and
a match that fails it is dropped. Offsets count code points, ends are exclusive.

Cases: a null text counts as empty. Empty texts have no spans. Rows that share a text share its findings; equal
rows are kept as often as they come. An empty table gives an empty result. Extra columns are kept, other than
those named spans.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from filigree.functions.geo import bound


@dataclass(frozen=True)
class Rule:
    """kind, version, a pattern without (?:) needs of its own; needed: a cheap pattern that any match contains; least: (group, length)."""

    kind: str
    version: int
    pattern: str
    needed: str
    least: tuple[int, int]
    groups: int = 0


#: Patterns of the rules (fixed values).
ASSIGN = Rule("assign", 1, r"""(?i:(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+))""", r"(?i)(?:passw(?:or)?d|secret|token|api_?key)[\"']?\x20*[:=]", (2, 12), 2)
ACCESS = Rule("access", 1, r"AKIA[A-Z0-9]+", r"AKIA[A-Z0-9]{14}", (0, 18))
HEX = Rule("hex", 1, r"[0-9a-f]+", r"[0-9a-f]{16}", (0, 16))
PEM = Rule("pem", 1, r"-----BEGIN [A-Z ]*PRIVATE KEY-----", r"-----BEGIN [A-Z ]*PRIVATE KEY-----", (0, 1))
BASE = (ASSIGN, ACCESS, HEX)
RULES = (*BASE, PEM)
SALTS = 32
#: Matches of a run, within which offsets are added up one by one.
RUN = 64
SPAN = "struct<kind:string,start:bigint,end:bigint>"
LEDGER = f"blob_id string, rule string, version int, spans array<{SPAN}>"


def spans_of(text: Column, rule: Rule) -> Column:
    """array<struct<kind, start, end>> of a rule's matches, in order; empty where its needed pattern doesn't occur."""
    # A match with the text before it, so that lengths add up to offsets. \G keeps the search from starting anew at
    # every character behind the last match.
    whole = F.lit(f"(?s)\\G(.*?)({rule.pattern})")
    gaps = F.regexp_extract_all(text, whole, F.lit(1))
    hits = F.regexp_extract_all(text, whole, F.lit(2))
    group, least = rule.least
    told = hits if group == 0 else F.regexp_extract_all(text, whole, F.lit(2 + group))
    parts = F.transform(F.arrays_zip(gaps.alias("gap"), hits.alias("hit"), told.alias("told")), lambda x: F.struct(F.length(x["gap"]).cast("long").alias("gap"), F.length(x["hit"]).cast("long").alias("hit"), F.length(x["told"]).alias("told")))
    empty = F.array().cast(f"array<{SPAN}>")

    def of_run(run: Column, at: Column) -> Column:
        zero = F.struct(at.alias("at"), empty.alias("out"))

        def step(acc: Column, x: Column) -> Column:
            start = acc["at"] + x["gap"]
            span = F.array(F.struct(F.lit(rule.kind).alias("kind"), start.alias("start"), (start + x["hit"]).alias("end")))
            return F.struct((start + x["hit"]).alias("at"), F.when(x["told"] >= least, F.concat(acc["out"], span)).otherwise(acc["out"]).alias("out"))

        return F.aggregate(run, zero, step, lambda acc: acc["out"])

    # Offsets are running sums. They are taken in runs of RUN matches, each from its own start, so that the arrays that grow
    # by one element a step stay short and the whole is nearly linear in the matches.
    def cut(parts: Column) -> Column:
        return F.transform(F.sequence(F.lit(0), F.greatest(F.ceil(F.size(parts) / RUN).cast("int") - 1, F.lit(0))), lambda r: F.slice(parts, r * RUN + 1, RUN))

    def placed(runs: Column) -> Column:
        length = lambda run: F.aggregate(run, F.lit(0).cast("long"), lambda n, x: n + x["gap"] + x["hit"])
        starts = F.aggregate(F.transform(runs, length), F.array(F.lit(0).cast("long")), lambda acc, n: F.concat(acc, F.array(F.element_at(acc, -1) + n)))
        return F.flatten(F.transform(F.arrays_zip(runs.alias("run"), F.slice(starts, 1, F.size(runs)).alias("at")), lambda x: of_run(x["run"], x["at"])))

    return F.when(text.rlike(rule.needed), bound(bound(parts, cut), placed)).otherwise(empty)


def ledger_of(blobs: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """(blob_id, rule, version, spans): one row for each blob and rule."""
    rows = F.array(*[F.struct(F.lit(r.kind).alias("rule"), F.lit(r.version).alias("version"), spans_of(F.col("text"), r).alias("spans")) for r in rules])
    return blobs.select("blob_id", F.explode(rows).alias("x")).select("blob_id", "x.rule", "x.version", "x.spans")


def scan(docs: DataFrame, ledger: DataFrame | None = None, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """Ledger rows for the pairs of blob and rule version that the ledger doesn't have yet."""
    blobs = docs.select(F.coalesce("text", F.lit("")).alias("text")).withColumn("blob_id", F.sha2("text", 256)).groupBy("blob_id").agg(F.first("text").alias("text"))
    if ledger is None:
        return ledger_of(blobs, rules)
    # Each blob once, with the rule versions it has been scanned by; a blob that lacks none isn't looked at.
    name = lambda r: f"{r.kind} {r.version}"
    seen = ledger.groupBy("blob_id").agg(F.collect_set(F.concat_ws(" ", "rule", "version")).alias("seen"))
    left = blobs.join(seen, "blob_id", "left").withColumn("seen", F.coalesce("seen", F.array().cast("array<string>")))
    lacking = {r.kind: ~F.array_contains("seen", name(r)) for r in rules}
    left = left.where(reduce(lambda a, b: a | b, lacking.values()))
    rows = F.array(*[F.when(lacking[r.kind], F.struct(F.lit(r.kind).alias("rule"), F.lit(r.version).alias("version"), spans_of(F.col("text"), r).alias("spans"))) for r in rules])
    return left.select("blob_id", F.explode(F.array_compact(rows)).alias("x")).select("blob_id", "x.rule", "x.version", "x.spans")


def update(docs: DataFrame, path: str, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """The ledger stored at path, after the pairs of blob and rule version that it lacks have been scanned and appended."""
    spark = docs.sparkSession
    files = spark._jvm.org.apache.hadoop.fs
    place = files.Path(path)
    found = place.getFileSystem(spark._jsc.hadoopConfiguration()).exists(place)
    ledger = spark.read.schema(LEDGER).parquet(path) if found else None
    scan(docs, ledger, rules).write.mode("append").parquet(path)
    return spark.read.schema(LEDGER).parquet(path)


def findings(docs: DataFrame, ledger: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """docs with spans: everything the ledger has for a row's blob, by start, then in the order of the rules, then by end."""
    order = F.create_map(*[x for i, r in enumerate(rules) for x in (F.lit(r.kind), F.lit(i))])
    now = reduce(lambda a, b: a | b, [(F.col("rule") == r.kind) & (F.col("version") == r.version) for r in rules])
    rows = ledger.where(now & (F.size("spans") > 0)).groupBy("blob_id").agg(F.flatten(F.collect_list("spans")).alias("spans"))
    rows = rows.withColumn("spans", F.transform(F.array_sort(F.transform("spans", lambda s: F.struct(s["start"].alias("start"), F.try_element_at(order, s["kind"]).alias("rank"), s["end"].alias("end"), s["kind"].alias("kind")))), lambda s: F.struct(s["kind"].alias("kind"), s["start"].alias("start"), s["end"].alias("end"))))
    # A blob may have a third of all paths: paths are salted, and the few blobs with findings are there for every salt.
    rows = rows.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    paths = docs.drop("spans").withColumns({"blob_id": F.sha2(F.coalesce("text", F.lit("")), 256), "_salt": F.pmod(F.xxhash64("doc_id"), F.lit(SALTS)).cast("int")})
    return paths.join(rows, ["blob_id", "_salt"], "left").withColumn("spans", F.coalesce("spans", F.array().cast(f"array<{SPAN}>"))).drop("blob_id", "_salt")


def rendered(spans: Column) -> Column:
    """kind:start:end joined by commas."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def redact(docs: DataFrame, ledger: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """docs with every found span replaced by [kind]; overlapping spans are replaced as one, under the first kind. A column n_chars follows the text. Other rows stay as they are."""
    cols = docs.columns
    found = findings(docs, ledger, rules)
    zero = F.struct(F.lit(0).cast("long").alias("at"), F.lit("").alias("out"))

    def step(acc, s):
        fresh = s["start"] >= acc["at"]
        before = F.substring(F.col("text"), (acc["at"] + 1).cast("int"), F.greatest(s["start"] - acc["at"], F.lit(0)).cast("int"))
        return F.struct(F.greatest(acc["at"], s["end"]).alias("at"), F.when(fresh, F.concat(acc["out"], before, F.lit("["), s["kind"], F.lit("]"))).otherwise(acc["out"]).alias("out"))

    cut = F.aggregate("spans", zero, step, lambda acc: F.concat(acc["out"], F.substring(F.col("text"), (acc["at"] + 1).cast("int"), F.length("text"))))
    out = found.withColumn("text", F.when(F.size("spans") > 0, cut).otherwise(F.col("text")))
    if "n_chars" in cols:
        out = out.withColumn("n_chars", F.when(F.size("spans") > 0, F.length("text").cast(docs.schema["n_chars"].dataType)).otherwise(F.col("n_chars")))
    return out.select(*cols)

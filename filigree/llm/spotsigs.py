"""SpotSigs document fingerprints, with built-in functions only.

A text is lower-cased and reduced to its words of letters. Wherever one of some very common words (an anchor)
stands, a chain runs from it over the next two content words, whatever common words stand between them. A
text's set holds its distinct signatures, as 64-bit hashes; a text without an anchor, or with too few words
after it, has its whole word sequence as its one signature. The fingerprint is that sorted set, written as text.

Likeness is the Jaccard similarity of two sets. A pair is pruned by set lengths first: sets whose lengths differ
by more than the threshold allows cannot reach it, so sets are partitioned by length and only sets of the same or
the next partition are compared (similar_pairs).

Cases: null texts count as empty; an empty text, or one without letters, has the empty set and the fingerprint "".
Two empty sets have likeness 1, an empty and another set 0. Equal texts have equal fingerprints. Extra columns are
kept, other than fingerprint and signatures. An empty table gives an empty result.
"""

from __future__ import annotations

from math import log

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Common words that start a chain, by language (fixed values).
ANCHORS = """
the a an of and to in is that for was with
le la les de des un une que est et dans pour
der die das und ein eine ist den von mit zu nicht
el los las y en una es del por con se lo
""".split()


def alternatives(words: list[str]) -> str:
    """A pattern for any of the words that looks at each letter once: words grouped by their first letters."""
    if words == [""]:
        return ""
    heads: dict[str, list[str]] = {}
    for w in words:
        if w:
            heads.setdefault(w[0], []).append(w[1:])
    branches = "|".join(h + alternatives(rest) for h, rest in sorted(heads.items()))
    return f"(?:{branches})" + ("?" if "" in words else "")


_ANY = alternatives(sorted(set(ANCHORS)))
#: A run of anchors with the two content words behind it, if there are two, and what stands between those. A run is taken
#: whole whether or not words follow, so that no place is looked at from each of its anchors.
CHAIN = f"(?<= )(?=((?:{_ANY} )++(?:[^ ]+ (?:{_ANY} )*+[^ ]+ )?+))(?:{_ANY} )++"
_LEAD, _PAIR = f"^(?:{_ANY} )++", f"^([^ ]+ )(?:{_ANY} )*+"


def words_text(text: Column) -> Column:
    """The words of letters, lower-cased, each between spaces."""
    return F.concat(F.lit(" "), F.trim(F.regexp_replace(F.lower(F.coalesce(text, F.lit(""))), r"[^\p{L}]+", " ")), F.lit(" "))


def signatures(words: Column) -> Column:
    """The sorted distinct signature hashes of words_text(...)."""
    def of_run(chain: Column) -> Column:
        """The run's anchors, each once, with the two content words: each starts a chain of its own."""
        pair = F.regexp_replace(F.regexp_replace(chain, _LEAD, ""), _PAIR, "$1")
        anchors = F.array_distinct(F.split(F.rtrim(F.regexp_extract(chain, _LEAD, 0)), " "))
        return F.when(pair.rlike("^[^ ]+ [^ ]+ $"), F.transform(anchors, lambda a: F.xxhash64(a, pair))).otherwise(F.array().cast("array<bigint>"))

    chains = F.regexp_extract_all(words, F.lit(CHAIN), F.lit(1))
    hashes = F.array_sort(F.array_distinct(F.flatten(F.transform(F.array_distinct(chains), of_run))))
    return F.when(F.length(words) <= 2, F.array().cast("array<bigint>")).otherwise(F.when(F.size(hashes) > 0, hashes).otherwise(F.array(F.xxhash64(words))))


def fingerprint(sigs: Column) -> Column:
    return F.array_join(sigs.cast("array<string>"), " ")


def likeness(a: Column, b: Column, threshold: float = 0.0) -> Column:
    """Jaccard similarity; 0 for pairs that their lengths keep below the threshold."""
    m, n = F.size(a), F.size(b)
    common = F.size(F.array_intersect(a, b))
    return F.when((m == 0) & (n == 0), F.lit(1.0)).when(F.least(m, n) < F.greatest(m, n) * threshold, F.lit(0.0)).otherwise(common / (m + n - common))


def with_signatures(docs: DataFrame, text: str = "text") -> DataFrame:
    """docs with signatures and fingerprint."""
    return docs.withColumn("_w", words_text(F.col(text))).withColumn("signatures", signatures(F.col("_w"))).drop("_w").withColumn("fingerprint", fingerprint(F.col("signatures")))


def similar_pairs(docs: DataFrame, threshold: float = 0.8, block: int = 512) -> tuple[DataFrame, DataFrame]:
    """(classes, pairs): doc_id with the smallest doc_id of equal fingerprints; (a, b, likeness) between classes.

    Sets are partitioned by length so that sets at the threshold lie in the same or neighbouring partitions. Each
    set offers its rarest signatures, as many as a set at the threshold must share one of, and sets of one partition
    or the next that offer the same signature are compared, those of shorter lengths first pruned. The sets that offer
    one signature are dealt to blocks of about block sets, and each pair of blocks is joined apart, so that no task
    grows with a common signature. Every similar pair is a row; what shrinks groups of copies are the classes.
    """
    rows = with_signatures(docs).select("doc_id", "fingerprint", "signatures")
    heads = rows.groupBy("fingerprint").agg(F.min("doc_id").alias("class"), F.first("signatures").alias("s")).where(F.size("s") > 0)
    classes = rows.join(heads.select("fingerprint", "class"), "fingerprint").select("doc_id", "class")
    part = F.floor(F.log(F.size("s")) / F.lit(-log(threshold))).cast("int")
    spread = heads.select("class", F.size("s").alias("n"), part.alias("part"), F.explode("s").alias("sig"))
    often = spread.groupBy("sig").agg(F.count("*").alias("often"))
    rank = F.row_number().over(Window.partitionBy("class").orderBy("often", "sig"))
    offered = spread.join(often, "sig").withColumn("_r", rank).where(F.col("_r") <= F.col("n") - F.ceil(F.col("n") * threshold - 1e-9) + 1)
    # The blocks of a (part, sig) come from its number of sets, its own partition and the next together.
    both_parts = offered.select("sig", "class", "n", "part", F.explode(F.array("part", F.col("part") + 1)).alias("at"))
    need = both_parts.groupBy("at", "sig").agg(F.ceil(F.count("*") / block).cast("int").alias("blocks"))
    dealt = both_parts.join(need, ["at", "sig"]).withColumn("mine", F.pmod(F.xxhash64("class", "sig"), F.col("blocks")).cast("int"))
    every = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))
    left = dealt.select("at", "sig", F.col("class").alias("a"), F.col("n").alias("m"), "mine", every.alias("other"))
    right = dealt.where(F.col("at") == F.col("part")).select("at", "sig", F.col("class").alias("b"), "n", F.col("mine").alias("other"), every.alias("mine"))
    near = (F.col("m") <= F.col("n")) & ((F.col("m") < F.col("n")) | (F.col("a") < F.col("b"))) & (F.col("m") >= F.col("n") * threshold)
    pairs = left.join(right, ["at", "sig", "mine", "other"]).where(near).select("a", "b").distinct()
    sets = heads.select("class", "s")
    both = pairs.join(sets.select(F.col("class").alias("a"), F.col("s").alias("x")), "a").join(sets.select(F.col("class").alias("b"), F.col("s").alias("y")), "b")
    return classes, both.select("a", "b", likeness(F.col("x"), F.col("y"), threshold).alias("likeness")).where(F.col("likeness") >= threshold)


def range_edges(docs: DataFrame, buckets: int) -> list:
    """Values of _k that cut docs to about equal buckets: quantiles of numbers, or the first values of Spark's own ranges of other types."""
    if isinstance(docs.schema["_k"].dataType, T.NumericType):
        return sorted(set(docs.agg(F.percentile_approx("_k", [i / buckets for i in range(1, buckets)], 10_000)).first()[0] or []))
    return sorted(r["k"] for r in docs.select("_k").repartitionByRange(buckets, "_k").groupBy(F.spark_partition_id()).agg(F.min("_k").alias("k")).collect())[1:]


def with_next(docs: DataFrame, buckets: int) -> DataFrame:
    """docs (doc_id, text) with signatures and fingerprint, and the next document's: next_text, next_signatures.

    The next document is the next smaller doc_id; the first follows the last; a null id comes after all others, and rows
    with one id follow each other by a hash of their texts. Rows are dealt to buckets between
    quantiles of doc_id; a bucket also gets the first row of the bucket that comes after it, and a window finds the next row.
    """
    kind = docs.schema["doc_id"].dataType
    least = F.lit(-(1 << 63)) if isinstance(kind, T.NumericType) else F.lit("")
    docs = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"), F.coalesce("doc_id", least).alias("_k"))
    edges = range_edges(docs, buckets)
    edges = F.array(*map(F.lit, edges)) if edges else F.array().cast(T.ArrayType(docs.schema["_k"].dataType))
    docs = docs.withColumn("_b", F.size(F.filter(edges, lambda e: e <= F.col("_k"))))
    tops = {r["_b"]: r["k"] for r in docs.groupBy("_b").agg(F.max("_k").alias("k")).collect()}  # a row for each bucket
    order = sorted(tops, reverse=True)
    after = {b: order[(i + 1) % len(order)] for i, b in enumerate(order)}
    by_key = Window.partitionBy("_k").orderBy(F.xxhash64("text"))
    heads = docs.where(F.col("_k").isin(list(tops.values()))).withColumn("_n", F.row_number().over(by_key)).where("_n = 1").drop("_n")
    pairs = [F.when(F.col("_b") == b, F.lit(a)) for a, b in after.items()]  # bucket a reads bucket b's head
    guests = heads.withColumn("_b", F.explode(F.array_compact(F.array(*pairs)))) if pairs else heads
    every = docs.withColumn("_last", F.lit(False)).unionByName(guests.withColumn("_last", F.lit(True)))
    spread = with_signatures(every.repartition(F.col("_b")))
    down = Window.partitionBy("_b").orderBy("_last", F.desc("_k"), F.xxhash64("text"))
    led = spread.withColumns({"next_text": F.lead("text").over(down), "next_signatures": F.lead("signatures").over(down)})
    return led.where(~F.col("_last")).select("doc_id", "text", "signatures", "fingerprint", "next_text", "next_signatures")


def edited(text: Column, other: Column) -> Column:
    """text with its last floor(n/2) code points replaced by the first as many (or all) of other."""
    half = F.floor(F.length(text) / 2).cast("int")
    return F.concat(F.substring(text, F.lit(1), F.length(text) - half), F.substring(other, F.lit(1), half))

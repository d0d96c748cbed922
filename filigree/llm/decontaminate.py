"""Benchmark decontamination: a broadcast hash set of normalised test n-grams against every training window.

Built-in functions only. A text is lower-cased (A-Z) and cut into words. Each run of n consecutive benchmark
words is a window, as is a whole item of fewer words. The windows' hashes are joined with the hashes of all
windows of every document; a hit is confirmed word by word. Words inside a confirmed hit can be removed, or
the documents that have one.

The benchmark's windows are measured first: windows of up to broadcast_bytes, words and item ids together, are broadcast;
a larger benchmark is joined by a shuffle: hashes alone first, then the words of windows whose hash was found. A benchmark
that grows changes the join, not the result.

Cases: null or empty texts and texts without words have no words, no hits and are clean. Rows with the same id
and text get the same result. An item without words, or null, matches nothing. Items that share a window are
all counted. An empty benchmark leaves every document clean. Extra columns of docs are kept.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from filigree.llm.common import ascii_lower

#: Characters between words of a lower-cased text; those of a text as it is, and words with what stands before them (fixed values).
GAP = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
OUTSIDE = r"\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F"
CHUNK = rf"[{OUTSIDE}]*[^{OUTSIDE}]+"


def words_of(text: Column) -> Column:
    return F.array_remove(F.split(F.coalesce(ascii_lower(text), F.lit("")), GAP), "")


def window_starts(words: Column, k: int) -> Column:
    """The 1-based positions at which k consecutive words begin; null where there are fewer words."""
    last = F.size(words) - k + 1
    return F.when(last >= 1, F.sequence(F.lit(1), last))


def benchmark_windows(benchmark: DataFrame, n: int = 10) -> DataFrame:
    """(k, hash, gram, items): every window of the benchmark with the items that have it."""
    words = benchmark.select("item_id", words_of(F.col("text")).alias("w")).where(F.size("w") > 0)
    grams = words.select("item_id", F.least(F.size("w"), F.lit(n)).alias("k"), "w").select(
        "item_id", "k", F.explode(F.transform(F.sequence(F.lit(1), F.size("w") - F.col("k") + 1), lambda i: F.slice("w", i, F.col("k")))).alias("gram")
    )
    return grams.groupBy("k", F.xxhash64("gram").alias("hash"), "gram").agg(F.collect_set("item_id").alias("items"))


def find_leaks(docs: DataFrame, benchmark: DataFrame, n: int = 10, broadcast_bytes: int = 64 << 20) -> DataFrame:
    """docs with n_words, hit (1-based positions of hit words), items (ids of the items found).

    Documents are told apart by (doc_id, text), so rows may repeat.
    """
    grams = benchmark_windows(benchmark, n)
    weight = F.length(F.array_join("gram", " ")) + 8 * F.size("items") + 64
    known = {r["k"]: r["n"] for r in grams.groupBy("k").agg(F.sum(weight).alias("n")).collect()}  # at most n rows
    right = grams.select(F.col("k").alias("gk"), F.col("hash").alias("gh"), "gram", "items")
    small = sum(known.values()) <= broadcast_bytes
    if small:
        right = F.broadcast(right)
    clash = [c for c in docs.columns if c in ("n_words", "hit", "items")]
    docs = docs.drop(*clash).withColumn("_key", F.struct(F.col("doc_id").alias("id"), F.xxhash64("text").alias("h"), F.length("text").alias("n")))
    words = docs.select("_key", words_of(F.col("text")).alias("w"))
    found = None
    for k in sorted(known):
        # Windows are hashed after the explode, in compiled code.
        at = words.select("_key", "w", F.explode(window_starts(F.col("w"), k)).alias("pos"))
        own = F.slice("w", F.col("pos"), k)
        if small:
            at, same = at.withColumn("h", F.xxhash64(own)), own == right.gram
        else:  # what is shuffled first are hashes; then, for documents with a hit, the words of its windows
            met = at.select("_key", "pos", F.xxhash64(own).alias("h")).join(right.where(F.col("gk") == k).select(F.col("gh").alias("h")).distinct(), "h", "left_semi")
            places = met.groupBy("_key").agg(F.collect_set("pos").alias("places"))
            at = words.dropDuplicates(["_key"]).join(places, "_key").select("_key", "w", F.explode("places").alias("pos")).select("_key", "pos", own.alias("own"), F.xxhash64(own).alias("h"))
            same = at.own == right.gram
        hits = at.join(right, (at.h == right.gh) & (right.gk == k) & same).select("_key", "pos", F.lit(k).alias("k"), "items")
        found = hits if found is None else found.unionByName(hits)
    counts = words.select("_key", F.size("w").cast("long").alias("n_words"))
    if found is None:
        return docs.join(counts.dropDuplicates(["_key"]), "_key", "left").withColumns({"hit": F.array().cast("array<int>"), "items": F.array().cast(f"array<{benchmark.schema['item_id'].dataType.simpleString()}>")}).drop("_key")
    spans = found.groupBy("_key").agg(
        F.array_sort(F.array_distinct(F.flatten(F.collect_set(F.sequence(F.col("pos"), F.col("pos") + F.col("k") - 1))))).alias("hit"),
        F.array_distinct(F.flatten(F.collect_set("items"))).alias("items"),
    )
    none = F.array().cast("array<int>")
    return (
        docs.withColumn("n_words", F.size(words_of(F.col("text"))).cast("long"))
        .join(spans, "_key", "left")
        .withColumns({"hit": F.coalesce("hit", none), "items": F.coalesce("items", F.array().cast(spans.schema["items"].dataType))})
        .drop("_key")
    )


def decontaminate(docs: DataFrame, benchmark: DataFrame, n: int = 10, remove: str = "documents") -> DataFrame:
    """docs without leaked documents, or (remove="spans") with the leaked words cut out of their texts. Clean rows stay as they are."""
    cols = docs.columns
    found = find_leaks(docs, benchmark, n)
    if remove == "documents":
        return found.where(F.size("hit") == 0).select(*cols)
    chunks = F.regexp_extract_all("text", F.lit(CHUNK), F.lit(0))
    rest = F.regexp_extract("text", rf"[{OUTSIDE}]*\z", 0)
    cut = F.concat(F.array_join(F.filter(chunks, lambda _, i: ~F.array_contains("hit", i + 1)), ""), rest)
    return found.withColumn("text", F.when(F.size("hit") > 0, cut).otherwise(F.col("text"))).select(*cols)

"""How far the sources of a language diverge in their use of terms, by inclusion and exclusion over supports.

Each language keeps the terms of at least MIN_DOCS of its documents (V of them). A group (language, source) gives a kept
term the smoothed share p = 1 + floor(10^9 * (count + 1) / (N + V)), with N its kept occurrences, and a pair of groups
diverges by the sum over all V terms of f(p, q) = floor((p - q)^2 / q). Most of those terms are in neither group or in one,
where the count is 0 and the share is the group's constant p0. So the sum is taken apart:

    V * f(p0, q0)                                   as if no term occurred in either
    + sum over A's terms of f(p, q0) - f(p0, q0)    from the histogram of A's counts
    + sum over B's terms of f(p0, q) - f(p0, q0)    from the histogram of B's counts
    + sum over shared terms of f(p, q) - f(p, q0) - f(p0, q) + f(p0, q0)    from a join of the sparse postings

The join runs on chunks of terms, each with all postings of its terms; a chunk gives one row for each pair of sources, not
one for each term and pair. Texts are counted piece by piece in tasks, so that rows are distinct terms, not words. All
arithmetic is on 64-bit integers, where the sums fit: shares of a group add up to about 10^9.

Cases: null text, lang and source count as ''. Repeated rows count as often as they come; ids are not read. A group without
terms is there, with p0 for all kept terms. A language without kept terms has pairs of value 0. An empty table gives an
empty result. Extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from filigree.llm.common import Workspace, broadcast_if, by_size
from filigree.llm.terms import counted, gaps, gathered

GAP = gaps(rb"[\x00-\x40\x5B-\x60\x7B-\x7F]")
MIN_DOCS, SCALE = 3, 1_000_000_000
#: Postings that a chunk of the join has, about; a term's own postings stay together.
CHUNK = 200_000
#: Groups of which statistics are broadcast; more are joined by a shuffle.
BROADCAST_GROUPS = 100_000
BYTES = 8 << 20


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(lang, source, term, count, docs) of each piece of a partition: a row for each distinct term of a group."""
    for batch in by_size(batches, "text", BYTES):
        keys = pa.StructArray.from_arrays([batch.column(c) for c in ("lang", "source")], ["lang", "source"])
        pairs = [(k["lang"], k["source"]) for k in keys.to_pylist()]
        groups = {p: i for i, p in enumerate(dict.fromkeys(pairs))}
        group = np.array([groups[p] for p in pairs], np.int64)
        found = counted([t or b"" for t in batch.column("text").cast(pa.binary()).to_pylist()], GAP)
        if not len(found.code):
            continue
        key = found.code * len(groups) + group[found.doc]
        order = np.argsort(key, kind="stable")
        at = np.flatnonzero(np.diff(key[order], prepend=-1))
        key = key[order][at]
        data, offsets = found.words(key // len(groups))
        term = pa.StringArray.from_buffers(len(key), pa.py_buffer(offsets.astype(np.int32)), pa.py_buffer(np.ascontiguousarray(data)))
        langs, sources = (pa.array([g[i] for g in groups], pa.string()) for i in (0, 1))
        of = pa.array(key % len(groups))
        yield pa.RecordBatch.from_arrays([langs.take(of), sources.take(of), term, pa.array(np.add.reduceat(found.tf[order], at)), pa.array(np.diff(at, append=len(order)))], ["lang", "source", "term", "count", "docs"])


def term_counts(docs: DataFrame) -> DataFrame:
    """(lang, source, term, count, lang_count, leads) of the terms that a language keeps; leads marks one row of each term."""
    rows = docs.mapInArrow(_count, "lang string, source string, term string, count bigint, docs bigint")
    # One shuffle serves both the sums of groups and those of languages.
    rows = rows.repartition("lang", "term").groupBy("lang", "term", "source").agg(F.sum("count").alias("count"), F.sum("docs").alias("docs"))
    whole = Window.partitionBy("lang", "term")
    return rows.withColumns({"lang_count": F.sum("count").over(whole), "_docs": F.sum("docs").over(whole), "leads": F.row_number().over(whole.orderBy("source")) == 1}).where(F.col("_docs") >= MIN_DOCS).drop("docs", "_docs")


def share(count: Column, n: Column, v: Column) -> Column:
    """A term's smoothed share of a group, in units of 10^-9, and 1 more."""
    return F.call_function("div", SCALE * (count + 1), n + v) + 1


def distance(p: Column, q: Column) -> Column:
    return F.call_function("div", (p - q) * (p - q), q)


def group_statistics(docs: DataFrame, counts: DataFrame) -> DataFrame:
    """(lang, source, n, lang_n, v) of every group of docs, also of those without terms."""
    groups = docs.select("lang", "source").distinct()
    n = counts.groupBy("lang", "source").agg(F.sum("count").alias("n"))
    v = counts.groupBy("lang").agg(F.sum("count").alias("lang_n"), F.sum(F.col("leads").cast("long")).alias("v"))
    return groups.join(n, ["lang", "source"], "left").join(v, "lang", "left").na.fill(0)


def _shared(table: pa.Table) -> pa.Table:
    """Of a chunk's postings: what the terms that two sources share change, a row for each ordered pair of sources."""
    source = table.column("source").combine_chunks().dictionary_encode()
    name, src = source.dictionary, source.indices.to_numpy(zero_copy_only=False).astype(np.int64)
    term = table.column("term").combine_chunks().dictionary_encode().indices.to_numpy(zero_copy_only=False)
    order = np.argsort(term, kind="stable")
    src, term = src[order], term[order]
    count, n, v = (table.column(c).to_numpy()[order] for c in ("count", "n", "v"))
    p, p0 = 1 + SCALE * (count + 1) // (n + v), 1 + SCALE // (n + v)
    start, end = (np.searchsorted(term, term, side) for side in ("left", "right"))
    far = lambda p, q: (p - q) * (p - q) // q
    out = []
    for a in range(len(name)):
        own = np.flatnonzero(src == a)
        b, _ = gathered(np.arange(len(src)), start[own], end[own])
        a_of = np.repeat(own, end[own] - start[own])
        pa_, pa0, q, q0 = p[a_of], p0[a_of], p[b], p0[b]
        total = np.zeros(len(name), np.int64)
        np.add.at(total, src[b], far(pa_, q) - far(pa_, q0) - far(pa0, q) + far(pa0, q0))
        total[a] = 0
        out.append(total)
    value = np.concatenate(out)
    sources = [pa.array(np.repeat(np.arange(len(name)), len(name))), pa.array(np.tile(np.arange(len(name)), len(name)))]
    lang = pa.repeat(table.column("lang")[0], len(value))
    return pa.table([lang, name.take(sources[0]), name.take(sources[1]), pa.array(value)], ["lang", "source", "item", "value"]).filter(pc.not_equal(pa.array(value), 0))


def pairs(counts: DataFrame, groups: DataFrame) -> DataFrame:
    """(lang, source, item, value) of every ordered pair of a language's sources. counts and groups: kept tables."""
    few = broadcast_if(groups, BROADCAST_GROUPS)
    other = few.select("lang", F.col("source").alias("item"), F.col("n").alias("item_n"))
    zero = F.lit(0).cast("long")
    p0, q0 = share(zero, F.col("n"), F.col("v")), share(zero, F.col("item_n"), F.col("v"))
    both = groups.join(other, "lang").where("source <> item")
    whole = both.select("lang", "source", "item", F.when(F.col("v") > 0, F.col("v") * distance(p0, q0)).otherwise(zero).alias("value"))
    # A side's own terms: a row for each count that a group's terms have, so the texts' size doesn't matter.
    histogram = counts.groupBy("lang", "source", "count").agg(F.count("*").alias("terms"))
    rows = histogram.join(few.select("lang", "source", "n", "v"), ["lang", "source"]).join(other, "lang").where("source <> item")
    p = share(F.col("count"), F.col("n"), F.col("v"))
    exact = lambda x: F.sum((F.col("terms") * x).cast("decimal(20,0)"))
    one = rows.groupBy("lang", "source", "item").agg(exact(distance(p, q0) - distance(p0, q0)).alias("to"), exact(distance(q0, p) - distance(q0, p0)).alias("back"))
    sides = one.select("lang", F.explode(F.array(F.struct("source", "item", F.col("to").alias("value")), F.struct(F.col("item").alias("source"), F.col("source").alias("item"), F.col("back").alias("value")))).alias("x")).select("lang", "x.*")
    chunks = counts.count() // CHUNK + 1
    sparse = counts.join(few.select("lang", "source", "n", "v"), ["lang", "source"]).select("lang", "source", "term", "count", "n", "v", F.pmod(F.xxhash64("term"), F.lit(chunks)).alias("chunk"))
    shared = sparse.groupBy("lang", "chunk").applyInArrow(_shared, "lang string, source string, item string, value bigint")
    parts = [x.select("lang", "source", "item", F.col("value").cast("decimal(38,0)").alias("value")) for x in (whole, sides, shared)]
    return parts[0].unionByName(parts[1]).unionByName(parts[2]).groupBy("lang", "source", "item").agg(F.sum("value").cast("bigint").alias("value"))


def leading_terms(counts: DataFrame, groups: DataFrame, most: int) -> DataFrame:
    """(lang, source, item, value, rank) of the terms that a group has a larger share of than its language; the most divergent ones."""
    rows = counts.join(broadcast_if(groups, BROADCAST_GROUPS), ["lang", "source"])
    rows = rows.withColumns({"p": share(F.col("count"), F.col("n"), F.col("v")), "q": share(F.col("lang_count"), F.col("lang_n"), F.col("v"))}).where("p > q")
    rows = rows.select("lang", "source", F.col("term").alias("item"), distance(F.col("p"), F.col("q")).alias("value"))
    return ranked(rows).where(F.col("rank") <= most)


def ranked(rows: DataFrame) -> DataFrame:
    return rows.withColumn("rank", F.row_number().over(Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")))


def audit(docs: DataFrame, most_terms: int = 200) -> DataFrame:
    """(lang, source, part, item, value, rank): part pair has every other source of the language, part term the leading terms."""
    ws = Workspace(docs.sparkSession, "divergence")
    docs = docs.select(*[F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in ("lang", "source", "text")])
    counts = ws.keep(term_counts(docs), "counts")
    groups = ws.keep(group_statistics(docs, counts), "groups")
    parts = [("pair", ranked(pairs(counts, groups))), ("term", leading_terms(counts, groups, most_terms))]
    both = [rows.select("lang", "source", F.lit(part).alias("part"), "item", "value", "rank") for part, rows in parts]
    return both[0].unionByName(both[1])

"""Exact substring dedup: every byte covered by a string of 200 bytes that also starts anywhere else goes.

Suffixes are sorted by a difference-cover algorithm: triples at positions 1 and 2 modulo 3 are sampled and sorted,
their names are sorted recursively, the remaining suffixes are merged in, and adjacent suffixes are compared on their
first 200 bytes. Sorting every suffix of the corpus at once would move some thirty times its bytes, so the corpus is
first cut down, without losing a repeat, to the places where repeats can begin:

1. Every window of 200 bytes has an anchor, the position of its smallest hash of ANCHOR bytes. Equal windows have the
   same anchor at the same offset. Consecutive windows with one anchor occurrence form a stretch; a document of n bytes
   has about n / 50 of them. Windows whose anchor hash occurs once in the corpus are unique.
2. A stretch whose whole content occurs twice is covered whole.
3. What is left are stretches that share their anchor hash with a different stretch. Each distinct one goes once, by its
   anchor hash, to a group of bounded size, and the groups' texts are sorted by the difference-cover algorithm. Groups of
   one hash that outgrow a task are compared window by window, by a shuffle on the windows themselves.

A text that occurs more than once is removed whole, and one of its copies stands for it above. Anchor hashes that repeat,
and the places that stand for a stretch, are told to the scans by three bitmaps, of 256 bits for each such hash up to 2 ** MOST_BITS
in all (32 MB); a bit set by chance costs a row, not a result. A stretch is known by its anchor hash and a 64-bit BLAKE2 digest
of its bytes together, 128 bits; windows of step 3 are compared by their bytes.

Cases: a null text counts as empty. Texts under 200 bytes keep all their bytes. Rows that share an id are told apart by
their texts; equal rows are copies of each other. Extra columns are kept, other than n_bytes, removed and kept. Matches
never cross documents. An empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from filigree.llm.common import Workspace, broadcast_if, by_size, mix, powers

LENGTH, ANCHOR = 200, 100
LEAST_BITS, MOST_BITS = 26, 28
#: A group of stretches holds about so many bytes; a hash with more stretches than MOST_STRETCHES is compared by shuffle.
GROUP_BYTES, MOST_STRETCHES = 600_000, 1_500
_BASE = 0x9E3779B97F4A7C15


class Prefixes:
    """Hashes of any piece of some bytes."""

    _tables: list[np.ndarray] = [np.zeros(0, np.uint64), np.zeros(0, np.uint64)]

    def __init__(self, data: np.ndarray):
        if len(self._tables[0]) <= len(data):
            size = 2 * len(data) + 1024
            Prefixes._tables = [powers(size, _BASE), powers(size, pow(_BASE, -1, 1 << 64))]
        with np.errstate(over="ignore"):
            sums = np.cumsum((data.astype(np.uint64) + np.uint64(1)) * self._tables[0][: len(data)], dtype=np.uint64)
        self.sums = np.concatenate([np.zeros(1, np.uint64), sums])

    def of(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        with np.errstate(over="ignore"):
            return (self.sums[end] - self.sums[start]) * self._tables[1][start]


def stretches(data: np.ndarray, length: int = LENGTH, k: int = ANCHOR) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(anchor hash, content hash, first start, number of starts) of a text's stretches."""
    none = np.zeros(0, np.int64)
    if len(data) < length:
        return none.astype(np.uint64), none.astype(np.uint64), none, none
    pieces = Prefixes(data)
    at = np.arange(len(data) - k + 1)
    grams = mix(pieces.of(at, at + k))
    low = np.uint64((1 << 32) - 1)
    key = (grams & ~low) | at.astype(np.uint64)  # upper half of the hash, then the position: the leftmost smallest
    width, span, least = length - k + 1, 1, key
    while 2 * span <= width:
        least = np.minimum(least[:-span], least[span:])
        span *= 2
    n = len(key) - width + 1
    least = np.minimum(least[:n], least[width - span : width - span + n])
    anchor = (least & low).astype(np.int64)
    first = np.flatnonzero(np.concatenate([[True], anchor[1:] != anchor[:-1]]))
    count = np.diff(np.concatenate([first, [n]]))
    a = anchor[first]
    with np.errstate(over="ignore"):
        shape = ((a - first).astype(np.uint64) << np.uint64(20)) + count.astype(np.uint64)
        content = mix(pieces.of(first, first + count - 1 + length) + mix(shape))
    return grams[a], content, first, count


def suffix_array(text: np.ndarray) -> np.ndarray:
    """The suffixes of positive whole numbers in order, by sampled triples."""
    n = len(text)
    if n < 3:
        return np.array(sorted(range(n), key=lambda i: text[i:].tolist()), np.int64)
    size = int(text.max()) + 1
    pad = np.concatenate([text, np.zeros(4, np.int64)])
    pair = pad[:-1] * size + pad[1:]
    if size > 2_000_000:  # products of three would leave 64 bits: pairs are named first
        pair = np.unique(pair, return_inverse=True)[1]
    n0, n1, n2 = (n + 2) // 3, (n + 1) // 3, n // 3
    sample = np.arange(n + n0 - n1)
    sample = sample[sample % 3 != 0]
    triple = pair[sample] * size + pad[sample + 2]
    order = np.argsort(triple, kind="stable")
    ranked = triple[order]
    name = np.cumsum(np.concatenate([[1], ranked[1:] != ranked[:-1]]))
    where = sample[order]
    names = np.zeros(n0 + n2, np.int64)
    names[np.where(where % 3 == 1, where // 3, where // 3 + n0)] = name
    sorted_names = suffix_array(names) if name[-1] < n0 + n2 else np.argsort(names, kind="stable")
    s12 = np.where(sorted_names < n0, sorted_names * 3 + 1, (sorted_names - n0) * 3 + 2)
    rank = np.zeros(n + 4, np.int64)
    rank[s12] = np.arange(1, len(s12) + 1)
    # The remaining suffixes: by their first number and the rank of what follows; then each finds its place among both samples.
    s0 = s12[s12 % 3 == 1] - 1
    s0 = s0[np.argsort(pad[s0], kind="stable")]
    s12 = s12[s12 < n]
    one, two = s12[s12 % 3 == 1], s12[s12 % 3 == 2]
    short = lambda i: pad[i] * (n + 4) + rank[i + 1]
    long = lambda i: pair[i] * (n + 4) + rank[i + 2]
    place = np.arange(len(s0)) + np.searchsorted(short(one), short(s0)) + np.searchsorted(long(two), long(s0))
    out = np.full(n, -1, np.int64)
    out[place] = s0
    out[out < 0] = s12
    return out


def repeated_starts(texts: list[bytes], counts: list[int], length: int = LENGTH) -> list[np.ndarray]:
    """For each text, which of its first counts[i] windows also start elsewhere in the texts."""
    sizes = np.array([len(t) for t in texts], np.int64)
    flat = np.frombuffer(b"".join(t + b"\x00" for t in texts), np.uint8).astype(np.int64) + 1
    begin = np.cumsum(sizes + 1) - sizes - 1
    valid = np.zeros(len(flat) + 1, np.int64)
    np.add.at(valid, begin, 1)
    np.add.at(valid, begin + np.array(counts), -1)
    valid = np.cumsum(valid)[:-1] > 0
    order = suffix_array(flat)
    order = order[valid[order]]
    pieces = Prefixes(flat.astype(np.uint8))
    heads = pieces.of(order, order + length)
    same = heads[1:] == heads[:-1]
    raw = np.lib.stride_tricks.sliding_window_view(np.concatenate([flat, np.zeros(length, np.int64)]).astype(np.uint8), length)
    maybe = np.flatnonzero(same)
    for at in range(0, len(maybe), 4096):  # equal hashes are compared byte by byte
        own = maybe[at : at + 4096]
        same[own] = (raw[order[own]] == raw[order[own + 1]]).all(1)
    hit = np.zeros(len(flat), bool)
    hit[order] = np.concatenate([same, [False]]) | np.concatenate([[False], same]) if len(order) else False
    return [hit[b : b + c] for b, c in zip(begin.tolist(), counts)]


def ranges(flags: np.ndarray) -> list[dict]:
    edge = np.flatnonzero(np.diff(flags, prepend=False, append=False))
    return [{"a": int(a), "b": int(b)} for a, b in zip(edge[::2], edge[1::2])]


def bitmap(rows: DataFrame) -> np.ndarray:
    """A bitmap with the bit of the upper bits of each h set, sized by the number of rows; gathered as at most 2 ** (MOST_BITS - 6) words."""
    bits = min(MOST_BITS, max(LEAST_BITS, (256 * rows.count()).bit_length()))
    word = F.shiftrightunsigned("h", 64 - bits + 6)
    bit = F.expr(f"shiftleft(1L, cast(shiftrightunsigned(h, {64 - bits}) % 64 as int))")
    got = rows.groupBy(word.alias("w")).agg(F.bit_or(bit).alias("b")).toArrow()
    out = np.zeros(1 << (bits - 6), np.uint64)
    out[got["w"].to_numpy()] = got["b"].to_numpy().astype(np.int64).view(np.uint64)
    return out


def has_bit(words: np.ndarray, h: np.ndarray) -> np.ndarray:
    at = h >> np.uint64(64 - 5 - len(words).bit_length())
    return (words[(at >> np.uint64(6)).astype(np.int64)] >> (at & np.uint64(63))) & np.uint64(1) > 0


def digest_of(body: bytes) -> int:
    return int.from_bytes(hashlib.blake2b(body, digest_size=8).digest(), "little", signed=True)


def repeated_spans(docs: DataFrame, ws: Workspace) -> DataFrame:
    """(doc_id, d, spans): byte spans that repeated strings cover, for documents that have any; d tells rows of one id apart."""
    spark = docs.sparkSession
    rows = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text")).withColumns({"d": F.xxhash64("text"), "n": F.octet_length("text")})
    digest = F.sha2("text", 256)
    same = rows.where(F.col("n") >= LENGTH).groupBy(digest.alias("s")).agg(F.count("*").alias("c"), F.min("doc_id").alias("head")).where("c > 1")
    same = ws.keep(same, "same")
    copies = ws.keep(rows.where(F.col("n") >= LENGTH).select("doc_id", "d", "n", digest.alias("s")).join(same, "s").select("doc_id", "d", "n", (F.col("doc_id") == F.col("head")).alias("is_head")), "copies")
    spare = ws.keep(copies.where("not is_head").select("doc_id", "d").distinct(), "spare")
    source = rows.join(broadcast_if(spare, 1_000_000), ["doc_id", "d"], "left_anti").select("doc_id", "d", "text")

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in by_size(batches, "text"):
            h, c = [], []
            for t in batch.column("text").to_pylist():
                gram, content, _, _ = stretches(np.frombuffer(t.encode(), np.uint8))
                h.append(gram)
                c.append(content)
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(x).view(np.int64)) for x in (h, c)], names=["h", "c"])

    seen = source.select("text").mapInArrow(find, "h bigint, c bigint").groupBy("h").agg(F.count("*").alias("n"), F.min("c").alias("low"), F.max("c").alias("high"))
    seen = ws.keep(seen.where("n > 1").select("h", (F.col("low") != F.col("high")).alias("mixed")), "seen")
    some, mixed = bitmap(seen.select("h")), bitmap(seen.where("mixed").select("h"))
    shared = spark.sparkContext.broadcast((some, mixed))

    def tell(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        some, mixed = shared.value
        for batch in by_size(batches, "text"):
            index, hashes, digests, starts, counts, bodies = [], [], [], [], [], []
            for i, t in enumerate(batch.column("text").to_pylist()):
                raw = t.encode()
                gram, _, first, count = stretches(np.frombuffer(raw, np.uint8))
                keep = has_bit(some, gram)
                gram, first, count = gram[keep], first[keep], count[keep]
                index += [i] * len(gram)
                hashes.append(gram.view(np.int64))
                starts.append(first)
                counts.append(count)
                for f, c, b in zip(first.tolist(), count.tolist(), has_bit(mixed, gram).tolist()):
                    body = raw[f : f + c - 1 + LENGTH]
                    digests.append(digest_of(body))
                    bodies.append(body if b else None)
            take = pa.array(index, pa.int64())
            h, start, count = (pa.array(np.concatenate(x).astype(np.int64)) for x in (hashes, starts, counts))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id").take(take), batch.column("d").take(take), h, pa.array(digests, pa.int64()), start, count, pa.array(bodies, pa.binary())], names=["doc_id", "d", "h", "c", "start", "count", "body"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    hits = ws.keep(source.mapInArrow(tell, f"doc_id {kind}, d bigint, h bigint, c bigint, start bigint, count bigint, body binary"), "hits")
    place = F.xxhash64("doc_id", "d", "start")
    times = ws.keep(hits.groupBy("h", "c").agg(F.count("*").alias("times"), F.min(place).alias("u")), "times")

    # Stretches of one hash that differ: each once, from one of the places where it stands. A bitmap of those places
    # keeps the other copies out of the shuffle on (h, c), which brings together what a bit has let through by chance.
    various = times.groupBy("h").agg(F.count("*").alias("m")).where("m > 1")
    wanted = ws.keep(times.join(various, "h").select("h", "c", "m", "u"), "wanted")
    chosen = spark.sparkContext.broadcast(bitmap(wanted.select(F.col("u").alias("h"))))

    def pick(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield batch.filter(pa.array(has_bit(chosen.value, batch.column("u").to_numpy().view(np.uint64))))

    picked = hits.where("body is not null").select(place.alias("u"), "c", "h", "count", "body").mapInArrow(pick, "u bigint, c bigint, h bigint, count bigint, body binary").drop("u")
    bodies = picked.join(wanted.select("h", "c", "m"), ["h", "c"]).groupBy("h", "c").agg(F.max("m").alias("m"), F.max(F.struct("count", "body")).alias("x"))
    bodies = ws.keep(bodies.select("h", "c", "m", "x.count", "x.body"), "bodies")
    total = bodies.agg(F.sum(F.length("body"))).first()[0] or 0
    groups = int(max(1, total // GROUP_BYTES))

    def sort(group: pa.Table) -> pa.Table:
        hits_ = repeated_starts(group.column("body").to_pylist(), group.column("count").to_pylist())
        found = [ranges(x) for x in hits_]
        keep = pa.array([bool(x) for x in found], pa.bool_())
        return pa.table([group.column("h"), group.column("c"), pa.array(found, pa.list_(pa.struct([("a", pa.int64()), ("b", pa.int64())])))], names=["h", "c", "ranges"]).filter(keep)

    spans = "array<struct<a:bigint,b:bigint>>"
    small = bodies.where(F.col("m") <= MOST_STRETCHES).select(F.pmod("h", F.lit(groups)).alias("g"), "h", "c", "count", "body").groupBy("g").applyInArrow(sort, f"h bigint, c bigint, ranges {spans}")
    big = bodies.where(F.col("m") > MOST_STRETCHES).select("h", "c", "body", F.explode(F.sequence(F.lit(0).cast("long"), F.col("count") - 1)).alias("a"))
    big = big.select("h", "c", "a", F.substring("body", (F.col("a") + 1).cast("int"), F.lit(LENGTH)).alias("w")).withColumn("k", F.xxhash64("w"))
    # Hashes of windows go first; the windows themselves only where a hash comes again.
    again = big.groupBy("k").agg(F.count("*").alias("n")).where("n > 1").select("k")
    big = big.join(again, "k", "left_semi")
    twice = big.groupBy("w").agg(F.count("*").alias("n")).where("n > 1").select("w")
    large = big.join(twice, "w").groupBy("h", "c").agg(F.collect_list(F.struct("a", (F.col("a") + 1).alias("b"))).alias("ranges"))
    parts = ws.keep(small.unionByName(large).join(times.where("times = 1").select("h", "c"), ["h", "c"], "left_semi"), "parts")
    # What is known of a stretch: that it repeats whole (no ranges), or which of its windows repeat.
    known = times.where("times > 1").select("h", "c", F.lit(None).cast(spans).alias("ranges"), "times").unionByName(parts.withColumn("times", F.lit(1).cast("long")))
    # A stretch that stands in very many places goes to several tasks: there are few of these, four for each partition at most.
    share = max(1, (times.agg(F.sum("times")).first()[0] or 0) // (4 * int(spark.conf.get("spark.sql.shuffle.partitions"))))
    salts = F.ceil(F.col("times") / share).cast("int")
    hot = F.broadcast(times.where(F.col("times") > share).select("h", "c", salts.alias("_salts")))
    known = known.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.when(F.col("times") > share, salts).otherwise(1) - 1))).drop("times")
    placed = hits.select("doc_id", "d", "h", "c", "start", "count").join(hot, ["h", "c"], "left").withColumn("_salt", F.pmod(F.xxhash64("doc_id", "start"), F.coalesce("_salts", F.lit(1))).cast("int"))
    whole = F.array(F.struct(F.lit(0).cast("long").alias("a"), F.col("count").alias("b")))
    told = placed.join(known, ["h", "c", "_salt"]).select("doc_id", "d", "start", F.explode(F.coalesce("ranges", whole)).alias("r"))
    told = told.select("doc_id", "d", F.struct((F.col("start") + F.col("r.a")).alias("a"), (F.col("start") + F.col("r.b") - 1 + LENGTH).alias("b")).alias("span"))
    full = copies.select("doc_id", "d", F.struct(F.lit(0).cast("long").alias("a"), F.col("n").cast("long").alias("b")).alias("span")).distinct()
    return told.unionByName(full).groupBy("doc_id", "d").agg(F.collect_list("span").alias("spans"))


def remove_repeats(docs: DataFrame) -> DataFrame:
    """docs with n_bytes, removed (maximal byte spans, array<struct<a, b>>) and kept (the bytes left, binary)."""
    ws = Workspace(docs.sparkSession, "suffixes")
    cols = [c for c in docs.columns if c not in ("n_bytes", "removed", "kept")]
    spans = repeated_spans(docs, ws)
    # Spans are merged where they meet before they go to the texts.
    zero = F.array().cast("array<struct<a:bigint,b:bigint>>")

    def merge(table: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind = pa.list_(pa.struct([("a", pa.int64()), ("b", pa.int64())]))
        for batch in table:
            out = []
            for own in batch.column("spans").to_pylist():
                a = np.array(sorted((s["a"], s["b"]) for s in own), np.int64)
                reach = np.maximum.accumulate(a[:, 1])
                new = np.concatenate([[True], a[1:, 0] > reach[:-1]])
                ends = np.concatenate([np.flatnonzero(new)[1:] - 1, [len(a) - 1]])
                out.append([{"a": int(x), "b": int(y)} for x, y in zip(a[new, 0], reach[ends])])
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("d"), pa.array(out, kind)], names=["doc_id", "d", "removed"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    merged = ws.keep(spans.mapInArrow(merge, f"doc_id {kind}, d bigint, removed array<struct<a:bigint,b:bigint>>"), "merged")
    ws.keep_only(merged)
    merged = merged.withColumnRenamed("doc_id", "_id")
    rows = docs.select(*cols).withColumn("_raw", F.coalesce("text", F.lit("")).cast("binary")).withColumn("_d", F.xxhash64(F.coalesce("text", F.lit(""))))
    # Only texts that lose something are shuffled to their spans.
    keys = broadcast_if(merged.select("_id", "d"), 1_000_000)
    match = lambda m: rows["doc_id"].eqNullSafe(m["_id"]) & (rows["_d"] == m["d"])
    cut = rows.join(keys, match(keys), "left_semi")
    cut = cut.join(merged, cut["doc_id"].eqNullSafe(merged["_id"]) & (cut["_d"] == merged["d"])).drop("_id", "d")
    joined = cut.unionByName(rows.join(keys, match(keys), "left_anti").withColumn("removed", zero))
    starts = F.concat(F.array(F.lit(0).cast("long")), F.transform("removed", lambda s: s["b"]))
    ends = F.concat(F.transform("removed", lambda s: s["a"]), F.array(F.octet_length("_raw").cast("long")))
    pieces = F.zip_with(starts, ends, lambda a, b: F.hex(F.substring(F.col("_raw"), (a + 1).cast("int"), (b - a).cast("int"))))
    kept = F.when(F.size("removed") == 0, F.col("_raw")).otherwise(F.unhex(F.array_join(pieces, "")))
    return joined.select(*cols, F.octet_length("_raw").cast("long").alias("n_bytes"), "removed", kept.alias("kept"))

"""MinHash near-duplicate detection with sequential Bayesian verification.

A document's set holds its distinct shingles of five words. Documents with equal sets are one class, known by a
128-bit digest of the set, and only a class's document with the smallest id goes on. Its MinHash signature is
cut into bands; documents that share a band are candidates. A candidate pair's signatures are compared batch by
batch: after each batch the posterior probability that the pair's similarity reaches the threshold (uniform
prior) is bounded, and a pair falls out once that is below the chosen miss probability. Survivors are verified
exactly, on the full sets of both texts. Links make components.

Candidates of a bucket are not paired with each other. First every member is paired with the bucket's centre, a
member that shares many buckets with many others. Buckets that then still hold more than one component are dealt to
blocks of signatures, and pairs of blocks find by the same sequential test which members may still link with another
component. Only the texts of these are read: dealt to blocks again, pairs of blocks compare their sets exactly by one
matrix product, returning no more links than connect their components. No link between components is lost, and no pair
becomes a row unless it links.

Bands: 24 of 5 values. A pair at the threshold of 0.85 shares no band with a probability of 8e-7; a similarity
of 0.8 with 7e-5. Nothing is capped.

Cases: null and empty texts and texts without words have an empty set and link with nothing; a text of fewer than
five words has its whole sequence as its one shingle. Rows with a null id are kept and get a null component. Rows
that share an id are one document for linking, by any of its texts. Ids may be of any type that can be ordered. An empty table gives an empty result. deduplicate() keeps extra
columns; near_duplicates() returns its own four.
"""

from __future__ import annotations

from collections.abc import Iterator
from math import comb

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from filigree.llm.common import Words, Workspace, broadcast_if, by_size, connected, mix

BANDS, VALUES, BATCH = 24, 5, 24
SPACE = np.isin(np.arange(256), [9, 10, 11, 12, 13, 32])
#: Up to so many ids of documents to verify are broadcast to the scan; more are joined by a shuffle.
BROADCAST_IDS = 1_000_000
#: A block of a bucket holds about so many documents and characters.
BLOCK_DOCS, BLOCK_CHARS = 256, 2_000_000
#: A block of signatures holds about so many.
BLOCK_SIGNATURES = 1024


def shingle_sets(texts: list[str | None], n: int = 5) -> list[np.ndarray]:
    """The sorted distinct shingle hashes of each text."""
    words = Words([(t or "").encode("utf-8", "surrogatepass").lower() for t in texts], SPACE)  # bytes.lower() changes A-Z only
    with np.errstate(over="ignore"):
        factor = np.array([pow(0x9E3779B97F4A7C15, i + 1, 1 << 64) for i in range(n)], np.uint64)
        full = np.zeros(max(len(words.hash) - n + 1, 0), np.uint64)
        for i in range(n):
            full += words.hash[i : i + len(full)] * factor[i]
        full = mix(full)
        out, first = [], 0
        for count in words.count.tolist():
            if count >= n:
                out.append(np.unique(full[first : first + count - n + 1]))
            elif count:
                out.append(mix((words.hash[first : first + count] * factor[:count]).sum(dtype=np.uint64, keepdims=True) + np.uint64(count)))
            else:
                out.append(np.zeros(0, np.uint64))
            first += count
    return out


def hash_family(k: int, seed: int = 7) -> tuple[np.ndarray, np.ndarray]:
    rng = np.random.default_rng(seed)
    return rng.integers(0, 1 << 63, k, dtype=np.uint64) * np.uint64(2) + np.uint64(1), rng.integers(0, 1 << 63, k, dtype=np.uint64)


def signature(shingles: np.ndarray, family: tuple[np.ndarray, np.ndarray]) -> np.ndarray:
    """The least value of each hash function over the set, 32 bits each."""
    a, b = family
    least = np.full(len(a), 0xFFFFFFFF, np.uint64)
    with np.errstate(over="ignore"):
        for at in range(0, len(shingles), 4096):
            np.minimum(least, ((shingles[at : at + 4096, None] * a + b) >> np.uint64(32)).min(0), out=least)
    return least.astype(np.uint32)


def least_matches(threshold: float, total: int, batch: int, miss: float) -> list[tuple[int, int]]:
    """(values compared, fewest matches to go on): below, the posterior of similarity >= threshold is under miss.

    With a uniform prior and m of n matches the posterior is Beta(m + 1, n - m + 1); its tail above the threshold
    equals the chance of at most m successes in n + 1 trials.
    """
    out = []
    for n in [*range(batch, total, batch), total]:
        tail, m = 0.0, 0
        while (tail := tail + comb(n + 1, m) * threshold**m * (1 - threshold) ** (n + 1 - m)) < miss:
            m += 1
        out.append((n, m))
    return out


def sketches(docs: DataFrame, bands: int = BANDS, values: int = VALUES) -> DataFrame:
    """(doc_id, n_shingles, digest, signature): digest and signature are null for an empty set."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        family = hash_family(bands * values)
        for batch in by_size(batches, "text"):
            sizes, digests, signs = [], [], []
            for s in shingle_sets(batch.column("text").to_pylist()):
                sizes.append(len(s))
                digests.append(np.array([s.sum(dtype=np.uint64), mix(s ^ np.uint64(0x5851F42D4C957F2D)).sum(dtype=np.uint64)]).tobytes() if len(s) else None)
                signs.append(signature(s, family).tobytes() if len(s) else None)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(sizes, pa.int64()), pa.array(digests, pa.binary()), pa.array(signs, pa.binary())], names=["doc_id", "n_shingles", "digest", "signature"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(run, f"doc_id {kind}, n_shingles bigint, digest binary, signature binary")


def plausible(pairs: DataFrame, signed: DataFrame, threshold: float, miss: float, bands: int, values: int) -> DataFrame:
    """The (u, v) pairs whose signatures leave the threshold in reach."""
    both = pairs.join(signed.select(F.col("id").alias("u"), F.col("signature").alias("a")), "u").join(signed.select(F.col("id").alias("v"), F.col("signature").alias("b")), "v")
    steps = least_matches(threshold, bands * values, BATCH, miss)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            a, b = (np.frombuffer(b"".join(batch.column(c).to_pylist()), np.uint32).reshape(batch.num_rows, -1) for c in ("a", "b"))
            live, done, matches = np.arange(batch.num_rows), 0, np.zeros(batch.num_rows, np.int64)
            for n, least in steps:
                matches[live] += (a[live, done:n] == b[live, done:n]).sum(1)
                live, done = live[matches[live] >= least], n
            yield batch.select(["u", "v"]).take(pa.array(live))

    return both.select("u", "v", "a", "b").mapInArrow(run, pairs.select("u", "v").schema)


def similar(pairs: DataFrame, texts: DataFrame, percent: int) -> DataFrame:
    """The (u, v) pairs with 100 * intersection >= percent * union of their full sets."""
    both = pairs.join(texts.select(F.col("id").alias("u"), F.col("text").alias("a")), "u").join(texts.select(F.col("id").alias("v"), F.col("text").alias("b")), "v")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in by_size(batches, "b", 1 << 20):
            for batch in by_size([whole], "a", 1 << 20):
                keep = []
                for i, (x, y) in enumerate(zip(shingle_sets(batch.column("a").to_pylist()), shingle_sets(batch.column("b").to_pylist()))):
                    common = len(np.intersect1d(x, y, assume_unique=True))
                    if common and 100 * common >= percent * (len(x) + len(y) - common):
                        keep.append(i)
                yield batch.select(["u", "v"]).take(pa.array(keep, pa.int64()))

    return both.select("u", "v", "a", "b").mapInArrow(run, pairs.select("u", "v").schema)


def dealt(sized: DataFrame, need: DataFrame, carried: list[str]) -> DataFrame:
    """The (bucket, id, ...) rows dealt to pairs (i, j) of their bucket's blocks, of which need has the number."""
    sized = sized.join(broadcast_if(need, BROADCAST_IDS), "bucket").withColumn("mine", F.pmod(F.xxhash64("id", "bucket"), F.col("blocks")).cast("int"))
    other = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))
    return sized.withColumn("other", other).select("bucket", F.least("mine", "other").alias("i"), F.greatest("mine", "other").alias("j"), *carried)


def undecided(ws: Workspace, mixed: DataFrame, signed: DataFrame, threshold: float, miss: float, bands: int, values: int) -> DataFrame:
    """The (bucket, id, c) rows whose signatures leave a link with another component of their bucket in reach."""
    steps = least_matches(threshold, bands * values, BATCH, miss)
    need = ws.keep(mixed.groupBy("bucket").agg(F.ceil(F.count("*") / BLOCK_SIGNATURES).cast("int").alias("blocks")), "blocks")
    rows = dealt(mixed.join(signed.select("id", "signature"), "id"), need, ["id", "c", "signature"])

    def run(group: pa.Table) -> pa.Table:
        signs = np.frombuffer(b"".join(group.column("signature").to_pylist()), np.uint32).reshape(group.num_rows, -1)
        _, part = np.unique(np.array(group.column("c").to_pylist(), object).astype(str), return_inverse=True)
        live = np.zeros(group.num_rows, bool)
        first, least = steps[0]
        for a in range(0, group.num_rows if part.any() else 0, 128):
            matches = np.zeros((len(part[a : a + 128]), group.num_rows), np.int16)
            for k in range(first):
                matches += signs[a : a + 128, k, None] == signs[None, :, k]
            x, y = np.nonzero((matches >= least) & (part[a : a + 128, None] != part[None, :]))
            n, done = matches[x, y].astype(np.int64), first
            for upto, enough in steps[1:]:
                n += (signs[a + x, done:upto] == signs[y, done:upto]).sum(1)
                on = n >= enough
                x, y, n, done = x[on], y[on], n[on], upto
            live[a + x] = live[y] = True
        return group.select(["bucket", "id", "c"]).filter(pa.array(live))

    return rows.groupBy("bucket", "i", "j").applyInArrow(run, mixed.select("bucket", "id", "c").schema).distinct()


def blockwise(ws: Workspace, mixed: DataFrame, texts: DataFrame, percent: int) -> DataFrame:
    """Links (u, v) between different components (c) of each bucket of the (bucket, id, c) rows.

    A bucket's members are dealt to blocks of bounded number and bounded text, and each pair of blocks is one task's
    group, so no group grows with its bucket. Within it the sizes of all intersections come from one product of the
    0/1 matrix of documents and shared shingles, and only as many links as connect its components are returned.
    """
    sized = mixed.join(texts.select("id", F.length("text").alias("_n")), "id")
    need = ws.keep(sized.groupBy("bucket").agg(F.greatest(F.ceil(F.count("*") / BLOCK_DOCS), F.ceil(F.sum("_n") / BLOCK_CHARS)).cast("int").alias("blocks")), "blocks")
    rows = dealt(mixed.join(texts, "id"), need, ["id", "c", "text"])

    def run(group: pa.Table) -> pa.Table:
        ids, parts = group.column("id").to_pylist(), group.column("c").to_pylist()
        root = {c: c for c in parts}

        def top(c):
            while root[c] != c:
                root[c] = c = root[root[c]]
            return c

        u, v = [], []
        if len(root) > 1:
            sets = shingle_sets(group.column("text").to_pylist())
            for x, y in zip(*np.nonzero(np.triu(reaching(sets, percent), 1))):
                a, b = top(parts[x]), top(parts[y])
                if a != b:
                    root[max(a, b)] = min(a, b)
                    u.append(min(ids[x], ids[y]))
                    v.append(max(ids[x], ids[y]))
        kind = group.schema.field("id").type
        return pa.table([pa.array(u, kind), pa.array(v, kind)], names=["u", "v"])

    kind = mixed.schema["id"].dataType.simpleString()
    return rows.groupBy("bucket", "i", "j").applyInArrow(run, f"u {kind}, v {kind}").distinct()


def reaching(sets: list[np.ndarray], percent: int) -> np.ndarray:
    """For each two of the sets, whether 100 * intersection >= percent * union; empty sets reach nothing."""
    sizes = np.array([len(s) for s in sets])
    _, column, count = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    row = np.repeat(np.arange(len(sets)), sizes)
    shared = count > 1
    number = np.cumsum(shared) - 1
    keep = shared[column]
    row, column = row[keep], number[column[keep]]
    order = np.argsort(column, kind="stable")
    row, column = row[order], column[order]
    common = np.zeros((len(sets), len(sets)), np.float32)
    for a in range(0, int(shared.sum()), 4096):
        lo, hi = np.searchsorted(column, [a, a + 4096])
        has = np.zeros((len(sets), 4096), np.float32)
        has[row[lo:hi], column[lo:hi] - a] = 1
        common += has @ has.T
    return (common > 0) & (100 * common >= percent * (sizes[:, None] + sizes[None, :] - common))


def near_duplicates(docs: DataFrame, percent: int = 85, miss: float = 1e-7, bands: int = BANDS, values: int = VALUES) -> DataFrame:
    """One row for each of docs: doc_id, n_shingles, component_id (smallest id reachable over links, its own included), kept (it is that id)."""
    ws = Workspace(docs.sparkSession, "neardup")
    rows = docs.select("doc_id", "text")
    drawn = ws.keep(sketches(rows, bands, values), "sketches")
    # One document for each set; its id is the smallest.
    heads = drawn.where("digest is not null and doc_id is not null").groupBy("digest", "n_shingles").agg(F.min(F.struct("doc_id", "signature")).alias("x"))
    heads = ws.keep(heads.select("digest", "n_shingles", F.col("x.doc_id").alias("id"), F.col("x.signature").alias("signature")), "heads")

    width = 4 * values
    bucket = F.transform(F.sequence(F.lit(0), F.lit(bands - 1)), lambda i: F.xxhash64(i, F.substring("signature", i * width + 1, F.lit(width))))
    banded = heads.select("id", F.explode(bucket).alias("bucket"))
    sizes = banded.groupBy("bucket").agg(F.count("*").alias("n")).where("n > 1")
    members = ws.keep(banded.join(sizes, "bucket"), "members")
    # A bucket's centre is the member that shares the most buckets with the most others: of a group of copies, the
    # text that the others were made from rather than one of them.
    weight = members.groupBy("id").agg(F.sum("n").alias("w"))
    centre = members.join(weight, "id").groupBy("bucket").agg(F.max(F.struct("w", "id")).alias("x")).select("bucket", F.col("x.id").alias("low"))

    def texts_of(ids: DataFrame) -> DataFrame:
        ids = broadcast_if(ws.keep(ids.distinct(), "ids"), BROADCAST_IDS)
        return ws.keep(rows.select(F.col("doc_id").alias("id"), "text").join(ids, "id", "left_semi").distinct(), "texts")

    pairs = ws.keep(members.join(centre, "bucket").where("id <> low").select(F.least("low", "id").alias("u"), F.greatest("low", "id").alias("v")).distinct(), "pairs")
    left = ws.keep(plausible(pairs, heads, percent / 100, miss, bands, values), "plausible")
    first = ws.keep(similar(left, texts_of(left.select(F.explode(F.array("u", "v")).alias("id"))), percent), "links")
    found = connected(ws, first)
    # Buckets that still hold more than one component are compared whole, block by block.
    placed = members.select("bucket", "id").join(found, "id", "left").select("bucket", "id", F.coalesce("component", "id").alias("c"))
    placed = ws.keep(placed, "placed")
    parts = placed.groupBy("bucket").agg(F.min("c").alias("low"), F.max("c").alias("high")).where("low < high").select("bucket")
    mixed = ws.keep(placed.join(broadcast_if(ws.keep(parts, "parts"), BROADCAST_IDS), "bucket"), "mixed")
    mixed = ws.keep(undecided(ws, mixed, heads, percent / 100, miss, bands, values), "undecided")
    second = ws.keep(blockwise(ws, mixed, texts_of(mixed.select("id")), percent), "links")
    if not second.isEmpty():
        found = connected(ws, first.unionByName(second))

    classes = ws.keep(heads.select("digest", "n_shingles", "id").join(found, "id", "left").select("digest", "n_shingles", F.coalesce("component", "id").alias("component_id")), "classes")
    ws.keep_only(drawn, classes)
    result = drawn.where("digest is not null and doc_id is not null").select("doc_id", "n_shingles", "digest").join(classes, ["digest", "n_shingles"]).select("doc_id", "n_shingles", "component_id")
    alone = drawn.where("digest is null or doc_id is null").select("doc_id", "n_shingles", F.col("doc_id").alias("component_id"))
    return result.unionByName(alone).withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)))


def deduplicate(docs: DataFrame, percent: int = 85) -> DataFrame:
    """docs with one document of each component, the one with the smallest id; rows without an id stay."""
    ws = Workspace(docs.sparkSession, "deduplicate")
    gone = ws.keep(near_duplicates(docs, percent).where("not kept").select("doc_id").distinct(), "gone")
    return docs.join(broadcast_if(gone, BROADCAST_IDS), "doc_id", "left_anti").select(*docs.columns)

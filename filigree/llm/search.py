"""Ranked lexical search with block-max pruning (Block-Max WAND), over an index that is a table.

build() turns documents into segments: each task takes its documents, some SEGMENT bytes of text at a time, and writes a row
for every term of them. A row holds the term's postings in compressed blocks of BLOCK documents, each of bytes as wide as its
largest gap and count need, and for each block a header (first and last document, place of its bytes) and its maximum impacts:
the pairs of count and length that no other posting of the block beats in both. Whatever the corpus's averages become, one
of these pairs has the block's greatest impact, so that segments stay right when more are added. A segment's documents are
numbered in the order of their ids. Nothing is shuffled.

search() takes items in blocks of a bounded size. The postings of a block's terms come together by segment; a task goes
through its segments and keeps the best k documents of each item and with them a threshold that later segments start from.
In a segment the ends of all blocks of an item's terms part the documents into windows, within which no list changes its
block. Shallow pointers move through headers only and give each window the sum of its blocks' maxima. Windows whose sum
stays below the threshold are skipped, their blocks never decompressed; others are taken by falling sum, so that the
threshold rises early, and their documents are scored exactly. Decompressed blocks serve all items of the block.

Scores: see impact() and weights(). Words are compared by a 64-bit hash within a task and by their text across tasks.

Cases: null and empty texts have no terms and count for nothing. Repeated rows are documents of their own, under the same
id. Ids may be of any ordered type; null comes first among equal scores. Items without terms, or with none that occurs,
have no rows; each row of a repeated item is ranked by itself. Empty tables give empty results. Extra columns are ignored.
"""

from __future__ import annotations

import math
from bisect import bisect_left
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from filigree.llm.common import Workspace, ascii_lower, by_size
from filigree.llm.terms import Postings, counted, gaps, merged

TERM = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
GAP = gaps(rb"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]")
BLOCK, SEGMENT, SEGMENT_DOCS = 64, 16 << 20, 1 << 20
#: A block of items has at most so many items and terms, unless one item has more.
ITEMS, ITEM_TERMS = 1_000, 100_000
HEAD = np.dtype([("first", "<u4"), ("last", "<u4"), ("at", "<u4"), ("pairs", "<u4"), ("count", "<u2"), ("gap_width", "u1"), ("tf_width", "u1")])
PAIR = np.dtype([("n", "<u4"), ("tf", "<u4")])


def damping(n: np.ndarray, docs: int, terms: int) -> np.ndarray:
    """8 * m of documents of n terms, among so many documents with so many terms."""
    return 8 * (100 - 90 + (90 * n * docs) // terms)


def impact(tf: np.ndarray, damped: np.ndarray) -> np.ndarray:
    return (1_000_000_000 * tf) // (1000 * tf + damped)


def weight(docs: int, df: int) -> int:
    return math.floor(1000 * math.log((2 * docs + 2) / (2 * df + 1)))


# ---- index -------------------------------------------------------------------------------------


def _width(most: np.ndarray) -> np.ndarray:
    """Bytes that hold values up to most: 1, 2 or 4."""
    return 1 + (most > 0xFF) + 2 * (most > 0xFFFF).astype(np.int64)


def _slices(kind: pa.DataType, data: np.ndarray, offsets: np.ndarray) -> pa.Array:
    """Text or binary cells: the slices of data between the offsets."""
    return pa.Array.from_buffers(kind, len(offsets) - 1, [None, pa.py_buffer(offsets.astype(np.int32)), pa.py_buffer(np.ascontiguousarray(data))])


def _segment(name: str, ids: list, found: Postings, schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    """A segment's rows: one with its documents, under the term '', and one for each term."""
    order = np.array(sorted(range(len(ids)), key=lambda i: (ids[i] is not None, ids[i])), np.int64)
    place = np.empty(len(ids), np.int64)
    place[order] = np.arange(len(ids))
    n = np.zeros(len(ids), np.int64)
    np.add.at(n, place[found.doc], found.tf)
    head = {"term": [""], "n_docs": [int((n > 0).sum())], "n_terms": [int(n.sum())], "ids": [[ids[i] for i in order]], "lengths": [n.astype("<u4").tobytes()]}
    yield _batch(name, 1, {k: pa.array(v, schema.field(k).type) for k, v in head.items()}, schema)
    if not len(found.code):
        return
    terms = len(found.hash)
    data, offsets = found.words(np.arange(terms))
    words = [data[a:b].tobytes() for a, b in zip(offsets.tolist(), offsets[1:].tolist())]
    by_word = np.array(sorted(range(terms), key=words.__getitem__), np.int64)
    rank = np.empty(terms, np.int64)
    rank[by_word] = np.arange(terms)
    code, doc = rank[found.code], place[found.doc]
    order = np.lexsort((doc, code))
    code, doc, tf = code[order], doc[order], found.tf[order]
    df = np.bincount(code, minlength=terms)
    first = np.concatenate([np.zeros(1, np.int64), np.cumsum(df)])
    new = (np.arange(len(code)) - first[code]) % BLOCK == 0
    starts = np.flatnonzero(new)
    block = np.cumsum(new) - 1
    count = np.diff(starts, append=len(code))
    gap = np.where(new, 0, np.diff(doc, prepend=0))
    gap_width, tf_width = _width(np.maximum.reduceat(gap, starts)), _width(np.maximum.reduceat(tf, starts))
    ends = np.concatenate([np.zeros(1, np.int64), np.cumsum(count * (gap_width + tf_width))])
    packed, within = np.zeros(ends[-1], np.uint8), np.arange(len(code)) - starts[block]
    for values, width, base in ((gap, gap_width, ends[:-1]), (tf, tf_width, ends[:-1] + count * gap_width)):
        at = base[block] + within * width[block]
        for k in range(4):
            some = width[block] > k
            packed[at[some] + k] = (values[some] >> (8 * k)) & 0xFF
    # The pairs of a block that no shorter document with as high a count beats.
    order = np.lexsort((-tf, n[doc], block))
    high = np.maximum.accumulate(tf[order] + block[order] * (tf.max() + 1))
    best = np.diff(high, prepend=-1) > 0
    pairs = np.zeros(int(best.sum()), PAIR)
    pairs["n"], pairs["tf"] = n[doc[order][best]], tf[order][best]
    pair_ends = np.concatenate([np.zeros(1, np.int64), np.cumsum(np.add.reduceat(best.astype(np.int64), starts))])
    block_of = np.searchsorted(starts, first)  # a term's first block
    own = code[starts]
    heads = np.zeros(len(starts), HEAD)
    heads["first"], heads["last"], heads["count"], heads["gap_width"], heads["tf_width"] = doc[starts], doc[starts + count - 1], count, gap_width, tf_width
    heads["at"], heads["pairs"] = ends[:-1] - ends[block_of[own]], pair_ends[:-1] - pair_ends[block_of[own]]
    data, offsets = found.words(by_word)
    columns = {
        "term": _slices(pa.string(), data, offsets), "df": pa.array(df.astype(np.int32)), "heads": _slices(pa.binary(), heads.view(np.uint8), block_of * HEAD.itemsize),
        "impacts": _slices(pa.binary(), pairs.view(np.uint8), pair_ends[block_of] * PAIR.itemsize), "data": _slices(pa.binary(), packed, ends[block_of]),
    }
    yield _batch(name, terms, columns, schema)


def _batch(name: str, rows: int, columns: dict, schema: pa.Schema) -> pa.RecordBatch:
    columns["segment"] = pa.repeat(name, rows)
    return pa.RecordBatch.from_arrays([columns[f.name] if f.name in columns else pa.nulls(rows, f.type) for f in schema], schema=schema)


def index_schema(id_type: T.DataType) -> T.StructType:
    names = [("segment", T.StringType()), ("term", T.StringType()), ("df", T.IntegerType()), ("n_docs", T.LongType()), ("n_terms", T.LongType()), ("ids", T.ArrayType(id_type)), *((c, T.BinaryType()) for c in ("lengths", "heads", "impacts", "data"))]
    return T.StructType([T.StructField(n, t) for n, t in names])


def build(docs: DataFrame, run: str = "") -> DataFrame:
    """The index of docs (doc_id, text): segment, term, df, blocks. run: a name of the run, where its rows join those of others."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task = TaskContext.get().partitionId()
        parts, ids, held, n, schema = [], [], 0, 0, None
        for batch in by_size(batches, "text"):
            if schema is None:
                kinds = {"df": pa.int32(), "n_docs": pa.int64(), "n_terms": pa.int64(), "ids": pa.list_(batch.column("doc_id").type), "segment": pa.string(), "term": pa.string()}
                schema = pa.schema([(c, kinds.get(c, pa.binary())) for c in ("segment", "term", "df", "n_docs", "n_terms", "ids", "lengths", "heads", "impacts", "data")])
            texts = [t or b"" for t in batch.column("text").cast(pa.binary()).to_pylist()]
            parts.append(counted(texts, GAP, len(ids)))
            ids += batch.column("doc_id").to_pylist()
            held += sum(map(len, texts))
            if held >= SEGMENT or len(ids) >= SEGMENT_DOCS:
                yield from _segment(f"{run}{task}-{n}", ids, merged(parts), schema)
                parts, ids, held, n = [], [], 0, n + 1
        if ids:
            yield from _segment(f"{run}{task}-{n}", ids, merged(parts), schema)

    docs = docs.select("doc_id", "text")
    return docs.mapInArrow(rows, index_schema(docs.schema["doc_id"].dataType))


# ---- search ------------------------------------------------------------------------------------


@dataclass
class Postlist:
    """A term's blocks in a segment; blocks are decompressed when asked for, once."""

    heads: np.ndarray
    highest: np.ndarray  # of each block, the weight times the greatest impact
    data: bytes
    weight: int
    damped: np.ndarray  # of each document of the segment
    open: dict[int, tuple[np.ndarray, np.ndarray]] = field(default_factory=dict)

    def block(self, b: int) -> tuple[np.ndarray, np.ndarray]:
        """(documents, what the term adds to their scores) of a block."""
        if b not in self.open:
            h = self.heads[b]
            count, wide, at = int(h["count"]), int(h["gap_width"]), int(h["at"])
            docs = np.cumsum(_unpacked(self.data, at, count, wide)) + int(h["first"])
            tf = _unpacked(self.data, at + count * wide, count, int(h["tf_width"]))
            self.open[b] = docs, self.weight * impact(tf, self.damped[docs])
        return self.open[b]


def _unpacked(data: bytes, at: int, count: int, width: int) -> np.ndarray:
    return np.frombuffer(data, f"<u{width}", count, at).astype(np.int64)


class Best:
    """The best k documents of an item so far: (minus score, id with nulls first, id), ascending."""

    def __init__(self, k: int):
        self.k, self.rows, self.threshold = k, [], 1

    def add(self, scores: np.ndarray, docs: np.ndarray, ids: list) -> None:
        top = np.lexsort((docs, -scores))[: self.k].tolist()
        new = [(-int(scores[i]), (ids[docs[i]] is not None, ids[docs[i]])) for i in top]
        self.rows = sorted(self.rows + new)[: self.k]
        if len(self.rows) == self.k:
            self.threshold = -self.rows[-1][0]

    def first_too_late(self, keys: list) -> int:
        """The first of a segment's documents whose id is too late to enter by the threshold alone."""
        return bisect_left(keys, self.rows[-1][1]) if len(self.rows) == self.k else len(keys)


def search_segment(lists: list[Postlist], best: Best, ids: list, keys: list, scores: np.ndarray) -> None:
    """Takes a segment's documents into best. scores: zeros for each document, and zeros again afterwards."""
    if sum(int(x.highest.max()) for x in lists) < best.threshold:
        return
    ends = np.unique(np.concatenate([x.heads["last"] for x in lists])).astype(np.int64)
    bound, at = np.zeros(len(ends), np.int64), []
    for x in lists:  # shallow moves: to the block that holds each window, by headers
        b = np.searchsorted(x.heads["last"], ends)
        inside = b < len(x.heads)
        b[~inside] = 0
        inside &= x.heads["first"][b] <= ends
        bound += np.where(inside, x.highest[b], 0)
        at.append(np.where(inside, b, -1))
    begins = np.concatenate([np.zeros(1, np.int64), ends[:-1] + 1])
    order = np.argsort(-bound, kind="stable")
    done, step = 0, 2
    while done < len(order) and bound[order[done]] >= best.threshold:
        take = order[done : done + step]
        take = take[(bound[take] > best.threshold) | (bound[take] == best.threshold) & (begins[take] < best.first_too_late(keys))]
        done, step = done + step, step * 2
        if not len(take):
            continue
        chosen = np.zeros(len(ends), bool)
        chosen[take] = True
        seen = []
        for x, b in zip(lists, at):
            for i in np.unique(b[take]).tolist():
                if i >= 0:
                    docs, added = x.block(i)
                    some = chosen[np.searchsorted(ends, docs)]
                    scores[docs[some]] += added[some]
                    seen.append(docs[some])
        docs = np.unique(np.concatenate(seen))
        found = scores[docs]
        scores[docs] = 0
        good = found >= best.threshold
        if good.any():
            best.add(found[good], docs[good], ids)


def _searcher(queries: list[list[str]], weights: dict[str, int], n_docs: int, n_terms: int, k: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best = [Best(k) for _ in queries]
        ids: list = []
        damped, lists, kind = np.zeros(0, np.int64), {}, None

        def finish() -> None:
            keys, scores = [(i is not None, i) for i in ids], np.zeros(len(ids), np.int64)
            for terms, b in zip(queries, best):
                mine = [lists[t] for t in terms if t in lists]
                if mine:
                    search_segment(mine, b, ids, keys, scores)

        for batch in batches:
            kind = batch.column("ids").type.value_type
            for r in batch.to_pylist():
                if r["term"] == "":  # a segment begins
                    if lists:
                        finish()
                    ids, lists = r["ids"], {}
                    damped = damping(np.frombuffer(r["lengths"], "<u4").astype(np.int64), n_docs, n_terms)
                elif weights[r["term"]] > 0:
                    heads, pairs = np.frombuffer(r["heads"], HEAD), np.frombuffer(r["impacts"], PAIR)
                    most = impact(pairs["tf"].astype(np.int64), damping(pairs["n"].astype(np.int64), n_docs, n_terms))
                    w = weights[r["term"]]
                    lists[r["term"]] = Postlist(heads, w * np.maximum.reduceat(most, heads["pairs"].astype(np.int64)), r["data"], w, damped)
        if lists:
            finish()
        if kind is not None:
            rows = [(q, -s, i[1]) for q, b in enumerate(best) for s, i in b.rows]
            yield pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows], pa.int32()), pa.array([r[1] for r in rows], pa.int64()), pa.array([r[2] for r in rows], kind)], ["q", "score", "doc_id"])

    return run


def search(index: DataFrame, items: DataFrame, k: int = 10) -> DataFrame:
    """(item_id, rank, doc_id, score): the k documents of highest score above 0 for each row of items (item_id, text). index: a kept table."""
    spark, ws = index.sparkSession, Workspace(index.sparkSession, "search")
    item, doc = items.schema["item_id"], T.StructField("doc_id", index.schema["ids"].dataType.elementType)
    total = index.where("term = ''").agg(F.sum("n_docs").alias("docs"), F.sum("n_terms").alias("terms")).first()
    terms = F.array_distinct(F.filter(F.regexp_extract_all(ascii_lower(F.coalesce("text", F.lit(""))), F.lit(TERM), F.lit(0)), lambda t: t != ""))
    out = None
    for block in _blocks(items.select("item_id", terms.alias("terms")).toLocalIterator()):
        words = {t for _, ts in block for t in ts}
        wanted = F.broadcast(spark.createDataFrame([(w,) for w in ("", *words)], "term string"))  # bounded by the block
        df = {r.term: r.df for r in index.where("df is not null").select("term", "df").join(wanted, "term").groupBy("term").agg(F.sum("df").alias("df")).collect()}
        if not total.terms or not df:
            continue
        weights = {t: weight(total.docs, n) for t, n in df.items()}
        hits = index.join(wanted, "term", "left_semi").repartition("segment").sortWithinPartitions("segment", "term")
        run = _searcher([[t for t in ts if t in df] for _, ts in block], weights, total.docs, total.terms, k)
        rows = hits.mapInArrow(run, T.StructType([T.StructField("q", T.IntegerType()), T.StructField("score", T.LongType()), doc]))
        rank = F.row_number().over(Window.partitionBy("q").orderBy(F.desc("score"), F.asc_nulls_first("doc_id")))
        rows = rows.withColumn("rank", rank).where(F.col("rank") <= k)
        names = spark.createDataFrame([(q, i) for q, (i, _) in enumerate(block)], T.StructType([T.StructField("q", T.IntegerType()), item]))
        rows = ws.keep(rows.join(F.broadcast(names), "q").select("item_id", "rank", "doc_id", "score"), "block")
        out = rows if out is None else out.unionByName(rows)
    return out if out is not None else spark.createDataFrame([], T.StructType([item, T.StructField("rank", T.IntegerType()), doc, T.StructField("score", T.LongType())]))


def _blocks(rows: Iterator) -> Iterator[list[tuple[object, list[str]]]]:
    block, held = [], 0
    for r in rows:
        if block and (len(block) == ITEMS or held + len(r.terms) > ITEM_TERMS):
            yield block
            block, held = [], 0
        block.append((r.item_id, r.terms))
        held += len(r.terms)
    if block:
        yield block


def rank_documents(docs: DataFrame, items: DataFrame, k: int = 10) -> DataFrame:
    """search() of items over an index of docs that is built for it."""
    return search(Workspace(docs.sparkSession, "index").keep(build(docs), "index"), items, k)

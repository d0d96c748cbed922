"""Near-duplicates against all pairs of full sets."""

import random
import re

import numpy as np
from pyspark.sql import functions as F

from filigree.llm import neardup
from filigree.llm.common import Workspace


def brute(rows, percent=85):
    lower = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    sets = {}
    for i, t in rows:
        w = re.findall(r"[^\x20\x09-\x0D]+", (t or "").translate(lower))
        sets[i] = {tuple(w[j : j + 5]) for j in range(len(w) - 4)} if len(w) >= 5 else ({tuple(w)} if w else set())
    top = {i: i for i in sets}

    def find(x):
        while top[x] != x:
            x = top[x]
        return x

    ids = sorted(sets)
    for k, a in enumerate(ids):
        for b in ids[k + 1 :]:
            n = len(sets[a] & sets[b])
            if n and 100 * n >= percent * len(sets[a] | sets[b]):
                x, y = find(a), find(b)
                top[max(x, y)] = min(x, y)
    return {i: (len(sets[i]), find(i)) for i in sets}


def corpus():
    rng = random.Random(4)
    word = lambda: "".join(rng.choice("abcdefgh") for _ in range(rng.randint(2, 7)))
    rows = []
    for g in range(8):
        base = [word() for _ in range(rng.choice([4, 40, 150, 300]))]
        for _ in range(12):
            copy = list(base)
            for _ in range(rng.choice([0, 0, 1, 2, 4, 8])):
                copy[rng.randrange(len(copy))] = word()
            rows.append(" ".join(copy))
    rows += [None, "", "   ", "One two", "one  TWO", "one two three four five", "é É É é x y z"]
    return list(enumerate(rows))


def test_components(spark, monkeypatch):
    rows = corpus()
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    want = brute(rows)
    for size in (256, 5):  # blocks smaller than a group of copies give the same
        monkeypatch.setattr(neardup, "BLOCK_DOCS", size)
        monkeypatch.setattr(neardup, "BLOCK_SIGNATURES", size)
        got = {r.doc_id: (r.n_shingles, r.component_id) for r in neardup.near_duplicates(docs).collect()}
        assert got == want
    assert all(r.kept == (r.doc_id == r.component_id) for r in neardup.near_duplicates(docs).collect())


def test_ties_nulls_and_extra_columns(spark):
    rows = [(1, "a b c d e f", "x"), (1, "a b c d e f", "x"), (None, "a b c d e f", "y"), (3, "a b c d e F", "z")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, kept string")
    got = neardup.deduplicate(docs).collect()
    assert sorted((r.doc_id or -1, r.kept) for r in got) == [(-1, "y"), (1, "x"), (1, "x")]
    assert neardup.near_duplicates(docs.limit(0)).count() == 0


def test_one_bucket_of_many_documents(spark):
    """3,000 documents share the values of one band by force; a few link, and no text of the rest is read."""
    ws = Workspace(spark, "t")
    rng = np.random.default_rng(3)
    signs = rng.integers(0, 1 << 32, (3000, 120), dtype=np.uint32)
    signs[:, :5] = 7
    for a, b in ((10, 2990), (10, 1500), (77, 78)):
        signs[b] = signs[a]
        signs[b, 100:108] = 1
    signed = spark.createDataFrame([(i, bytearray(x.tobytes())) for i, x in enumerate(signs)], "id long, signature binary")
    mixed = spark.range(3000).select(F.lit(1).cast("long").alias("bucket"), "id", F.col("id").alias("c"))
    got = neardup.undecided(ws, mixed, signed, 0.85, 1e-7, 24, 5)
    assert sorted(r.id for r in got.collect()) == [10, 77, 78, 1500, 2990]


def test_text_ids(spark):
    rows = [("a", "one two three four five six"), ("b", "one two three four five six"), ("c", "else"), ("b", "else")]
    got = {(r.doc_id, r.n_shingles): r.component_id for r in neardup.near_duplicates(spark.createDataFrame(rows, "doc_id string, text string")).collect()}
    assert got[("a", 2)] == got[("b", 2)] == "a" and got[("c", 1)] == "b"


def test_signatures_and_bounds():
    family = neardup.hash_family(2000)
    a, b = np.arange(0, 300, dtype=np.uint64), np.arange(30, 330, dtype=np.uint64)
    same = (neardup.signature(neardup.mix(a), family) == neardup.signature(neardup.mix(b), family)).mean()
    assert abs(same - 270 / 330) < 0.05
    steps = neardup.least_matches(0.85, 120, 24, 1e-7)
    assert [n for n, _ in steps] == [24, 48, 72, 96, 120] and all(0 <= m < 0.85 * n for n, m in steps)


def test_connected(spark):
    from filigree.llm.common import connected

    edges = [(i, i + 1) for i in range(0, 40)] + [(100, 101), (200, 150), (150, 101)]
    got = connected(Workspace(spark, "t"), spark.createDataFrame(edges, "u long, v long"))
    parts = {r.id: r.component for r in got.collect()}
    assert all(parts[i] == 0 for i in range(41)) and {parts[i] for i in (100, 101, 150, 200)} == {100}
    assert got.select(F.countDistinct("id")).first()[0] == got.count()

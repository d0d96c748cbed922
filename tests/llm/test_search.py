"""Ranked search: every document scored in plain Python, and in SQL over the given tables."""

import math
import random
import re
from collections import Counter

import duckdb
import numpy as np
import pytest

from filigree.llm import search
from filigree.llm.common import Workspace
from filigree.llm.queries import ORACLE, QUERIES

SF = "/root/testdata/sf0.001"


def terms(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", (text or "").translate(str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")))


def brute(docs, items, k):
    counts = [(i, Counter(terms(t))) for i, t in docs]
    counts = [(i, c) for i, c in counts if c]
    n, total, df = len(counts), sum(sum(c.values()) for _, c in counts), Counter(t for _, c in counts for t in c)
    out = []
    for item, text in items:
        scored = []
        for i, c in counts:
            m = 100 - 90 + (90 * sum(c.values()) * n) // total
            score = sum(math.floor(1000 * math.log((2 * n + 2) / (2 * df[t] + 1))) * ((10**9 * c[t]) // (1000 * c[t] + 8 * m)) for t in set(terms(text)) if t in c)
            scored += [(-score, i)] if score > 0 else []
        out += [(item, r, i, -s) for r, (s, i) in enumerate(sorted(scored)[:k], 1)]
    return sorted(out)


@pytest.mark.parametrize(("block", "segment"), [(64, 16 << 20), (2, 600), (3, 5000)])
def test_brute_force(spark, monkeypatch, block, segment):
    monkeypatch.setattr(search, "BLOCK", block)
    monkeypatch.setattr(search, "SEGMENT", segment)
    monkeypatch.setattr(search, "ITEMS", 7)
    rng = random.Random(block)
    words = [f"w{i}" for i in range(80)] + ["É", "Ab9", "日本", "x" * 70]
    odds = [1 / (i + 1) for i in range(len(words))]
    some = lambda most: " ".join(rng.choices(words, odds, k=rng.randint(0, most)))
    docs = [(rng.randint(-50, 10**9), some(60)) for _ in range(300)]
    docs += [(10**6 + i, "w1 w70 copy, of a PASSAGE") for i in range(40)] + [(5, None), (6, ""), (7, "... "), (8, "w1 " * 400), (8, "w1 " * 400)]
    items = [(i % 17, some(25)) for i in range(20)] + [(90, "w1 w1 passage"), (91, None), (92, "nowhere"), (93, "w1")]
    table = spark.createDataFrame([(*r, "x") for r in docs], "doc_id long, text string, score string").repartition(3)
    asked = spark.createDataFrame([(*r, 1) for r in items], "item_id long, text string, rank int")
    got = sorted(tuple(r) for r in search.rank_documents(table, asked, 5).collect())
    assert got == brute(docs, items, 5)


def test_empty(spark):
    docs, items = spark.createDataFrame([("a", "b c")], "doc_id string, text string"), spark.createDataFrame([(1, "b")], "item_id long, text string")
    assert [tuple(r)[:3] for r in search.rank_documents(docs, items).collect()] == [(1, 1, "a")]
    assert search.rank_documents(docs.limit(0), items).count() == search.rank_documents(docs, items.limit(0)).count() == 0


def test_appended_segments_and_skipped_blocks(spark, monkeypatch):
    """An index grows by runs; blocks below the threshold stay compressed."""
    docs = [(i, f"w{i % 7} w{i % 11} common") for i in range(4000)] + [(9000 + i, "w1 w2 w3 common rare") for i in range(5)]
    table = spark.createDataFrame(docs, "doc_id long, text string")
    ws = Workspace(spark, "test")
    index = ws.keep(search.build(table.where("doc_id < 1000"), "a-").unionByName(search.build(table.where("doc_id >= 1000").coalesce(1), "b-")))
    items = [(1, "w1 w2 w3 rare common")]
    assert sorted(tuple(r) for r in search.search(index, spark.createDataFrame(items, "item_id long, text string"), 5).collect()) == brute(docs, items, 5)
    opened = []
    monkeypatch.setattr(search.Postlist, "block", lambda self, b, f=search.Postlist.block: (opened.append(b), f(self, b))[1])
    own = index.where("segment like 'b-%' and term in ('', 'w1', 'w2', 'w3', 'rare', 'common')").orderBy("segment", "term").toArrow()
    blocks = sum(np.frombuffer(h, search.HEAD).size for h in own.column("heads").to_pylist() if h)
    df = Counter(t for _, x in docs for t in set(terms(x)))
    weights = {t: search.weight(len(docs), c) for t, c in df.items()}
    list(search._searcher([terms(items[0][1])], weights, len(docs), sum(len(terms(x)) for _, x in docs), 5)(iter(own.to_batches())))
    assert 0 < len(opened) < blocks / 4


def test_query_against_sql(spark):
    con = duckdb.connect()
    for t in ("documents", "benchmark"):
        con.sql(f"create view {t} as select * from '{SF}/{t}.parquet'")
    want = con.sql(ORACLE["op11_block_max_wand"]).df()
    got = QUERIES["op11_block_max_wand"](spark, SF).toPandas()[list(want.columns)]
    assert sorted(map(tuple, got.values.tolist())) == sorted(map(tuple, want.values.tolist())) and len(want) > 100

"""Divergence of sources: the dense sum over all terms, in plain Python, and in SQL over the given table."""

import random
import re
from collections import Counter
from itertools import permutations

import duckdb
import numpy as np
import pytest

from filigree.llm import divergence, terms
from filigree.llm.queries import ORACLE, QUERIES

SF = "/root/testdata/sf0.001"
A_Z = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def brute(rows):
    rows = [(lang or "", source or "", re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", (text or "").translate(A_Z))) for lang, source, text in rows]
    out = []
    for lang in {r[0] for r in rows}:
        df, whole, groups = Counter(), Counter(), {}
        for g, source, words in rows:
            if g == lang:
                df.update(set(words))
                whole.update(words)
                groups.setdefault(source, Counter()).update(words)
        kept = [t for t in df if df[t] >= 3]
        share = lambda c: {t: 1 + 10**9 * (c[t] + 1) // (sum(c[x] for x in kept) + len(kept)) for t in kept}
        p, q = {s: share(c) for s, c in groups.items()}, share(whole)
        far = lambda p, q: (p - q) ** 2 // q
        for s in groups:
            of = {"pair": [(sum(far(p[s][t], p[o][t]) for t in kept), o) for o in groups if o != s], "term": [(far(p[s][t], q[t]), t) for t in kept if groups[s][t] and p[s][t] > q[t]]}
            for part, found in of.items():
                found.sort(key=lambda x: (-x[0], x[1].encode()))
                out += [(lang, s, part, item, value, i) for i, (value, item) in enumerate(found[: 200 if part == "term" else None], 1)]
    return sorted(out)


@pytest.mark.parametrize("chunk", [divergence.CHUNK, 40])
def test_brute_force(spark, monkeypatch, chunk):
    monkeypatch.setattr(divergence, "CHUNK", chunk)
    rng = random.Random(11)
    words = [f"w{chr(97 + i)}" for i in range(26)] + ["É", "é", "Iİ", "zz9zz", "Q", "q", "日本"]
    text = lambda: " ".join(rng.choices(words, [1 / (i + 1) for i in range(len(words))], k=rng.randint(0, 40)))
    rows = [(rng.choice(["en", "de", None]), rng.choice(["a", "b", "c", "", None]), text()) for _ in range(120)]
    rows += [("fr", "x", "one two"), ("fr", "y", None), ("fr", "z", "..."), ("en", "empty", ""), *[("it", "solo", "uno due")] * 3, ("en", "a", "wa " * 3000)] * 2
    docs = spark.createDataFrame([(*r, "old", 1) for r in rows], "lang string, source string, text string, item string, rank int")
    assert sorted(tuple(r) for r in divergence.audit(docs).collect()) == brute(rows)
    assert divergence.audit(docs.limit(0)).count() == 0


def test_query_against_sql(spark):
    con = duckdb.connect()
    con.sql(f"create view documents as select * from '{SF}/documents.parquet'")
    want = con.sql(ORACLE["op12_divergence"]).df()
    got = QUERIES["op12_divergence"](spark, SF).toPandas()[list(want.columns)]
    assert sorted(map(tuple, got.values.tolist())) == sorted(map(tuple, want.values.tolist()))


def test_long_texts_are_cut_between_words(monkeypatch):
    monkeypatch.setattr(terms, "PIECE", 64)
    rng = random.Random(2)
    texts = [" ".join(rng.choices(["Ab", "c", "ddé", "x" * 90], k=n)).encode() for n in (0, 3, 200, 1, 50)]
    found = terms.counted(texts, divergence.GAP, 10)
    data, offsets = found.words(np.arange(len(found.hash)))
    names = [bytes(data[a:b]) for a, b in zip(offsets, offsets[1:])]
    want = {(w, 10 + i): n for i, t in enumerate(texts) for w, n in Counter(t.lower().split()).items()}
    assert {(names[c], int(d)): int(n) for c, d, n in zip(found.code, found.doc, found.tf)} == want and len(want) == len(found.code)

"""Substring dedup against a count of every window."""

import random
from collections import Counter

import numpy as np

from filigree.llm import suffixes


def brute(rows, length=200):
    raw = [(i, (t or "").encode()) for i, t in rows]
    times = Counter(r[s : s + length] for _, r in raw for s in range(len(r) - length + 1))
    out = []
    for i, r in raw:
        hit = np.zeros(len(r) + 1, int)
        for s in range(len(r) - length + 1):
            if times[r[s : s + length]] > 1:
                hit[s] += 1
                hit[s + length] -= 1
        gone = np.cumsum(hit)[:-1] > 0
        out.append((i, len(r), int(gone.sum()), bytes(np.frombuffer(r, np.uint8)[~gone])))
    return sorted(out, key=str)


def corpus():
    rng = random.Random(9)
    some = lambda n: "".join(rng.choice("abcdefghijklmnopqrstuvwxyz é") for _ in range(n))
    shared = [some(n) for n in (199, 200, 201, 260, 900)]
    rows = [some(rng.randint(0, 500)) + rng.choice(shared) + some(rng.randint(0, 300)) for _ in range(40)]
    rows += ["ab" * 400, "x" * 700, "x" * 199, "", None, shared[4], shared[4] + "q"]
    copy = some(1200)
    rows += [copy, copy, copy[:700] + "#" + copy[700:], copy[:1000]]
    return list(enumerate(rows))


def result(spark, rows):
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    out = suffixes.remove_repeats(docs).collect()
    return sorted(((r.doc_id, r.n_bytes, sum(s.b - s.a for s in r.removed), bytes(r.kept)) for r in out), key=str)


def test_every_window(spark):
    assert result(spark, corpus()) == brute(corpus())


def test_outgrown_hashes(spark, monkeypatch):
    monkeypatch.setattr(suffixes, "MOST_STRETCHES", 2)
    assert result(spark, corpus()) == brute(corpus())


def test_copies_with_one_id(spark):
    rows = [(1, "k" * 50 + "l" * 250), (1, "k" * 50 + "l" * 250), (1, "m" * 3)]
    assert result(spark, rows) == brute(rows)
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert suffixes.remove_repeats(empty).count() == 0


def test_equal_anchor_hashes_with_unlike_bytes(spark, monkeypatch):
    rows = corpus()
    grams = suffixes.mix  # every anchor hash gets one of four values, so that unlike stretches meet
    monkeypatch.setattr(suffixes, "mix", lambda h: grams(h) & np.uint64(3 << 40))
    assert [x.tolist() for x in suffixes.repeated_starts([b"a" * 300, b"b" * 300], [101, 101])] == [[True] * 101] * 2
    raw = "".join(chr(97 + i % 26) for i in range(500)).encode()
    assert len(set(suffixes.stretches(np.frombuffer(raw, np.uint8))[0].tolist())) == 1
    monkeypatch.undo()
    assert result(spark, rows) == brute(rows)


def test_forced_hash_clash(monkeypatch):
    texts = [bytes(np.random.default_rng(i).integers(97, 123, 260, dtype=np.uint8)) for i in range(3)] 
    monkeypatch.setattr(suffixes.Prefixes, "of", lambda self, a, b: np.zeros(len(a), np.uint64))  # all windows hash alike
    assert not any(x.any() for x in suffixes.repeated_starts(texts, [61] * 3))
    assert [x.sum() for x in suffixes.repeated_starts([*texts, texts[0]], [61] * 4)] == [61, 0, 0, 61]


def test_clashing_columns(spark):
    docs = spark.createDataFrame([(1, "k" * 250, 7, "r", "k"), (2, "short", 8, "r", "k")], "doc_id long, text string, n_bytes int, removed string, kept string")
    out = {r.doc_id: r for r in suffixes.remove_repeats(docs).collect()}
    assert out[1].n_bytes == 250 and bytes(out[1].kept) == b"" and bytes(out[2].kept) == b"short"


def test_difference_cover():
    rng = np.random.default_rng(2)
    for _ in range(200):
        t = rng.integers(1, rng.integers(2, 6), rng.integers(0, 90)).astype(np.int64)
        assert suffixes.suffix_array(t).tolist() == sorted(range(len(t)), key=lambda i: t[i:].tolist())

"""Toxicity by non-negative positive-unlabelled learning.

Only confirmed toxic texts are labelled; the rest is unlabelled text that holds toxic texts too, at a known class
prior. The risk of a classifier is estimated as prior x (loss of the positives as positive) plus (loss of the
unlabelled as negative minus prior x loss of the positives as negative); the last bracket estimates the negatives'
risk and may not fall below zero: where it does in a minibatch, the step goes the other way, which keeps a flexible
model from calling every positive's neighbour negative. The classifier is linear over the n-grams of a text's distinct
words, trained in numpy with minibatches.

Spark counts every n-gram over all confirmed and all unlabelled texts. From these counts each of the 2 ** bits n-grams
gets a scale: the log of how much more often confirmed texts have it than clean ones of as many n-grams would, shrunk
where that may be chance, and where it is small: many rows make sure of ratios near 1, too, and a text has thousands of
those beside a few telling ones. No n-gram is left out. Scaled rows are brought to length 1. The fit starts from the scales and takes bounded samples: max_positive and max_unlabelled
rows with the smallest id hashes, among those of at most max_chars characters, whose n-grams are computed by tasks.
N-grams that no sampled row has keep the factor that all began with. Scores cover every text.

Cases: null and empty texts have no n-grams and get the score of the bias. Without confirmed texts every score is 0.
Extra columns are kept, other than score. Equal texts get equal scores. Rows that share an id are one row of the samples,
but count as often as they come.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from filigree.llm import quality
from filigree.llm.features import WordGrams

BITS = 20
#: How many standard deviations above chance halve the distrust in an n-gram.
SURE = 6.0


class Model:
    """A weight for each n-gram, the squares of the scales that bring a text to length 1, and the bias."""

    def __init__(self, bits: int, weights: np.ndarray, squares: np.ndarray, bias: float):
        self.bits, self.weights, self.squares, self.bias = bits, weights.astype(np.float32), squares.astype(np.float32), bias

    def scores(self, grams: WordGrams) -> np.ndarray:
        return sigmoid(grams.sums(self.weights) / lengths(grams.sums(self.squares)) + self.bias)


def lengths(squares: np.ndarray) -> np.ndarray:
    return np.sqrt(np.maximum(squares, 1e-12))


def sigmoid(z: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


class Rows:
    """Rows of feature numbers, set end to end."""

    def __init__(self, flat: np.ndarray, sizes: np.ndarray):
        self.flat, self.sizes, self.begins = flat, sizes, np.cumsum(sizes) - sizes

    def __len__(self) -> int:
        return len(self.sizes)

    def sums(self, weights: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Of the rows at, the weights added up; their features; and which of them has each."""
        sizes = self.sizes[at]
        flat = self.flat[np.repeat(self.begins[at] - np.cumsum(sizes) + sizes, sizes) + np.arange(int(sizes.sum()))]
        owner = np.repeat(np.arange(len(at)), sizes)
        return np.bincount(owner, weights[flat], len(at)), flat, owner


def starting_bias(zp: np.ndarray, zu: np.ndarray, prior: float) -> float:
    """The bias at which the non-negative risk of the margins, each error counted as one, is least."""
    edges = np.unique(np.concatenate([zp, zu]))
    cuts = np.concatenate([[edges[0] - 1], (edges[1:] + edges[:-1]) / 2, [edges[-1] + 1]])
    missed = np.searchsorted(np.sort(zp), cuts) / len(zp)
    taken = 1 - np.searchsorted(np.sort(zu), cuts) / len(zu)
    risk = prior * missed + np.maximum(taken - prior * (1 - missed), 0)
    best = np.flatnonzero(risk <= risk.min() + 1e-12)
    return -float((cuts[best[0]] + cuts[best[-1]]) / 2)


def fit_nnpu(positive: Rows, unlabelled: Rows, scale: np.ndarray, prior: float, steps: int = 500, batch: int = 64, rate: float = 0.03, decay: float = 1e-4, seed: int = 5) -> tuple[np.ndarray, float, float]:
    """Factors of the scales, bias and the factor of features without a row, that make the non-negative risk small; sigmoid loss, Adam steps."""
    rng = np.random.default_rng(seed)
    size = len(scale)
    every_p, every_u = np.arange(len(positive)), np.arange(len(unlabelled))
    lp, lu = (lengths(rows.sums(scale**2, at)[0]) for rows, at in ((positive, every_p), (unlabelled, every_u)))
    zp, zu = positive.sums(scale, every_p)[0] / lp, unlabelled.sums(scale, every_u)[0] / lu
    start = 2 / max(float(zu.std()), 1e-6)  # so that texts begin some units apart
    w, m, v = np.full(size + 1, start), np.zeros(size + 1), np.zeros(size + 1)
    w[size] = starting_bias(start * zp, start * zu, prior)

    def draws(n_rows: int, n: int) -> Iterator[np.ndarray]:
        """Minibatches of n row numbers, each row once before any comes again."""
        order = np.zeros(0, np.int64)
        while True:
            while len(order) < n:
                order = np.concatenate([order, rng.permutation(n_rows)])
            yield order[:n]
            order = order[n:]

    some_p, some_u = draws(len(positive), min(batch, len(positive))), draws(len(unlabelled), min(4 * batch, len(unlabelled)))
    for t, p, u in zip(range(1, steps + 1), some_p, some_u):
        own = w[:size] * scale
        (zp, fp, op), (zu, fu, ou) = positive.sums(own, p), unlabelled.sums(own, u)
        # loss as positive: sigmoid(-z); as negative: sigmoid(z)
        sp, su = sigmoid(zp / lp[p] + w[size]), sigmoid(zu / lu[u] + w[size])
        dp, du = prior * sp * (1 - sp) / len(p), su * (1 - su) / len(u)
        if su.mean() - prior * sp.mean() >= 0:
            dp = -2 * dp
        else:
            du = -du
        g = np.append((np.bincount(fp, (dp / lp[p])[op], size) + np.bincount(fu, (du / lu[u])[ou], size)) * scale, dp.sum() + du.sum())
        g[:size] += decay * (w[:size] - start)
        m, v = 0.9 * m + 0.1 * g, 0.999 * v + 0.001 * g * g
        w -= rate * start * (m / (1 - 0.9**t)) / (np.sqrt(v / (1 - 0.999**t)) + 1e-9)
    return w[:size], float(w[size]), start


def word_counts(rows: DataFrame, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """How many rows of each label (0, 1) there are, and for each n-gram in how many distinct words of them it stands, summed by Spark."""

    def count(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray]:
        grams, label = WordGrams(batch.column("text").to_pylist(), bits), np.array(batch.column("label").to_pylist())
        return np.bincount(label, minlength=2), np.stack([grams.counts(label == k, bits) for k in (0, 1)])

    return quality.summed(rows, count, bits)


def scales(totals: np.ndarray, counts: np.ndarray, prior: float) -> np.ndarray:
    """The scale of each n-gram, from word_counts()."""
    p, u = counts[1] / totals[1], counts[0] / totals[0]
    # How often the confirmed texts would have it, were they clean: the unlabelled cleared of their toxic share, brought
    # to as many n-grams in all, so that the length of texts tells nothing.
    clean = np.maximum(u - prior * p, 0)
    chance = clean * (counts[1].sum() / max(clean.sum(), 1e-12))
    sure = (counts[1] - chance) ** 2 / (chance + 0.5)
    ratio = np.log((counts[1] + 1) / (chance + 1))
    return ratio * sure / (sure + SURE**2) * ratio**2 / (ratio**2 + 1)


def learn(positive: DataFrame, unlabelled: DataFrame, prior: float, bits: int = BITS, max_positive: int = 1000, max_unlabelled: int = 3000, max_chars: int = 10_000) -> Model:
    """A model from confirmed (doc_id, text) rows, unlabelled (doc_id, text) rows and the share of toxic texts among the latter."""
    rows = positive.select("doc_id", "text", F.lit(1).alias("label")).unionByName(unlabelled.select("doc_id", "text", F.lit(0).alias("label")))
    totals, counts = word_counts(rows, bits)
    if not totals.all() or prior <= 0:
        return Model(bits, np.zeros(1 << bits), np.zeros(1 << bits), -30.0 if not totals[1] else 0.0)
    scale = scales(totals, counts, prior)

    def features(df: DataFrame, most: int) -> tuple[np.ndarray, np.ndarray]:
        short = df.where(F.coalesce(F.length("text"), F.lit(0)) <= max_chars)
        flat, sizes, _ = quality.sample_features(short.withColumn("label", F.lit(0)), lambda texts: WordGrams(texts, bits).of_texts(), most)
        return (flat, sizes) if len(sizes) else (flat, np.zeros(1, np.int64))  # where all rows are longer, one without n-grams

    (fp, np_), (fu, nu) = features(positive, max_positive), features(unlabelled, max_unlabelled)
    has = np.zeros(1 << bits, bool)
    has[fp] = has[fu] = True
    met = np.flatnonzero(has)
    where = np.zeros(1 << bits, np.int32)
    where[met] = np.arange(len(met))
    w, bias, start = fit_nnpu(Rows(where[fp], np_), Rows(where[fu], nu), scale[met], prior)
    weights = start * scale
    weights[met] = w * scale[met]
    return Model(bits, weights, scale**2, bias)


def predict(docs: DataFrame, model: Model) -> DataFrame:
    """docs with score, 0 to 1."""
    return quality.predict(docs, model, WordGrams)

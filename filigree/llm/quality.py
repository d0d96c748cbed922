"""Quality classification with naive Bayes support vectors.

A text's features are indicators of the n-grams it has (hashed). For each n-gram Spark counts, over every labelled
row, in how many good and in how many bad texts it occurs; the log of the ratio of the smoothed shares scales the
indicator. On the scaled indicators, each row brought to length 1, a linear model with hinge loss is fitted by dual
coordinate descent on a bounded sample of labelled rows. The model is interpolated with the mean naive Bayes weight.
A logistic curve through the sample's margins turns a margin into a score; it is placed so that the score's
threshold balances both classes' errors.

Bounds: the model has 2 ** bits weights; the fit takes the max_rows labelled rows with the smallest id hashes among those
of at most max_chars characters. Tasks compute their features; only these reach the driver. Counts cover all labelled rows,
scores all texts.

Cases: null and empty texts have no n-grams and get the score of the bias. With labels of one class only, or none,
every score is that class's share (0.5 without labels). Labels whose document is missing are ignored. Repeated
labels count as often as they come; in the sample an id comes once. Extra columns are kept, other than score.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from filigree.llm.common import by_size
from filigree.llm.features import shape_ngrams

BITS = 18


def summed(rows: DataFrame, count: Callable[[pa.RecordBatch], tuple[np.ndarray, np.ndarray]], bits: int) -> tuple[np.ndarray, np.ndarray]:
    """count's results (rows of each label; 2 x 2 ** bits counts) over the text and label of all rows, summed by Spark."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = np.zeros((2, (1 << bits) + 1), np.int64)
        for batch in by_size(batches, "text"):
            totals, counts = count(batch)
            sums[:, -1] += totals
            sums[:, :-1] += counts
        label, gram = np.nonzero(sums)
        yield pa.RecordBatch.from_arrays([pa.array(label, pa.int32()), pa.array(gram, pa.int32()), pa.array(sums[label, gram])], names=["label", "gram", "n"])

    counted = rows.select("text", F.col("label").cast("int").alias("label")).mapInArrow(run, "label int, gram int, n bigint")
    got = counted.groupBy("label", "gram").agg(F.sum("n").alias("n")).toArrow()  # at most 2 x (2 ** bits + 1) rows
    out = np.zeros((2, (1 << bits) + 1), np.int64)
    out[got["label"].to_numpy(), got["gram"].to_numpy()] = got["n"].to_numpy()
    return out[:, -1], out[:, :-1]


def class_counts(rows: DataFrame, features, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """How many rows of each label (0, 1) there are, and for each n-gram how many of them have it."""

    def count(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray]:
        label = np.array(batch.column("label").to_pylist(), np.int64)
        own = features(batch.column("text").to_pylist(), bits)
        each = [[f for f, k in zip(own, label.tolist()) if k == which] for which in (0, 1)]
        return np.bincount(label, minlength=2), np.stack([np.bincount(np.concatenate(x), minlength=1 << bits) if x else np.zeros(1 << bits, np.int64) for x in each])

    return summed(rows, count, bits)


def dual_coordinate_descent(rows: list[np.ndarray], values: list[np.ndarray], y: np.ndarray, size: int, cost: np.ndarray, passes: int = 12, seed: int = 3) -> np.ndarray:
    """Weights (the last is the bias) of a linear model with hinge loss: each dual variable in turn moves to its best value within 0..cost."""
    w, alpha = np.zeros(size + 1), np.zeros(len(y))
    norm = np.array([v @ v for v in values]) + 1
    rng = np.random.default_rng(seed)
    for _ in range(passes):
        moved = 0.0
        for i in rng.permutation(len(y)):
            f, v = rows[i], values[i]
            g = y[i] * (w[f] @ v + w[size]) - 1
            new = min(max(alpha[i] - g / norm[i], 0.0), cost[i])
            step = new - alpha[i]
            if step:
                alpha[i] = new
                w[f] += step * y[i] * v
                w[size] += step * y[i]
                moved = max(moved, abs(step))
        if moved < 1e-3:
            break
    return w


class Model:
    """Weights for each n-gram, and the logistic curve of the margin."""

    def __init__(self, bits: int, weights: np.ndarray, scale: np.ndarray, slope: float, offset: float):
        self.bits, self.weights, self.scale, self.slope, self.offset = bits, weights, scale, slope, offset

    def margins(self, features: list[np.ndarray]) -> np.ndarray:
        out = np.full(len(features), self.weights[-1])
        for i, f in enumerate(features):
            v = self.scale[f]
            size = np.sqrt(v @ v)
            if size:
                out[i] += self.weights[f] @ v / size
        return out

    def scores(self, features: list[np.ndarray]) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.slope * self.margins(features) + self.offset, -30, 30)))


def sample_features(rows: DataFrame, features: Callable[[list], list[np.ndarray]], most: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(features end to end, how many of each row, labels) of the rows with the smallest id hashes, one for each id and most at the most; tasks compute the features."""
    key = F.xxhash64(F.col("doc_id").cast("string"))
    # The threshold hash comes from ids alone, so that texts beyond the sample aren't sorted.
    edge = rows.select(key.alias("h")).distinct().orderBy("h").limit(most).agg(F.max("h")).first()[0]
    if edge is None:
        return np.zeros(0, np.int32), np.zeros(0, np.int64), np.zeros(0, np.int64)
    chosen = rows.where(key <= edge).groupBy(key.alias("h")).agg(F.min(F.struct("text", "label")).alias("x")).select("h", "x.text", F.col("x.label").cast("int").alias("label"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in by_size(batches, "text"):
            found = [f.astype(np.int32) for f in features(batch.column("text").to_pylist())]
            yield pa.RecordBatch.from_arrays([batch.column("h"), batch.column("label"), pa.array(found, pa.list_(pa.int32()))], names=["h", "label", "f"])

    got = chosen.mapInArrow(run, "h bigint, label int, f array<int>").toArrow().sort_by("h")
    f = got["f"].combine_chunks()
    return f.flatten().to_numpy(), np.diff(f.offsets.to_numpy()).astype(np.int64), got["label"].to_numpy()


def learn(rows: DataFrame, bits: int = BITS, max_rows: int = 3000, max_chars: int = 20_000, threshold: float = 0.3, smooth: float = 1.0, mix_in: float = 0.9, cost: float = 1.0) -> Model:
    """A model from (doc_id, text, label) rows, label 1 for good texts; threshold is the score from which a text counts as good."""
    totals, counts = class_counts(rows, shape_ngrams, bits)
    if not totals.all():
        share = totals[1] / totals.sum() if totals.sum() else 0.5
        share = min(max(share, 1e-9), 1 - 1e-9)
        return Model(bits, np.zeros((1 << bits) + 1), np.zeros(1 << bits), 1.0, float(np.log(share / (1 - share))))
    p, q = smooth + counts[1], smooth + counts[0]
    scale = np.log((p / p.sum()) / (q / q.sum()))
    short = rows.where(F.coalesce(F.length("text"), F.lit(0)) <= max_chars)
    flat, sizes, labels = sample_features(short, lambda texts: shape_ngrams(texts, bits), max_rows)
    if not len(sizes):
        return Model(bits, np.zeros((1 << bits) + 1), np.zeros(1 << bits), 1.0, float(np.log(totals[1] / totals[0])))
    features = np.split(flat, np.cumsum(sizes)[:-1])
    y = np.where(labels > 0, 1.0, -1.0)
    values = [scale[f] / (np.sqrt(scale[f] @ scale[f]) or 1.0) for f in features]

    def fit(at: np.ndarray) -> Model:
        own = y[at]
        weight = np.where(own > 0, cost * (own < 0).mean(), cost * (own > 0).mean()) * 10  # the rarer class's errors weigh as much in all
        w = dual_coordinate_descent([features[i] for i in at], [values[i] for i in at], own, 1 << bits, weight)
        w[:-1] = mix_in * w[:-1] + (1 - mix_in) * np.abs(w[:-1]).mean()
        return Model(bits, w, scale, 1.0, 0.0)

    # Margins of rows that a fit didn't see tell where to put the threshold.
    folds = np.arange(len(y)) % 3
    margins = np.zeros(len(y))
    for k in range(3):
        out = np.flatnonzero(folds == k)
        margins[out] = fit(np.flatnonzero(folds != k)).margins([features[i] for i in out])
    model = fit(np.arange(len(y)))
    if len(set(y)) < 2:
        model.offset = float(np.log(threshold / (1 - threshold)))
        return model
    grid = np.unique(margins)
    grid = np.concatenate([[grid[0] - 1], (grid[1:] + grid[:-1]) / 2, [grid[-1] + 1]])
    wrong = [(margins[y > 0] < g).mean() + (margins[y < 0] >= g).mean() for g in grid]
    best = np.flatnonzero(np.isclose(wrong, min(wrong)))
    cut = (grid[best[0]] + grid[best[-1]]) / 2
    model.slope = 4 / max(margins.std(), 1e-6)
    model.offset = float(np.log(threshold / (1 - threshold)) - model.slope * cut)
    return model


def predict(docs: DataFrame, model, features=shape_ngrams, text: str = "text") -> DataFrame:
    """docs with score, 0 to 1."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    kept = [c for c in docs.columns if c != "score"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = shared.value
        for batch in by_size(batches, text):
            score = own.scores(features(batch.column(text).to_pylist(), own.bits))
            yield pa.RecordBatch.from_arrays([batch.column(c) for c in kept] + [pa.array(score, pa.float64())], names=[*kept, "score"])

    return docs.mapInArrow(run, T.StructType([docs.schema[c] for c in kept] + [T.StructField("score", T.DoubleType())]))

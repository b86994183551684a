"""Quality classifier: Naive Bayes support vectors.

Each document is a set of n-gram indicators: words, word pairs, and runs of three and four token shapes (lower,
capitalised, upper, digits, the punctuation run itself, repeat of the previous word), hashed to ``BUCKETS``.
Indicators are scaled by the log-count ratio of the two classes; a linear model with hinge loss is fitted
to them by dual coordinate descent; its weights are drawn towards their mean size as in the published method. The
margin becomes a probability by a logistic fit on cross-fitted margins (``FOLDS`` folds).

The sample is bounded by ``PER_CLASS`` documents a class. Every document is scored, over its whole text.
Defined results: null and empty texts get the score of the bias alone; with labels of fewer than two classes
every score is the share of good labels (0.5 without any).
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .labelled import featurise, fold, sample, score_table
from .store import table
from .textkit import LOWER, SPACE, U, chunks, hash_runs, mix, owners, salts, segment_sum

BUCKETS = 1 << 18
PER_CLASS = 1200
ROUNDS = 8
FOLDS = 3
THRESHOLD = 0.7
MIN_COUNT = 3

KIND = np.full(256, 3, np.uint8)
KIND[SPACE] = 0
KIND[[*range(65, 91), *range(97, 123), *range(128, 256)]] = 1
KIND[48:58] = 2
UPPER = np.zeros(256, np.int64)
UPPER[65:91] = 1
SMALL = np.zeros(256, np.int64)
SMALL[97:123] = 1


def tokens(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hashes and shapes of the runs of letters, digits and punctuation, and each document's first token."""
    kind = KIND[data]
    edge = np.zeros(len(data) + 1, bool)
    edge[offsets] = True
    edge[1:-1] |= kind[1:] != kind[:-1]
    edge[0] = edge[-1] = True
    cuts = np.flatnonzero(edge)
    starts, ends = cuts[:-1], cuts[1:]
    keep = kind[starts] != 0 if len(starts) else np.zeros(0, bool)
    starts, ends = starts[keep], ends[keep]
    k = kind[starts]
    h = hash_runs(LOWER[data], starts, ends)
    up = np.concatenate([[0], np.cumsum(UPPER[data])])
    low = np.concatenate([[0], np.cumsum(SMALL[data])])
    ups, lows = up[ends] - up[starts], low[ends] - low[starts]
    shape = np.where(k == 2, U(4), np.where((ups > 1) & (lows == 0), U(3), np.where(ups > 0, U(2), U(1))))
    shape = np.where(k == 3, h, shape)
    return h, shape, np.searchsorted(starts, offsets)


def indicators(data: np.ndarray, offsets: np.ndarray, useful: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Distinct (document, bucket) pairs, sorted; only buckets marked in ``useful`` if given."""
    h, shape, first = tokens(data, offsets)
    doc = owners(first)
    s = salts(12)
    n = len(h)
    if n > 1:
        again = np.zeros(n, bool)
        again[1:] = (h[1:] == h[:-1]) & (doc[1:] == doc[:-1])
        shape = np.where(again, shape * s[8] + U(7), shape)
    found_doc, found = [], []

    def add(parts: list[np.ndarray], mark: int) -> None:
        size = n - len(parts) + 1
        if size <= 0:
            return
        acc = np.full(size, s[mark], U)
        for j, p in enumerate(parts):
            acc += p[j : j + size] * s[j]
        f = (mix(acc) >> U(46)).astype(np.int64)
        ok = doc[:size] == doc[len(parts) - 1 :]
        if useful is not None:
            ok &= useful[f]
        found.append(f[ok])
        found_doc.append(doc[:size][ok])

    add([h], 9)
    add([h, h], 10)
    add([shape] * 3, 11)
    add([shape] * 4, 7)
    if not found:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    key = np.unique(np.concatenate(found_doc) * BUCKETS + np.concatenate(found))
    return key // BUCKETS, key % BUCKETS


def as_features(data: np.ndarray, offsets: np.ndarray) -> list[np.ndarray]:
    d, f = indicators(data, offsets)
    cut = np.searchsorted(d, np.arange(len(offsets)))
    return [f[a:b].astype(np.int32) for a, b in zip(cut[:-1], cut[1:])]


def dual_descent(rows: list[np.ndarray], scale: np.ndarray, y: np.ndarray, c: float, rounds: int, seed: int = 7) -> np.ndarray:
    """Weights (bias last) of a linear model with hinge loss, by dual coordinate descent: each dual variable stays within 0 and c."""
    w = np.zeros(len(scale) + 1)
    values = [np.append(scale[r], 1.0) for r in rows]
    where = [np.append(r, len(scale)) for r in rows]
    q = np.array([v @ v for v in values])
    alpha = np.zeros(len(rows))
    order = np.random.default_rng(seed)
    for _ in range(rounds):
        most = 0.0
        for i in order.permutation(len(rows)):
            g = y[i] * (w[where[i]] @ values[i]) - 1
            new = min(max(alpha[i] - g / q[i], 0.0), c)
            step = new - alpha[i]
            if step:
                w[where[i]] += step * y[i] * values[i]
                alpha[i] = new
                most = max(most, abs(step) * q[i])
        if most < 1e-2:
            break
    return w


def logistic(margin: np.ndarray, y: np.ndarray) -> tuple[float, float]:
    """Slope and intercept of P(1) = 1 / (1 + exp(-(a m + b))) by damped Newton steps with smoothed targets."""
    pos, neg = (y > 0).sum(), (y <= 0).sum()
    t = np.where(y > 0, (pos + 1) / (pos + 2), 1 / (neg + 2))
    scale = max(float(np.abs(margin).mean()), 1e-9)
    x = np.stack([margin / scale, np.ones(len(margin))], 1)
    start = np.array([scale, 0.0])
    loss = lambda b: (np.logaddexp(0, x @ b) - t * (x @ b)).sum() + 5e-4 * ((b - start) ** 2).sum()
    b = start
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ b, -30, 30)))
        curve = (x * (p * (1 - p))[:, None]).T @ x + 1e-3 * np.eye(2)
        step = np.linalg.solve(curve, x.T @ (t - p) - 1e-3 * (b - start))
        while loss(b + step) > loss(b) and np.abs(step).max() > 1e-6:
            step = step / 2
        b = b + step
        if np.abs(step).max() < 1e-5:
            break
    return float(max(b[0] / scale, 1e-3)), float(b[1])


@dataclass
class Model:
    weights: np.ndarray
    bias: float
    slope: float
    shift: float

    def margin(self, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        d, f = indicators(data, offsets, self.weights != 0)
        return segment_sum(self.weights[f], np.searchsorted(d, np.arange(len(offsets)))) + self.bias

    def predict(self, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.slope * self.margin(data, offsets) + self.shift, -30, 30)))


def weigh(rows: list[np.ndarray], y: np.ndarray, c: float, beta: float) -> tuple[np.ndarray, float]:
    """Weights of the buckets and the bias, from feature rows and labels of 1 and -1."""
    counts = [np.zeros(BUCKETS), np.zeros(BUCKETS)]
    for r, k in zip(rows, y):
        counts[int(k > 0)][r] += 1
    p, q = counts[1] + 1, counts[0] + 1
    ratio = np.log(p / p.sum()) - np.log(q / q.sum())
    ratio[counts[0] + counts[1] < MIN_COUNT] = 0
    w = dual_descent([r[ratio[r] != 0] for r in rows], ratio, y, c, ROUNDS)
    used = ratio != 0
    level = np.abs(w[:-1][used]).mean() if used.any() else 0.0
    return np.where(used, ratio * ((1 - beta) * level + beta * w[:-1]), 0.0), float(beta * w[-1])


def fit(rows: list[np.ndarray], labels: np.ndarray, c: float = 0.1, beta: float = 0.5) -> Model:
    """Fit on feature rows; the logistic fit sees margins from models that left the row's fold out."""
    labels = np.asarray(labels)
    share = float(labels.mean()) if len(labels) else 0.5
    if len(set(labels.tolist())) < 2:
        return Model(np.zeros(BUCKETS), 0.0, 1.0, float(np.log((share + 1e-9) / (1 - share + 1e-9)).clip(-20, 20)))
    y = np.where(labels > 0, 1.0, -1.0)
    margins = np.zeros(len(rows))
    fold_of = np.arange(len(rows)) % FOLDS
    for k in range(FOLDS):
        own = np.flatnonzero(fold_of != k)
        weights, bias = weigh([rows[i] for i in own], y[own], c, beta)
        for i in np.flatnonzero(fold_of == k):
            margins[i] = weights[rows[i]].sum() + bias
    weights, bias = weigh(rows, y, c, beta)
    return Model(weights, bias, *logistic(margins, y))


def train(docs: DataFrame, labels: DataFrame, per_class: int = PER_CLASS) -> Model:
    got = featurise(sample(docs, labels, "quality", 4, 2, per_class), as_features)
    return fit([np.frombuffer(x.feature, np.int32) for x in got], np.array([x.label for x in got]))


def score_quality(docs: DataFrame, labels: DataFrame, per_class: int = PER_CLASS) -> DataFrame:
    """doc_id, held_out, score, predicted of every row of ``docs``; ``labels`` has doc_id and quality."""
    model = docs.sparkSession.sparkContext.broadcast(train(docs, labels, per_class))
    return score_table(docs, fold(4) == 2, lambda data, offsets: model.value.predict(data, offsets), THRESHOLD)


def op1_quality_nbsvm(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score_quality(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def drop_rejected(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The rows of ``docs`` that the classifier accepts."""
    model = docs.sparkSession.sparkContext.broadcast(train(docs, labels))
    return docs.where(accepts(model)("text"))


def accepts(model):
    """The decision on each text, as a column function."""

    @F.arrow_udf("boolean")
    def good(texts: pa.Array) -> pa.Array:
        out = [model.value.predict(data, offsets) >= THRESHOLD for _, _, data, offsets in chunks(texts)]
        return pa.array(np.concatenate([np.zeros(0, bool), *out]))

    return good

"""Quality classifier: naive Bayes features for a linear support vector machine.

Features are indicators of hashed n-grams: of 3 and 4 bytes, and of the lengths of 4 and 6
words in a row, which have buckets of their own. Each counts once per text, scaled by the log ratio of their smoothed class counts. A linear hinge-loss model
over them is fitted by dual coordinate descent on a bounded, hash-ordered sample
of labelled rows, and its margin becomes a score between 0 and 1 by a logistic
curve fitted on rows that the model hasn't seen.

Nulls and empty texts have no features and get the score of the intercept.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tramline.llm.common import field, map_texts

# Buckets of each of the two kinds of n-grams: bytes, then word lengths.
BUCKETS = 1 << 18
# The model is fitted on at most this many labelled rows, the first by a hash of the id. A row's
# features come to the driver as at most 2 * BUCKETS numbers of 4 bytes, 2 MB; a text of
# n bytes and w words has at most 2n + 2w.
SAMPLE_ROWS = 4_000
# Numbers of words whose lengths are one n-gram, and the length from which words count alike.
LENGTH_GRAMS = (4, 6)
LONG_WORD = 15
THRESHOLD = 0.7


def features(text: str | None, seen: np.ndarray, buckets: int = BUCKETS) -> np.ndarray:
    """Distinct buckets of a text's n-grams.

    ``seen`` is scratch of 2 * ``buckets`` numbers: each n-gram writes its position and
    the last one to write stands for its bucket.
    """
    raw = (text or "").encode()
    data = np.frombuffer(raw, np.uint8).astype(np.uint32)
    if len(data) < 3:
        return np.zeros(0, np.int64)
    mask = np.uint32(buckets - 1)
    three = data[:-2] | data[1:-1] << np.uint32(8) | data[2:] << np.uint32(16)
    grams = [three * np.uint32(0x9E3779B1) >> np.uint32(7) & mask]
    if len(data) > 3:
        four = three[:-1] | data[3:] << np.uint32(24)
        grams.append(four * np.uint32(0x85EBCA77) >> np.uint32(9) & mask)
    lengths = np.minimum(list(map(len, raw.split())) or [0], LONG_WORD).astype(np.uint32)
    for n in LENGTH_GRAMS:
        if len(lengths) >= n:
            joined = np.zeros(len(lengths) - n + 1, np.uint32)
            for k in range(n):
                joined = joined * np.uint32(LONG_WORD + 1) + lengths[k:len(lengths) - n + 1 + k]
            grams.append((joined * np.uint32(0x9E3779B1) >> np.uint32(8) & mask) + np.uint32(buckets))
    ids = np.concatenate(grams).astype(np.int64)
    at = np.arange(len(ids), dtype=np.int32)
    seen[ids] = at
    return ids[seen[ids] == at]


@dataclass
class Model:
    """weight per bucket (already scaled), intercept, and the score's curve."""

    weight: np.ndarray
    intercept: float
    slope: float = 1.0
    offset: float = 0.0

    def margin(self, ids: np.ndarray) -> float:
        return (float(self.weight[ids].sum()) / np.sqrt(len(ids)) if len(ids) else 0.0) + self.intercept

    def score(self, margin: float) -> float:
        return float(1.0 / (1.0 + np.exp(-np.clip(self.slope * margin + self.offset, -30, 30))))


def log_count_ratios(rows: list[np.ndarray], good: np.ndarray, buckets: int, alpha: float = 1.0) -> np.ndarray:
    """log((share of the bucket in class 1) / (share in class 0)), smoothed."""
    counts = np.full((2, buckets), alpha)
    for x, y in zip(rows, good, strict=True):
        counts[int(y == 1), x] += 1  # a row's buckets are distinct
    shares = counts / counts.sum(1)[:, None]
    return np.log(shares[1] / shares[0])


def dual_coordinate_descent(rows: list[np.ndarray], good: np.ndarray, ratio: np.ndarray, cost: float = 1.0,
                            epochs: int = 12, tolerance: float = 1e-3) -> tuple[np.ndarray, float]:
    """Weights (before scaling) and intercept of the L1-loss linear SVM.

    min |w|^2/2 + cost * sum hinge, by its dual: one multiplier per row in
    [0, cost], updated in random order. Rows are divided by the root of their number
    of features; the intercept is the weight of a constant feature.
    """
    rng = np.random.default_rng(7)
    n = len(rows)
    y = np.where(good == 1, 1.0, -1.0)
    values = [(ratio[x] / np.sqrt(max(1, len(x)))).astype(np.float32) for x in rows]
    square = np.array([float(v @ v) for v in values]) + 1.0
    w, bias, a = np.zeros(len(ratio)), 0.0, np.zeros(n)
    for _ in range(epochs):
        most = 0.0
        for i in rng.permutation(n):
            gradient = y[i] * (float(w[rows[i]] @ values[i]) + bias) - 1.0
            new = min(max(a[i] - gradient / square[i], 0.0), cost)
            step = new - a[i]
            if step:
                w[rows[i]] += step * y[i] * values[i]
                bias += step * y[i]
                a[i] = new
                most = max(most, abs(step) / cost)
        if most < tolerance:
            break
    return w, bias


def _curve(margins: np.ndarray, good: np.ndarray) -> tuple[float, float]:
    """Slope and offset of the logistic curve (Newton steps on smoothed targets)."""
    pos, neg = float((good == 1).sum()), float((good != 1).sum())
    target = np.where(good == 1, (pos + 1) / (pos + 2), 1 / (neg + 2))
    x = np.stack([margins, np.ones_like(margins)], 1)
    theta = np.array([1.0, 0.0])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ theta, -30, 30)))
        hessian = (x * (p * (1 - p))[:, None]).T @ x + 1e-6 * np.eye(2)
        step = np.linalg.solve(hessian, x.T @ (p - target))
        theta = theta - np.clip(step, -2, 2)
        if np.abs(step).max() < 1e-6:
            break
    return float(max(theta[0], 1e-3)), float(theta[1])


def train(rows: list[np.ndarray], good: list[int], buckets: int = 2 * BUCKETS) -> Model:
    """Fit on the rows' features; the curve comes from three-fold held-out margins.

    Without rows of both classes the score is the share of label 1 everywhere.
    """
    y = np.array(good, np.int64)
    if not len(y) or (y == y[0]).all():
        share = (y.sum() + 1) / (len(y) + 2)
        return Model(np.zeros(buckets), 0.0, 1.0, float(np.log(share / (1 - share))))

    def fit(some: np.ndarray) -> Model:
        own = [rows[i] for i in some]
        ratio = log_count_ratios(own, y[some], buckets)
        w, bias = dual_coordinate_descent(own, y[some], ratio)
        return Model(w * ratio, bias)

    fold = np.arange(len(rows)) % 3
    margins = np.zeros(len(rows))
    for k in range(3):
        if len(set(y[fold != k].tolist())) < 2:
            continue
        part = fit(np.flatnonzero(fold != k))
        for i in np.flatnonzero(fold == k):
            margins[i] = part.margin(rows[i])
    model = fit(np.arange(len(rows)))
    model.slope, model.offset = _curve(margins, y)
    return model


def held_out(id_col: str = "doc_id"):
    """True for rows that training must not see: crc32 of the id as text, mod 4, is 2."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string").cast("binary")) % 4 == 2, F.lit(False))


def fit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality",
        sample_rows: int = SAMPLE_ROWS) -> Model:
    """Model from at most ``sample_rows`` labelled rows outside the held-out part.

    The sample has the smallest hashes of the id; ids and labels serve only to pick
    and to teach. Null ids, null labels and ids with two different labels are left out.
    """
    picked = (labels.filter(F.col(id_col).isNotNull() & F.col(label_col).isNotNull()).filter(~held_out(id_col))
              .groupBy(F.col(id_col).alias("__id__"))
              .agg(F.min(label_col).alias("__label__"), F.max(label_col).alias("__other__"))
              .filter("__label__ = __other__")
              .orderBy(F.xxhash64("__id__"), "__id__").limit(sample_rows).select("__id__", "__label__"))
    # At most sample_rows rows: small enough to send to every executor.
    rows = (docs.select(F.col(id_col).alias("__id__"), F.col(text_col).alias("__text__"))
            .join(F.broadcast(picked), "__id__"))

    def start():
        seen = np.zeros(2 * BUCKETS, np.int32)

        def batch(texts: pa.Array) -> list[pa.Array]:
            return [pa.array([np.sort(features(t, seen)).astype("<i4").tobytes() for t in texts.to_pylist()],
                             pa.binary())]

        return batch

    # Features come to the driver, not texts.
    got = (map_texts(rows, "__text__", [field("__ids__", "binary")], start).groupBy("__id__")
           .agg(F.min("__ids__").alias("__ids__"), F.min("__label__").alias("__label__"))
           .orderBy(F.xxhash64("__id__"), "__id__").select("__ids__", "__label__").collect())
    # The rows stay the 4-byte numbers that came; nothing in the fit is larger than they are.
    return train([np.frombuffer(r[0], "<i4") for r in got], [int(r[1] == 1) for r in got])


def score(docs: DataFrame, model: Model, text_col: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """``docs`` with score (double) and predicted (int: 1 from ``threshold`` on)."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def start():
        model = shared.value
        seen = np.zeros(len(model.weight), np.int32)

        def batch(texts: pa.Array) -> list[pa.Array]:
            scores = [model.score(model.margin(features(t, seen, len(model.weight) // 2))) for t in texts.to_pylist()]
            return [pa.array(scores, pa.float64()), pa.array([int(x >= threshold) for x in scores], pa.int32())]

        return batch

    return map_texts(docs, text_col, [field("score", "double"), field("predicted", "int")], start)


def classify(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
             label_col: str = "quality", sample_rows: int = SAMPLE_ROWS, threshold: float = THRESHOLD) -> DataFrame:
    """Fit on the labelled rows, then score every row of ``docs``."""
    return score(docs, fit(docs, labels, id_col, text_col, label_col, sample_rows), text_col, threshold)

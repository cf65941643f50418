"""Toxicity: a linear classifier on character n-grams scaled by naive Bayes log-count ratios.

Features are the hashed 3- to 5-grams that a text holds (once each). Their weight is the log ratio of the naive
Bayes shares in toxic and other texts times a coefficient learnt by logistic loss. N-grams whose ratio
is within chance weigh nothing. Margins of rows left out of the fit, fold by fold, are calibrated to probabilities
for a stream in which `TOXIC_SHARE` of the texts are toxic.

The fit uses at most `per_class` labelled rows of each class, those with the smallest hash of the id: a documented
bound, which is also the bound of what the driver gathers. Scoring is a map over all rows and whole texts.

Null texts count as empty and get the score of a text without features. Labels that are null are left out; a
document with several labels takes the largest. Without labels of both classes every score is the share of the
class that is there, or 0 without labels. Extra columns are carried, never used.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from .common import order_hash, small_batches, unpack, whole_row
from .ngrams import BITS, buckets

PER_CLASS = 1500
ALPHA = 1.0
SURE = 3.0
FOLDS = 3
TOXIC_SHARE = 0.2
EPOCHS = 8
RATE = 0.1
DECAY = 1e-4


@dataclass(frozen=True)
class Model:
    weights: np.ndarray  # of each bucket: ratio times coefficient
    slope: float
    offset: float

    def score(self, text: str | None) -> float:
        return score_text(text, self.weights, self.slope, self.offset)


def score_text(text: str | None, weights: np.ndarray, slope: float, offset: float) -> float:
    z = slope * float(weights[buckets(text)].sum(dtype=np.float64)) + offset
    return float(1 / (1 + np.exp(-np.clip(z, -35, 35))))


def labelled_sample(df: DataFrame, labels: DataFrame, label: str, id_col: str, text_col: str, allowed: Column | None, per_class: int) -> DataFrame:
    """(id, text, y) of at most per_class labelled rows of each class; `allowed` is a condition on `id`. The ids are bounded, so they are broadcast."""
    marks = (labels.where(F.col(label).isNotNull() & F.col(id_col).isNotNull()).groupBy(F.col(id_col).alias("id"))
             .agg(F.max((F.col(label) > 0).cast("int")).alias("y")))
    marks = marks if allowed is None else marks.where(allowed)
    some = [marks.where(F.col("y") == y).orderBy(order_hash(F.col("id")), "id").limit(per_class) for y in (0, 1)]
    picked = F.broadcast(some[0].unionByName(some[1]))
    return df.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).join(picked, "id")


def _features(batches):
    for b in batches:
        found = [buckets(t) for t in b.column("text").to_pylist()]
        yield pa.record_batch({"id": b.column("id").cast(pa.int64()), "y": b.column("y").cast(pa.int32()), "idx": pa.array([x.tobytes() for x in found], pa.binary())})


def _platt(z: np.ndarray, y: np.ndarray, w: np.ndarray) -> tuple[float, float]:
    """Slope and offset of a logistic curve over margins, by Newton steps; a small ridge keeps separable cases finite."""
    scale = max(1e-6, float(np.abs(z).mean()))
    x, a, b = z / scale, 1.0, 0.0
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(a * x + b, -35, 35)))
        g = np.array([(w * (p - y) * x).sum() + 1e-2 * a, (w * (p - y)).sum() + 1e-3 * b])
        s = w * p * (1 - p)
        h = np.array([[(s * x * x).sum() + 1e-2, (s * x).sum()], [(s * x).sum(), s.sum() + 1e-3]])
        step = np.linalg.solve(h, g)
        step *= min(1.0, 2.0 / max(1e-9, float(np.abs(step).max())))
        a, b = a - step[0], b - step[1]
    return a / scale, b


def _weights(rows: list[tuple[np.ndarray, int]], fit: list[int]) -> np.ndarray:
    """Ratio times coefficient of each bucket, from the rows numbered in `fit`."""
    size, classes = 1 << BITS, [rows[i][1] for i in fit]
    counts = np.full((2, size), ALPHA)
    for i in fit:
        counts[rows[i][1]][rows[i][0]] += 1
    ratio = np.log(counts[1] / counts[1].sum()) - np.log(counts[0] / counts[0].sum())
    ratio[np.abs(ratio) < SURE * np.sqrt(1 / counts[0] + 1 / counts[1])] = 0  # shares that chance explains count as equal
    used = [rows[i][0][ratio[rows[i][0]] != 0] for i in fit]
    scaled = [(ratio[x] / max(1.0, np.sqrt(len(x)))).astype(np.float32) for x in used]
    v, seen, bias, bias_seen = np.zeros(size, np.float32), np.full(size, 1e-6, np.float32), 0.0, 1e-6
    even = [len(fit) / 2 / max(1, classes.count(c)) for c in (0, 1)]
    for _ in range(EPOCHS):
        for idx, x, y in zip(used, scaled, classes):
            p = 1 / (1 + np.exp(-np.clip(float(v[idx] @ x) + bias, -35, 35)))
            d = even[y] * (p - y)
            g = np.float32(d) * x + np.float32(DECAY) * v[idx]
            seen[idx] += g * g
            v[idx] -= np.float32(RATE) * g / np.sqrt(seen[idx])
            bias_seen += d * d
            bias -= RATE * d / np.sqrt(bias_seen)
    return (v * ratio).astype(np.float32)


def learn(rows: list[tuple[np.ndarray, int]]) -> Model:
    """rows: distinct buckets and label, in a fixed order. Margins for the calibration come from models that did not see the row."""
    y = np.array([v for _, v in rows])
    if not len(y) or y.min() == y.max():
        share = float(y.mean()) if len(y) else 0.0
        return Model(np.zeros(1 << BITS, np.float32), 1.0, 35.0 if share == 1 else -35.0)
    z, everyone = np.zeros(len(y)), range(len(y))
    turn = np.zeros(len(y), int)
    for c in (0, 1):  # each fold has its part of either class
        turn[y == c] = np.arange(int((y == c).sum())) % FOLDS
    for fold in range(FOLDS):
        weights = _weights(rows, [i for i in everyone if turn[i] != fold])
        for i in np.flatnonzero(turn == fold):
            z[i] = weights[rows[i][0]].sum(dtype=np.float64)
    share = np.where(y == 1, TOXIC_SHARE / max(1, int((y == 1).sum())), (1 - TOXIC_SHARE) / max(1, int((y == 0).sum())))
    return Model(_weights(rows, list(everyone)), *_platt(z, y, share * len(y)))


def fit(df: DataFrame, labels: DataFrame, label: str = "toxic", id_col: str = "doc_id", text_col: str = "text",
        allowed: Column | None = None, per_class: int = PER_CLASS) -> Model:
    sample = labelled_sample(df, labels, label, id_col, text_col, allowed, per_class)
    found = sample.mapInArrow(_features, "id long, y int, idx binary").collect()
    found.sort(key=lambda r: (hash((r["id"] * 2654435761) % (1 << 32)), r["id"], r["y"], r["idx"]))
    return learn([(np.frombuffer(r["idx"], np.int32), r["y"]) for r in found])


def score(df: DataFrame, model: Model, text_col: str = "text", out: str = "score") -> DataFrame:
    """Add the score of each row's whole text. The model's tables are of fixed size."""
    small_batches(df.sparkSession)
    shared = df.sparkSession.sparkContext.broadcast((model.weights, model.slope, model.offset))
    kind = F.pandas_udf(lambda s: s.map(lambda x: score_text(x, *shared.value)).astype("float64"), "double")
    return df.withColumn(out, kind(F.coalesce(F.col(text_col).cast("string"), F.lit(""))))


def keep_clean(df: DataFrame, model: Model, text_col: str = "text", cut: float = 0.5) -> DataFrame:
    """The rows that score below the cut, with all their columns."""
    rows = df.select(F.col(text_col).alias("text"), whole_row().alias("row"))
    return unpack(score(rows, model).where(F.col("score") < cut))

"""Toxicity scores by a linear classifier on character n-grams scaled by naive Bayes log-count ratios.

A text's features are the distinct hashes of its 3- to 7-grams of lower-cased characters (white space as one blank
kind, a blank before and after). A hash found twice or more in a text counts as one more feature, so that one word of a shared passage and a text
full of such words differ. Training, on labelled rows outside the held-out fold:

1. per hash, the toxic and other documents that have it (counted on the executors, which send the hashes they found,
   summed by cell);
2. the log ratio r of the two smoothed shares; the ``features`` hashes whose shares differ most by standard error;
3. logistic regression with an L2 penalty on values r of the hashes present, classes weighted to count alike.

The model is a table of 2**BITS weights (4 MB). It is fitted on a bounded sample of labelled rows: at most about
``max_train`` of them, chosen by a hash of doc_id, so the fit costs the same on any corpus; scoring reads every whole
text. Labels, language, source and doc_id never enter a score.

Defined cases: null and empty texts have no features and score by the intercept; without labelled rows of both
kinds every score is the share of toxic ones (0 if there is none); repeated rows score alike; a null doc_id is
scored and counts as not held out; a label that is null does not train. Other columns are ignored.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import materialize
from .common import SLICE_BYTES

BITS = 20
GRAMS = (3, 4, 5, 6, 7)
MAX_TRAIN = 8_000
FEATURES = 1 << 13
CELL = 1 << 12
PART_ROWS = 500

_MULTIPLIER = np.uint64(0x9E3779B97F4A7C15)


def gram_sets(texts: list[str | None]):
    """For each text the sorted distinct hashes of its n-grams; about a megabyte of texts at a time."""
    at = 0
    while at < len(texts):
        part, size = [], 0
        while at < len(texts) and (not part or size < SLICE_BYTES):
            part.append(f" {(texts[at] or '').lower()} ")
            size += len(part[-1])
            at += 1
        points = np.frombuffer("".join(part).encode("utf-32-le", "surrogatepass"), dtype=np.uint32).astype(np.uint64)
        points = np.where((points >= 9) & (points <= 13), np.uint64(32), points)
        value = (points + np.uint64(1)) * _MULTIPLIER
        value ^= value >> np.uint64(29)
        hashes, run = [], value
        for n in range(2, GRAMS[-1] + 1):
            run = run[:-1] * _MULTIPLIER + value[n - 1 :]
            if n >= GRAMS[0]:
                h = (run ^ (run >> np.uint64(32))) * _MULTIPLIER
                hashes.append((h >> np.uint64(64 - BITS)).astype(np.uint32))
        begin = 0
        for t in part:
            found = [h[begin : begin + len(t) - n + 1] for n, h in zip(GRAMS, hashes) if len(t) >= n]
            begin += len(t)
            if not found:
                yield np.zeros(0, np.uint32)
                continue
            s = np.sort(np.concatenate(found))
            first = np.concatenate(([True], s[1:] != s[:-1]))
            again = s[1:][first[:-1] & ~first[1:]]  # found twice or more
            yield np.concatenate((s[first], again ^ np.uint32(1 << (BITS - 1))))


@dataclass
class Model:
    """Weights by hash (the log-count ratio multiplied in) and the intercept."""

    weights: np.ndarray
    intercept: float

    def score(self, hashes: np.ndarray) -> float:
        z = float(self.weights[hashes].sum(dtype=np.float64)) + self.intercept
        return float(1.0 / (1.0 + np.exp(-np.clip(z, -30, 30))))


def held_out():
    """The fold that is never trained on."""
    return F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 5 == 0, F.lit(False))


def training_rows(docs: DataFrame, labels: DataFrame, max_train: int = MAX_TRAIN) -> DataFrame:
    """(text, toxic) of labelled rows outside the held-out fold, about ``max_train`` at most."""
    known = labels.filter("toxic is not null and doc_id is not null").groupBy("doc_id").agg(
        F.max(F.col("toxic").cast("int")).alias("toxic")).filter(~held_out())
    n = known.count()
    if n > max_train:
        known = known.filter(F.pmod(F.xxhash64("doc_id"), F.lit(1_000_000)) < int(1_000_000 * max_train / n))
    return docs.select("doc_id", "text").join(known, "doc_id").select("text", "toxic")


def _count_task(rows):
    counts = np.zeros((2, 1 << BITS), np.int32)
    n = [0, 0]
    for batch in rows:
        labels = batch.column(1).to_pylist()
        for h, y in zip(gram_sets(batch.column(0).to_pylist()), labels):
            counts[y][h] += 1
            n[y] += 1
    if sum(n):
        cells = [(-1, np.zeros(1, np.int16).tobytes(), *(np.array([x], np.int32).tobytes() for x in n))]
        for c in range(0, 1 << BITS, CELL):
            part = counts[:, c : c + CELL]
            there = np.flatnonzero(part.any(axis=0))
            if len(there):
                cells.append((c // CELL, there.astype(np.int16).tobytes(), part[0, there].tobytes(), part[1, there].tobytes()))
        kinds = (pa.int32(), pa.binary(), pa.binary(), pa.binary())
        yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in cells], t) for i, t in enumerate(kinds)],
                                         ["cell", "places", "other", "toxic"])


def _sum_cells(key, g):
    import pandas as pd

    at = np.concatenate([np.frombuffer(x, np.int16) for x in g["places"]])
    out = {"cell": [key[0]]}
    for c in ("other", "toxic"):
        n = np.concatenate([np.frombuffer(x, np.int32) for x in g[c]])
        out[c] = [np.bincount(at, n, CELL).astype(np.int32).tobytes()]
    return pd.DataFrame(out)


def _kept_task(shared):
    def task(rows):
        number = shared.value  # feature number by hash, -1 if it is none
        for batch in rows:
            found = []
            for h in gram_sets(batch.column(0).to_pylist()):
                f = number[h]
                found.append(f[f >= 0].astype(np.int32).tobytes())
            yield pa.RecordBatch.from_arrays([batch.column(1), pa.array(found, pa.binary())], ["toxic", "features"])

    return task


def _regression(features: list[np.ndarray], y: np.ndarray, ratio: np.ndarray, penalty: float = 0.5,
                rounds: int = 120) -> tuple[np.ndarray, float]:
    """Weights of a logistic regression on values ``ratio`` of the features present, by accelerated gradient steps.
    Rows are taken in parts, so the working arrays stay small."""
    importance = np.where(y == 1, 0.5 / max(y.sum(), 1), 0.5 / max((1 - y).sum(), 1)) * len(y)
    # features scaled so that an average document has length 1
    square = ratio.astype(np.float64) ** 2
    scale = np.sqrt(max(sum(float(square[f].sum()) for f in features) / len(y), 1e-9))
    value = ratio / scale
    parts = []
    for at in range(0, len(y), PART_ROWS):
        part = features[at : at + PART_ROWS]
        row = np.repeat(np.arange(len(part), dtype=np.int32), [len(f) for f in part])
        parts.append((slice(at, at + len(part)), row, np.concatenate(part)))
    w, b = np.zeros(len(ratio)), 0.0
    look_w, look_b, step = w, b, 1.0
    for t in range(1, rounds + 1):
        grad_w, grad_b, scaled = penalty / len(y) * look_w, 0.0, look_w * value
        for rows, row, column in parts:
            n = len(y[rows])
            z = np.bincount(row, scaled[column], n) + look_b
            gap = importance[rows] * (1 / (1 + np.exp(-np.clip(z, -30, 30))) - y[rows]) / len(y)
            grad_w = grad_w + value * np.bincount(column, gap[row], len(ratio))
            grad_b += gap.sum()
        new_w, new_b = look_w - step * grad_w, look_b - step * grad_b
        push = (t - 1) / (t + 2)
        look_w, look_b = new_w + push * (new_w - w), new_b + push * (new_b - b)
        w, b = new_w, new_b
    return w * value, float(b)


def fit(docs: DataFrame, labels: DataFrame, *, max_train: int = MAX_TRAIN, features: int = FEATURES) -> Model:
    """Train on the labelled rows of ``docs`` (doc_id, text) and ``labels`` (doc_id, toxic)."""
    spark = docs.sparkSession
    sample = materialize(training_rows(docs, labels, max_train), "sample")  # read twice below
    sums = sample.mapInArrow(_count_task, "cell int, places binary, other binary, toxic binary").groupBy("cell").applyInPandas(
        _sum_cells, "cell int, other binary, toxic binary").collect()  # 2**BITS counts of each class
    counts, n = np.zeros((2, 1 << BITS), np.float32), np.zeros(2)
    for r in sums:
        for y, c in enumerate(("other", "toxic")):
            got = np.frombuffer(r[c], np.int32)
            if r["cell"] < 0:
                n[y] = got[0]
            else:
                counts[y, r["cell"] * CELL : (r["cell"] + 1) * CELL] = got
    weights = np.zeros(1 << BITS, np.float32)
    if not n.all():
        share = n[1] / max(n.sum(), 1)
        return Model(weights, float(np.log(max(share, 1e-9) / max(1 - share, 1e-9))))
    share = (counts + 1) / (n[:, None] + 2)
    ratio = np.log(share[1] / share[0])
    error = np.sqrt(share[0] * (1 - share[0]) / n[0] + share[1] * (1 - share[1]) / n[1])
    apart = np.where(counts.sum(axis=0) >= 3, np.abs(share[1] - share[0]) / error, 0)
    chosen = np.argsort(-apart, kind="stable")[: min(features, int((apart > 0).sum()))]
    number = np.full(1 << BITS, -1, np.int32)
    number[chosen] = np.arange(len(chosen))
    shared = spark.sparkContext.broadcast(number)
    kept = sample.mapInArrow(_kept_task(shared), "toxic int, features binary").toPandas()  # max_train rows
    # rows in a set order, so that the fit does not depend on how Spark returns them
    kept = kept.sort_values(["toxic", "features"])
    w, b = _regression([np.frombuffer(x, np.int32) for x in kept["features"]], kept["toxic"].to_numpy(), ratio[chosen])
    weights[chosen] = w
    return Model(weights, b)


def _score_task(shared):
    def task(rows):
        model = shared.value
        for batch in rows:
            scores = [model.score(h) for h in gram_sets(batch.column(1).to_pylist())]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(scores, pa.float64())], ["doc_id", "score"])

    return task


def score_toxicity(docs: DataFrame, labels: DataFrame, *, max_train: int = MAX_TRAIN) -> DataFrame:
    """(doc_id, held_out, score, predicted) for every row of ``docs``. See the module text."""
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    scored = scores(docs, fit(docs, labels, max_train=max_train))
    return scored.select("doc_id", held_out().alias("held_out"), "score", "predicted")


def scores(docs: DataFrame, model: Model) -> DataFrame:
    """(doc_id, score, predicted) by a fitted model for every row of ``docs`` (doc_id, text)."""
    shared = docs.sparkSession.sparkContext.broadcast((model.weights, model.intercept))
    scored = docs.mapInArrow(_score_task(_Unpacked(shared)), "doc_id long, score double")
    return scored.select("doc_id", "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


class _Unpacked:
    """A broadcast pair seen as a Model on the executors."""

    def __init__(self, shared):
        self.shared = shared

    @property
    def value(self) -> Model:
        return Model(*self.shared.value)

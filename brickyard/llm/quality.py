"""Quality classifier: logistic regression on hashed word n-grams, trained by
follow-the-regularised-leader (FTRL-proximal) updates, scored as sparse dot products.

Features of a text are its words (runs of letters and digits, as written), runs of
punctuation, and pairs of neighbours of both; each is hashed to one of 2**BITS
places with value 1 + ln(count), and the whole vector has length 1. Nothing but the
text is an input.

Training takes at most ``max_rows`` labelled documents, those of least
``xxhash64(doc_id)`` among the rows allowed (a documented bound: the model is fitted
on a sample, every document is scored). Their features are computed where the texts
are; one task streams them, ``epochs`` times, through the updates and keeps only the
2**BITS coordinates. Scoring maps over the scan and shuffles nothing.

Empty and NULL texts have no features: their score is the model's intercept. Rows
are scored one by one, so repeated rows get equal scores. Without a usable label
every score is 0.5. Labels that contradict each other for one document count as the
larger one; NULL labels are left out.
"""
from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .tables import written
from .words import KINDS, Words, column, ngrams, slices

BITS = 18
MAX_ROWS = 8_000
EPOCHS = 3


def features(arr: pa.Array, bits: int = BITS) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, place, value) of the non-zero coordinates, ascending by row and place."""
    w = Words(arr, classes=KINDS)
    pairs = ngrams(w.hashes, 2)
    inside = w.rows[1:] == w.rows[:-1]
    rows = np.concatenate([w.rows, w.rows[1:][inside]])
    places = np.concatenate([w.hashes, pairs[inside]]) >> np.uint64(64 - bits)
    key, count = np.unique((rows.astype(np.uint64) << np.uint64(bits)) | places, return_counts=True)
    rows, places = (key >> np.uint64(bits)).astype(np.int64), (key & np.uint64((1 << bits) - 1)).astype(np.int64)
    value = 1 + np.log(count)
    norm = np.sqrt(np.bincount(rows, value * value, len(arr)))
    return rows, places, value / norm[rows]


class Ftrl:
    """Follow-the-regularised-leader, per coordinate; the last one is the intercept."""

    def __init__(self, bits: int = BITS, alpha: float = 1.0, beta: float = 1.0, l1: float = 0.0, l2: float = 0.1):
        self.alpha, self.beta, self.l1, self.l2 = alpha, beta, l1, l2
        self.z, self.n = np.zeros((1 << bits) + 1), np.zeros((1 << bits) + 1)

    def weights(self, at=slice(None)) -> np.ndarray:
        z, n = self.z[at], self.n[at]
        w = -(z - np.sign(z) * self.l1) / ((self.beta + np.sqrt(n)) / self.alpha + self.l2)
        return np.where(np.abs(z) <= self.l1, 0.0, w)

    def update(self, places: np.ndarray, values: np.ndarray, label: int, weight: float = 1.0) -> None:
        at, x = np.append(places, len(self.z) - 1), np.append(values, 1.0)
        w = self.weights(at)
        p = 1 / (1 + np.exp(-np.clip(w @ x, -30, 30)))
        g = weight * (p - label) * x
        sigma = (np.sqrt(self.n[at] + g * g) - np.sqrt(self.n[at])) / self.alpha
        self.z[at] += g - sigma * w
        self.n[at] += g * g


def train(docs: DataFrame, labels: DataFrame, *, allowed: Column, text: str = "text", id: str = "doc_id",
          label: str = "quality", max_rows: int = MAX_ROWS, epochs: int = EPOCHS, bits: int = BITS) -> np.ndarray:
    """Weights fitted on the labelled rows for which ``allowed`` (a condition on the id) holds."""
    known = (labels.select(F.col(id).alias("id"), F.col(label).cast("int").alias("y"))
             .where(F.col("id").isNotNull() & F.col("y").isNotNull()).groupBy("id").agg((F.max("y") > 0).cast("int").alias("y"))
             .withColumnRenamed("id", id).where(allowed).withColumnRenamed(id, "id"))
    sample = written(known.orderBy(F.xxhash64("id"), "id").limit(max_rows), "quality-labels")
    shares = {r["y"]: r["n"] for r in sample.groupBy("y").agg(F.count(F.lit(1)).alias("n")).collect()}  # two rows
    weight = {y: sum(shares.values()) / (len(shares) * n) for y, n in shares.items()}
    picked = (docs.select(F.col(id).alias("id"), F.col(text).cast("string").alias("text"))
              .join(F.broadcast(sample), "id"))            # max_rows rows of two numbers at most

    def extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            b = b.select(["id", "text", "y"])
            arr = column(b.column(1))
            for lo, hi in slices(arr):
                rows, places, values = features(arr.slice(lo, hi - lo), bits)
                offs = pa.array(np.searchsorted(rows, np.arange(hi - lo + 1)).astype(np.int32))
                yield pa.RecordBatch.from_arrays(
                    [b.column(0).slice(lo, hi - lo), b.column(2).slice(lo, hi - lo),
                     pa.ListArray.from_arrays(offs, pa.array(places.astype(np.int32))),
                     pa.ListArray.from_arrays(offs, pa.array(values.astype(np.float32)))],
                    ["id", "y", "places", "vals"])

    kind = picked.schema["id"].dataType.simpleString()
    rows = written(picked.select("id", "text", "y").mapInArrow(
        extract, f"id {kind}, y int, places array<int>, vals array<float>"), "quality-features")

    def learn(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = Ftrl(bits)
        for b in batches:
            for y, places, vals in zip(b.column(0).to_pylist(), b.column(1), b.column(2), strict=True):
                model.update(places.values.to_numpy().astype(np.int64), vals.values.to_numpy().astype(np.float64), y,
                             weight[y])
        yield pa.RecordBatch.from_arrays([pa.array([model.weights().astype(np.float32).tobytes()])], ["weights"])

    passes = rows.withColumn("epoch", F.explode(F.sequence(F.lit(1), F.lit(epochs))))
    fitted = (passes.repartition(1).sortWithinPartitions("epoch", F.xxhash64(F.lit(7), "id"), "id")
              .select("y", "places", "vals").mapInArrow(learn, "weights binary").first())
    return np.frombuffer(fitted["weights"], np.float32) if fitted else np.zeros((1 << bits) + 1, np.float32)


def score(df: DataFrame, weights: np.ndarray, *, text: str = "text", id: str = "doc_id") -> DataFrame:
    """One row per row of ``df``: the id column, ``score`` (0 to 1) and ``predicted``."""
    bits = (len(weights) - 1).bit_length() - 1
    held = df.sparkSession.sparkContext.broadcast(np.asarray(weights, np.float32))   # 1 MB at 18 bits
    work = df.select(F.col(id).alias("id"), F.col(text).cast("string").alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        w = held.value.astype(np.float64)
        for b in batches:
            arr, dot = column(b.column(1)), np.full(b.num_rows, w[-1])
            for lo, hi in slices(arr):
                rows, places, values = features(arr.slice(lo, hi - lo), bits)
                dot[lo:hi] += np.bincount(rows, w[places] * values, hi - lo)
            p = 1 / (1 + np.exp(-np.clip(dot, -500, 500)))
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.array(p), pa.array((p >= 0.5).astype(np.int32))], ["id", "score", "predicted"])

    out = work.mapInArrow(run, f"id {work.schema['id'].dataType.simpleString()}, score double, predicted int")
    return out.withColumnRenamed("id", id)


def held_out(id: str = "doc_id") -> Column:
    """Rows that no label is learned from: crc32 of the id's text leaves 1 modulo 3."""
    return F.coalesce(F.crc32(F.col(id).cast("string")) % 3 == 1, F.lit(False))


def quality(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Train on the rows that are not held out and score every document."""
    weights = train(docs, labels, allowed=~held_out())
    return score(docs, weights).select("doc_id", held_out().alias("held_out"), "score", "predicted")

"""Toxicity as a factorization machine over hashed terms (operator 10).

A text is the set of its lower-case terms (runs of letters), hashed to
``2 ** bits`` columns.  A column's scale is the logarithm of how far its share
of positive texts lies outside what chance explains (``NOISE`` standard
deviations), so columns that tell nothing are left out of the machine.
The machine adds to the linear weights the inner products of learned factor
vectors of every pair of present terms, in time linear in the terms, so a
pair can mean more than its terms on their own.

Learning takes at most ``max_rows`` labels, a documented bound (labels are
ranked by a hash, so the sample does not depend on partitions); the hashed
terms of their texts are made by Spark and only these bounded rows reach the
driver.  Scoring covers every row in Arrow tasks, whole texts.

Input handling: null or empty texts have no terms and get the score of the
bias alone; labels that are null are not learned from; if no labelled row of
either class is left the model is the constant share of positives (0.5 for
none); repeated rows get equal scores; other columns are ignored.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

BITS = 18
FACTORS = 4
MAX_ROWS = 20_000        # labelled rows that learning takes at most
EPOCHS = 12
BATCH = 64
RATE = 0.08
DECAY = 2e-6
THRESHOLD = 0.3
NOISE = 3.5              # standard deviations that chance is allowed
_TERMS = re.compile(r"[^\W\d_]+")
_CACHE_WORDS = 500_000


class Hasher:
    """Terms of a text as sorted distinct columns; remembers frequent words."""

    def __init__(self, bits: int):
        self.mask, self.known = (1 << bits) - 1, {}

    def _word(self, word: str) -> tuple[int, ...]:
        if len(self.known) > _CACHE_WORDS:
            self.known.clear()
        out = tuple(zlib.crc32(t.encode()) & self.mask for t in _TERMS.findall(word.lower()))
        self.known[word] = out
        return out

    def columns(self, text: str) -> np.ndarray:
        get = self.known.get
        found: set[int] = set()
        for w in set(text.split()):
            hit = get(w)
            found.update(self._word(w) if hit is None else hit)
        return np.sort(np.fromiter(found, np.int64, len(found)))


def _flat(rows: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    at = np.concatenate(([0], np.cumsum([len(r) for r in rows])))
    return (np.concatenate(rows) if rows else np.zeros(0, np.int64)), at


def _sums(values: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Sums of the row ranges of ``values``; empty rows give 0."""
    total = np.concatenate((np.zeros((1, *values.shape[1:])), np.cumsum(values, axis=0)))
    return total[at[1:]] - total[at[:-1]]


@dataclass
class Machine:
    """A trained machine: bias, linear weights, factors and term scales."""

    bits: int
    bias: float
    linear: np.ndarray
    factors: np.ndarray
    scale: np.ndarray

    def margin(self, columns: np.ndarray, at: np.ndarray) -> np.ndarray:
        x = self.scale[columns]
        vx = self.factors[columns] * x[:, None]
        pairs = 0.5 * (_sums(vx, at) ** 2 - _sums(vx ** 2, at)).sum(axis=1)
        return self.bias + _sums(self.linear[columns] * x, at) + pairs

    def score(self, columns: np.ndarray, at: np.ndarray) -> np.ndarray:
        return 1.0 / (1.0 + np.exp(-np.clip(self.margin(columns, at), -30, 30)))


def train(rows: list[np.ndarray], labels: np.ndarray, bits: int = BITS, factors: int = FACTORS,
          epochs: int = EPOCHS, seed: int = 11) -> Machine:
    """Fit by mini-batch AdaGrad on the log loss."""
    size = 1 << bits
    rng = np.random.default_rng(seed)
    n, positives = len(rows), int(labels.sum())
    share = positives / n if n else 0.5
    columns, at = _flat(rows)
    # How far each column's share of positives is from the share of all.
    df = np.bincount(columns, minlength=size).astype(float)
    hits = np.bincount(columns, np.repeat(labels, np.diff(at)), minlength=size)
    spread = np.sqrt(np.maximum(df * share * (1 - share) * (1 - df / max(n, 1)), 1e-9))
    away = np.abs(hits - df * share) / spread
    scale = np.where(df >= 3, np.log1p(np.maximum(away - NOISE, 0)), 0.0)
    bias = float(np.log(max(share, 1e-3) / max(1 - share, 1e-3)))
    model = Machine(bits, bias, np.zeros(size), rng.normal(0, 0.02, (size, factors)), scale)
    if not 0 < positives < n:
        model.factors[:] = 0
        return model
    rows = [r[scale[r] > 0] for r in rows]
    seen_w, seen_v, seen_b = np.full(size, 1e-6), np.full((size, factors), 1e-6), 1e-6
    for _ in range(epochs):
        order = rng.permutation(n)
        for lo in range(0, n, BATCH):
            part = [rows[i] for i in order[lo:lo + BATCH]]
            c, a = _flat(part)
            x = scale[c]
            vx = model.factors[c] * x[:, None]
            total = _sums(vx, a)
            margin = (model.bias + _sums(model.linear[c] * x, a)
                      + 0.5 * (total ** 2 - _sums(vx ** 2, a)).sum(axis=1))
            p = 1.0 / (1.0 + np.exp(-np.clip(margin, -30, 30)))
            error = (p - labels[order[lo:lo + BATCH]]) / len(part)
            e = np.repeat(error, np.diff(a))
            used, where = np.unique(c, return_inverse=True)
            gw = np.bincount(where, e * x, len(used)).astype(float) + DECAY * model.linear[used]
            gv = (e * x)[:, None] * (np.repeat(total, np.diff(a), axis=0) - vx)
            gv = np.stack([np.bincount(where, gv[:, k], len(used)) for k in range(factors)], 1).astype(float)
            gv += DECAY * model.factors[used]
            seen_w[used] += gw ** 2
            seen_v[used] += gv ** 2
            gb = float(error.sum())
            seen_b += gb ** 2
            model.linear[used] -= RATE * gw / np.sqrt(seen_w[used])
            model.factors[used] -= 0.25 * RATE * gv / np.sqrt(seen_v[used])
            model.bias -= 0.25 * RATE * gb / np.sqrt(seen_b)
    return model


def _column_batches(bits: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher = Hasher(bits)
        for batch in batches:
            for lo in range(0, max(batch.num_rows, 1), 512):
                part = batch.slice(lo, 512)
                rows = [hasher.columns(t or "").astype("<i4").tobytes() for t in part.column(1).to_pylist()]
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(rows, pa.binary())], ["label", "columns"])
    return run


def fit(docs: DataFrame, labels: DataFrame, bits: int = BITS, max_rows: int = MAX_ROWS, **options) -> Machine:
    """Learn from the texts of ``docs`` (doc_id, text) that ``labels``
    (doc_id, label 0/1) names: all labels, or if there are more than
    ``max_rows`` those whose doc_id has the least hash."""
    known = labels.select("doc_id", F.col("label").cast("int").alias("label")).where(
        "label is not null and doc_id is not null")
    chosen = known.orderBy(F.xxhash64("doc_id"), "doc_id", "label").limit(max_rows)
    # At most max_rows pairs of numbers: small by its own bound.
    rows = docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id").select("label", "text")
    found = rows.mapInArrow(_column_batches(bits), "label int, columns binary").collect()
    found = sorted((bytes(r.columns), r.label) for r in found)
    return train([np.frombuffer(c, "<i4").astype(np.int64) for c, _ in found],
                 np.array([y for _, y in found], float), bits, **options)


def _score_batches(shared):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = Machine(*shared.value)
        hasher = Hasher(model.bits)
        for batch in batches:
            for lo in range(0, max(batch.num_rows, 1), 512):
                part = batch.slice(lo, 512)
                columns, at = _flat([hasher.columns(t or "") for t in part.column(1).to_pylist()])
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.array(model.score(columns, at))], ["doc_id", "score"])
    return run


def score(docs: DataFrame, model: Machine, threshold: float = THRESHOLD) -> DataFrame:
    """doc_id, score and predicted (1 where score >= threshold) of every row.
    The model has a fixed size: 2 ** bits columns of factors + 2 numbers."""
    spark = docs.sparkSession
    shared = spark.sparkContext.broadcast(
        (model.bits, model.bias, model.linear.astype(np.float32), model.factors.astype(np.float32),
         model.scale.astype(np.float32)))
    kind = dict(docs.dtypes)["doc_id"]
    scored = docs.select("doc_id", "text").mapInArrow(_score_batches(shared), f"doc_id {kind}, score double")
    return scored.withColumn("predicted", (F.col("score") >= threshold).cast("int"))

"""A classifier trained epoch by epoch, with a row of metrics an epoch (M7, M8).

Softmax regression on hashed terms by full-batch gradient descent.  A text's terms fall into a
fixed number of buckets; its vector is the bucket counts at unit length, and a constant 1 (the bias).  Features
are made without a shuffle, hashed once a distinct word of a batch, and checkpointed as counts.
An epoch is one pass over them, in slices of a bounded number of rows: each
task gets the weights (a broadcast of ``buckets + 1`` rows of three doubles, whatever the data hold), adds up the
gradient of its training rows, the loss of both splits and the confusion cells of the validation
rows, and sends at most ``buckets + 11`` rows.  Those are summed by bucket; the driver gets no more
than that many, takes the step, and decides whether to stop.

A pass measures the weights that it starts with, so epoch 0 is the untrained (or warm) start.
Training stops early if the validation loss has not fallen for ``patience`` epochs; the weights of the
epoch with the lowest one are kept.  A lost executor costs the tasks of one pass: they
are run again from the checkpoint.

Defined results: rows whose label is none of the classes are left out; a null or empty text
has the bias alone; without training rows the weights don't move; without validation rows their loss
and accuracy are null, there is no early stop, and the last weights are kept; ties of a
prediction go to the first class.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from hashlib import md5

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from moodindex.functions.text import split_words

CLASSES = 3
BUCKETS = 1 << 16
# Keys beside the buckets: loss of the training rows, of the validation rows, and a cell a
# (label, prediction) of the validation rows.
TRAIN_LOSS, VALID_LOSS, CELLS = -1, -2, -3
METRICS = "epoch int, train_loss double, valid_loss double, accuracy double, f1 double"


# Rows whose entries are worked on at once: a bound of memory, not of results.
SLICE_ROWS = 1024


def bucket_of(term: str, buckets: int = BUCKETS) -> int:
    """First four hex digits of the term's MD5, modulo the number of buckets."""
    return int.from_bytes(md5(term.encode()).digest()[:2], "big") % buckets


def _sizes(lists: pa.ListArray) -> np.ndarray:
    return np.diff(lists.offsets.to_numpy()).astype(np.int64)


def _counts(words: pa.ListArray, buckets: int) -> pa.StructArray:
    """``bucket, n`` of every row's words: buckets rise, each once."""
    terms = words.flatten().dictionary_encode()
    of_term = np.fromiter((bucket_of(t, buckets) for t in terms.dictionary.to_numpy(zero_copy_only=False)),
                          np.int64, len(terms.dictionary))
    flat, sizes = of_term[terms.indices.to_numpy()], _sizes(words)
    ends = np.concatenate([[0], np.cumsum(sizes)])
    found = [(np.zeros(0, np.int64), np.zeros(0, np.int64))]
    kept = np.zeros(len(words), np.int64)
    for a in range(0, len(words), SLICE_ROWS):
        b = min(a + SLICE_ROWS, len(words))
        cell = np.repeat(np.arange(b - a), sizes[a:b]) * buckets + flat[ends[a]:ends[b]]
        cell, n = np.unique(cell, return_counts=True)
        kept[a:b] = np.bincount(cell // buckets, minlength=b - a)
        found.append((cell % buckets, n))
    cuts = pa.array(np.concatenate([[0], np.cumsum(kept)]), pa.int32())
    lists = [pa.ListArray.from_arrays(cuts, pa.array(np.concatenate(x), pa.int32())) for x in zip(*found, strict=True)]
    return pa.StructArray.from_arrays(lists, ["bucket", "n"])


def _words(text: str) -> Column:
    return split_words(F.lower(F.coalesce(F.col(text), F.lit(""))))


def features(df: DataFrame, text: str, label: str, split: str, buckets: int = BUCKETS) -> DataFrame:
    """``y, valid, terms``: the buckets of a row's words and their counts (no shuffle)."""

    @F.arrow_udf("struct<bucket: array<int>, n: array<int>>")
    def counts(words: pa.Array) -> pa.Array:
        return _counts(words, buckets)

    return df.where(F.col(label).isin(list(range(CLASSES)))).select(
        F.col(label).cast("int").alias("y"), F.coalesce(F.col(split) == "valid", F.lit(False)).alias("valid"),
        counts(_words(text)).alias("terms"))


def _vectors(terms: pa.StructArray, buckets: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Row, bucket and value of every entry of a slice's vectors, the bias included."""
    bucket, n = terms.field("bucket"), terms.field("n")
    row = np.repeat(np.arange(len(terms)), _sizes(bucket))
    n = n.flatten().to_numpy().astype(float)
    length = np.sqrt(np.bincount(row, weights=n * n, minlength=len(terms)))
    every = np.arange(len(terms))
    return (np.concatenate([row, every]), np.concatenate([bucket.flatten().to_numpy(), np.full(len(terms), buckets)]),
            np.concatenate([n / length[row], np.ones(len(terms))]))


def softmax(z: np.ndarray) -> np.ndarray:
    e = np.exp(z - z.max(axis=1, keepdims=True))
    return e / e.sum(axis=1, keepdims=True)


def logits(terms: pa.StructArray, weights: np.ndarray) -> tuple[np.ndarray, tuple]:
    v = row, bucket, x = _vectors(terms, len(weights) - 1)
    return np.stack([np.bincount(row, weights=x * weights[bucket, c], minlength=len(terms))
                     for c in range(CLASSES)], axis=1), v


def one_pass(data: DataFrame, weights: np.ndarray) -> dict[int, tuple]:
    """``key: (g0, g1, g2, n)``: the gradient by bucket, and the measures, of given weights."""
    shared = data.sparkSession.sparkContext.broadcast(weights)  # buckets + 1 rows

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        w = shared.value
        gradient, losses, counts = np.zeros_like(w), [0.0, 0.0], [0, 0]
        cells = np.zeros(CLASSES * CLASSES, np.int64)
        for b in (b.slice(at, SLICE_ROWS) for b in batches for at in range(0, b.num_rows, SLICE_ROWS)):
            y, valid = b["y"].to_numpy().astype(np.int64), b["valid"].to_numpy(zero_copy_only=False)
            z, (row, bucket, x) = logits(b["terms"], w)
            p = softmax(z)
            loss = -np.log(np.maximum(p[np.arange(len(y)), y], 1e-15))
            for k, mask in enumerate((~valid, valid)):
                losses[k] += float(loss[mask].sum())
                counts[k] += int(mask.sum())
            cells += np.bincount(y[valid] * CLASSES + z[valid].argmax(axis=1), minlength=len(cells))
            away = p.copy()
            away[np.arange(len(y)), y] -= 1.0
            away[valid] = 0.0
            for c in range(CLASSES):
                gradient[:, c] += np.bincount(bucket, weights=x * away[row, c], minlength=len(w))
        hit = np.flatnonzero(gradient.any(axis=1))
        seen = np.flatnonzero(cells)
        yield pa.RecordBatch.from_pydict({
            "key": np.concatenate([hit, [TRAIN_LOSS, VALID_LOSS], CELLS - seen]).astype(np.int32),
            "g0": np.concatenate([gradient[hit, 0], losses, np.zeros(len(seen))]),
            "g1": np.concatenate([gradient[hit, 1], np.zeros(2 + len(seen))]),
            "g2": np.concatenate([gradient[hit, 2], np.zeros(2 + len(seen))]),
            "n": np.concatenate([np.zeros(len(hit)), counts, cells[seen]]).astype(np.int64)})

    parts = data.select("y", "valid", "terms").mapInArrow(run, "key int, g0 double, g1 double, g2 double, n long")
    sums = parts.groupBy("key").agg(*[F.sum(c).alias(c) for c in ("g0", "g1", "g2", "n")])
    cols = [c.to_pylist() for c in sums.toArrow().columns]  # at most buckets + 12 rows
    out = {key: rest for key, *rest in zip(*cols, strict=True)}
    shared.destroy()
    return out


def measures(sums: dict[int, tuple]) -> tuple[float | None, float | None, float | None, float | None]:
    """Training loss, validation loss, accuracy and F1 weighted by the classes' rows."""
    zero = (0.0, 0.0, 0.0, 0)
    train, valid = sums.get(TRAIN_LOSS, zero), sums.get(VALID_LOSS, zero)
    cells = np.array([sums.get(CELLS - k, zero)[3] for k in range(CLASSES * CLASSES)], float).reshape(CLASSES, CLASSES)
    n, hit = cells.sum(), np.diag(cells)
    both = cells.sum(axis=0) + cells.sum(axis=1)
    f1 = np.divide(2 * hit, both, out=np.zeros(CLASSES), where=both > 0)
    return (train[0] / train[3] if train[3] else None, valid[0] / valid[3] if valid[3] else None,
            float(hit.sum() / n) if n else None, float((cells.sum(axis=1) * f1).sum() / n) if n else None)


@dataclass
class Trained:
    """Weights (``buckets + 1`` rows, the last is the bias) of the ``best`` epoch, and the metrics."""
    weights: np.ndarray
    best: int
    rows: list[tuple]

    def metrics(self, spark: SparkSession) -> DataFrame:
        return spark.createDataFrame(self.rows, METRICS)

    def table(self, spark: SparkSession) -> DataFrame:
        """``bucket, w0, w1, w2`` of the weights that aren't all zero: to write, and to start warm from."""
        hit = np.flatnonzero(self.weights.any(axis=1))
        return spark.createDataFrame(pd.DataFrame({"bucket": hit, **{f"w{c}": self.weights[hit, c] for c in range(CLASSES)}}),
                                     "bucket long, w0 double, w1 double, w2 double")


def weights_of(table: DataFrame, buckets: int = BUCKETS) -> np.ndarray:
    """The weights that :meth:`Trained.table` gave (at most ``buckets + 1`` rows)."""
    w = np.zeros((buckets + 1, CLASSES))
    for r in table.collect():
        w[r.bucket] = r.w0, r.w1, r.w2
    return w


def train(data: DataFrame, epochs: int, rate: float = 2.0, patience: int = 2, decay: float = 0.0,
          buckets: int = BUCKETS, start: np.ndarray | None = None) -> Trained:
    """Train on rows of :func:`features` (hand in a written or checkpointed table: every epoch reads it).

    ``weights -= rate * (gradient / training rows + decay * weights)``; ``start``: weights to go on from.
    """
    w = np.zeros((buckets + 1, CLASSES)) if start is None else start.copy()
    if w.shape != (buckets + 1, CLASSES):
        raise ValueError("start needs buckets + 1 rows of a weight a class")
    rows, best, lowest, kept = [], 0, float("inf"), w
    for epoch in range(epochs + 1):
        sums = one_pass(data, w)
        train_loss, valid_loss, accuracy, f1 = measures(sums)
        rows.append((epoch, train_loss, valid_loss, accuracy, f1))
        if valid_loss is None or valid_loss < lowest:
            best, kept = epoch, w
            lowest = lowest if valid_loss is None else valid_loss
        elif epoch - best >= patience:
            break
        if train_loss is None:
            break
        gradient = np.zeros_like(w)
        for key, (g0, g1, g2, _) in sums.items():
            if key >= 0:
                gradient[key] = g0, g1, g2
        w = w - rate * (gradient / sums[TRAIN_LOSS][3] + decay * w)
    return Trained(kept, best, rows)


def score(df: DataFrame, trained: Trained, text: str) -> DataFrame:
    """``df`` with ``prob_fear, prob_neutral, prob_greed, pred_label`` (null text: the bias alone)."""
    buckets = len(trained.weights) - 1
    shared = df.sparkSession.sparkContext.broadcast(trained.weights)  # buckets + 1 rows

    @F.arrow_udf("struct<p0: double, p1: double, p2: double, best: int>")
    def of(words: pa.Array) -> pa.Array:
        terms = _counts(words, buckets)
        z = np.concatenate([logits(terms.slice(a, SLICE_ROWS), shared.value)[0]
                            for a in range(0, len(terms), SLICE_ROWS)] or [np.zeros((0, CLASSES))])
        p = softmax(z)
        return pa.StructArray.from_arrays([*map(pa.array, p.T.copy()), pa.array(z.argmax(axis=1), pa.int32())],
                                          ["p0", "p1", "p2", "best"])

    d = df.withColumn("_s", of(_words(text)))
    return d.select(*df.columns, F.col("_s.p0").alias("prob_fear"), F.col("_s.p1").alias("prob_neutral"),
                    F.col("_s.p2").alias("prob_greed"), F.col("_s.best").alias("pred_label"))

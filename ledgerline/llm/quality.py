"""Quality classifier: regularised quadratic discriminant over document statistics.

``features`` turns each whole text into transformed statistics. ``fit`` sums
counts, feature sums and outer products per class over *all* labelled rows
(map-side combined; the driver only sees 2 * (1 + d + d*d) numbers), shrinks
both class covariances towards the pooled one and towards a multiple of the
identity, and keeps their Cholesky factors. ``score`` is the logistic of the
difference of the two Gaussian log densities plus log priors; the densities
use Mahalanobis distances by solving with the cached factors.

Defined cases: a null text counts as empty; an empty text has all-zero
statistics and is scored like any other; rows whose doc_id is null are scored
but never trained on, and are not held out; several labels of one document
each count once per distinct value, null labels are ignored; repeated
documents are scored each; without labels of both classes every score is the
share of label 1 (0.5 without any); an empty table gives no rows; other
columns of the input are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from ledgerline.llm.common import (
    lower, materialise, prefix_hashes, read, remainder, shingle_hashes, span_hash, text_chunks, words)

THRESHOLD = 0.3
#: Weights of the pooled covariance and of the identity in each class covariance.
TO_POOLED, TO_IDENTITY = 0.1, 0.02

# Byte classes counted by one table lookup.
_OTHER, _UPPER, _LOW, _DIGIT, _BANG, _SYMBOL, _BAR, _STOP, _LINE, _HIGH = range(10)
_CLASS = np.zeros(256, np.uint8)
_CLASS[65:91], _CLASS[97:123], _CLASS[48:58] = _UPPER, _LOW, _DIGIT
_CLASS[128:] = _HIGH
for _chars, _code in (("!", _BANG), ("#$%&*^~@<>{}[]=_\\", _SYMBOL), ("|", _BAR), (".,;:?", _STOP), ("\n", _LINE)):
    _CLASS[[ord(c) for c in _chars]] = _code
DIMENSIONS = 16


def text_features(data: np.ndarray, offs: np.ndarray) -> np.ndarray:
    """One row of transformed statistics per document of a chunk."""
    n = len(offs) - 1
    size = np.diff(offs)
    rows = np.repeat(np.arange(n), size)
    by_class = np.bincount(rows * 10 + _CLASS[data], minlength=10 * n).reshape(n, 10).astype(float)
    starts, ends, first = words(data, offs)
    count = np.diff(first).astype(float)
    p = prefix_hashes(lower(data))
    w = span_hash(p, starts, ends)
    same = np.zeros(len(w) + 1)
    if len(w) > 1:
        same[2:] = np.cumsum(w[1:] == w[:-1])
    length = np.concatenate([[0], np.cumsum(ends - starts)])
    long_words = np.concatenate([[0], np.cumsum((ends - starts) > 24)])
    repeats, top, kinds, windows = np.zeros(n), np.zeros(n), np.zeros(n), np.zeros(n)
    for i in range(n):
        a, b = first[i], first[i + 1]
        if b > a:
            repeats[i] = same[b] - same[a + 1]
            _, c = np.unique(w[a:b], return_counts=True)
            top[i], kinds[i] = c.max(), len(c)
            s = shingle_hashes(w[a:b], 3)
            windows[i] = 1 - len(np.unique(s)) / len(s)
    per_word, per_byte = np.maximum(count, 1), np.maximum(size, 1)
    letters = np.maximum(by_class[:, _UPPER] + by_class[:, _LOW] + by_class[:, _HIGH] / 2, 1)
    share = lambda x, whole: np.log1p(50 * x / whole)
    return np.column_stack([
        np.log1p(size), np.log1p(count), np.log1p((length[first[1:]] - length[first[:-1]]) / per_word),
        share(by_class[:, _UPPER], letters), share(by_class[:, _BANG], per_word),
        share(by_class[:, _SYMBOL], per_word), share(by_class[:, _BAR], per_word),
        share(by_class[:, _DIGIT], per_byte), share(repeats, per_word),
        np.log1p(kinds) / np.log1p(per_word), share(by_class[:, _STOP], per_word),
        share(by_class[:, _LINE], per_word), share(by_class[:, _HIGH], per_byte), share(top, per_word),
        share(windows, 1), share(long_words[first[1:]] - long_words[first[:-1]], per_word)])


def _batch_features(column: pa.Array) -> np.ndarray:
    parts = [text_features(data, offs) for _, _, data, offs in text_chunks(column)]
    return np.vstack(parts) if parts else np.zeros((0, DIMENSIONS))


def features(docs: DataFrame) -> DataFrame:
    """(doc_id, held_out, x): the statistics of each whole text; one scan, no shuffle."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            x = _batch_features(b.column(2))
            yield pa.RecordBatch.from_arrays(
                [b.column(0), b.column(1), pa.FixedSizeListArray.from_arrays(pa.array(x.ravel()), DIMENSIONS).cast(
                    pa.list_(pa.float64()))], ["doc_id", "held_out", "x"])

    held = F.coalesce(remainder("doc_id", 5) == 0, F.lit(False))
    return docs.select("doc_id", held.alias("held_out"), "text").mapInArrow(
        run, "doc_id bigint, held_out boolean, x array<double>")


@dataclass(frozen=True)
class Model:
    """Centre and scale of the statistics; per class mean, lower Cholesky factor, log determinant and log prior."""

    centre: np.ndarray
    scale: np.ndarray
    classes: tuple[tuple[np.ndarray, np.ndarray, float, float], ...]
    share: float = 0.5

    def score(self, x: np.ndarray) -> np.ndarray:
        if not self.classes:
            return np.full(len(x), self.share)
        z = (x - self.centre) / self.scale
        logs = []
        for mean, factor, log_det, log_prior in self.classes:
            y = np.linalg.solve(factor, (z - mean).T)
            logs.append(log_prior - 0.5 * (log_det + (y * y).sum(axis=0)))
        return 1 / (1 + np.exp(-np.clip(logs[1] - logs[0], -700, 700)))


def _sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    d = DIMENSIONS
    total = np.zeros((2, 1 + d + d * d))
    for b in batches:
        y = b.column(0).to_numpy(zero_copy_only=False)
        x = b.column(1).flatten().to_numpy(zero_copy_only=False).reshape(-1, d)
        for k in (0, 1):
            own = x[y == k]
            total[k] += np.concatenate([[len(own)], own.sum(axis=0), (own.T @ own).ravel()])
    if total[:, 0].any():
        yield pa.RecordBatch.from_arrays([pa.array([0, 1]), pa.array(list(total))], ["y", "s"])


def sums(feats: DataFrame, labels: DataFrame) -> DataFrame:
    """(y, s): count, sums and products of the labelled rows that are not held out; one row per task and class."""
    y = labels.where("quality in (0, 1) and doc_id is not null").select("doc_id", F.col("quality").cast("int").alias("y")).distinct()
    return feats.where("not held_out").join(y, "doc_id").select("y", "x").mapInArrow(_sums, "y bigint, s array<double>")


def fit(feats: DataFrame, labels: DataFrame) -> Model:
    """Fit on every labelled row that is not held out."""
    # Summed again by position before the driver sees it.
    found = sums(feats, labels).select("y", F.posexplode("s").alias("i", "v")).groupBy("y", "i").agg(F.sum("v").alias("v")).collect()
    d = DIMENSIONS
    total = np.zeros((2, 1 + d + d * d))
    for r in found:
        total[r.y, r.i] = r.v
    n = total[:, 0]
    if min(n) < 2:
        return Model(np.zeros(d), np.ones(d), (), float(n[1] / n.sum()) if n.sum() else 0.5)
    centre = total[:, 1:1 + d].sum(axis=0) / n.sum()
    second = total[:, 1 + d:].sum(axis=0).reshape(d, d) / n.sum()
    scale = np.sqrt(np.maximum(np.diag(second) - centre ** 2, 1e-12))
    scale[scale < 1e-5] = 1.0
    means, covs = [], []
    for k in (0, 1):
        m = total[k, 1:1 + d] / n[k]
        c = total[k, 1 + d:].reshape(d, d) / n[k] - np.outer(m, m)
        means.append((m - centre) / scale)
        covs.append(c / np.outer(scale, scale))
    pooled = (n[0] * covs[0] + n[1] * covs[1]) / n.sum()
    classes = []
    for k in (0, 1):
        c = (1 - TO_POOLED) * covs[k] + TO_POOLED * pooled
        c = (1 - TO_IDENTITY) * c + TO_IDENTITY * max(np.trace(pooled) / d, 1e-6) * np.eye(d)
        factor = np.linalg.cholesky(c)
        classes.append((means[k], factor, 2 * float(np.log(np.diag(factor)).sum()), float(np.log(n[k] / n.sum()))))
    return Model(centre, scale, tuple(classes))


def score(feats: DataFrame, model: Model) -> DataFrame:
    """doc_id, held_out, score, predicted of each row of ``features``."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            s = model.score(b.column(2).flatten().to_numpy(zero_copy_only=False).reshape(-1, DIMENSIONS))
            yield pa.RecordBatch.from_arrays(
                [b.column(0), b.column(1), pa.array(s), pa.array((s >= THRESHOLD).astype(np.int32))],
                ["doc_id", "held_out", "score", "predicted"])

    return feats.mapInArrow(run, "doc_id bigint, held_out boolean, score double, predicted int")


def classify(docs: DataFrame, labels: DataFrame) -> DataFrame:
    feats = materialise(features(docs))
    return score(feats, fit(feats, labels))


def keep_good(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The rows of ``docs``, all columns, whose text the fitted model accepts."""
    # A sort-merge join puts a shuffle between the statistics and their sums: with a broadcast join each task holds two
    # Python workers, and an executor keeps all that it ever started.
    model = fit(features(docs).hint("merge"), labels)
    at = docs.columns.index("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            yield b.filter(pa.array(model.score(_batch_features(b.column(at))) >= THRESHOLD))

    return docs.mapInArrow(run, docs.schema)


def op1_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    return classify(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels"))

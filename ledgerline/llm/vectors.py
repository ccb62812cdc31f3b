"""What the vector operators share: which vectors take part, and their principal directions."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F


def usable(column: str = "embedding"):
    """True for vectors that are not null or zero and whose components are all finite."""
    return F.coalesce(F.expr(
        f"size({column}) > 0 and forall({column}, x -> x is not null and not isnan(x) and abs(x) < double('infinity'))"
        f" and exists({column}, x -> x <> 0)"), F.lit(False))


def matrix(column: pa.Array, d: int) -> np.ndarray:
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, d)


def principal(vectors: DataFrame, dims: int) -> dict[int, np.ndarray]:
    """For each vector length d the ``dims`` leading principal directions (d x dims) of the unit vectors.

    From the second moments of all vectors: d * d sums per task, summed again
    by Spark; the driver sees d * d numbers.
    """
    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[int, np.ndarray] = {}
        for b in batches:
            size = b.column(0).to_numpy()
            for d in np.unique(size).tolist():
                x = matrix(b.column(1).filter(pa.array(size == d)), d)
                x = np.column_stack([np.ones(len(x)), x / np.linalg.norm(x, axis=1, keepdims=True)])
                total[d] = total.get(d, 0) + x.T @ x
        yield pa.RecordBatch.from_arrays(
            [pa.array(list(total), pa.int32()), pa.array([t.ravel() for t in total.values()], pa.list_(pa.float64()))], ["d", "s"])

    parts = vectors.select(F.size("embedding").alias("d"), "embedding").mapInArrow(sums, "d int, s array<double>")
    rows = parts.select("d", F.posexplode("s").alias("i", "v")).groupBy("d", "i").agg(F.sum("v").alias("v")).collect()
    out = {}
    for d in {r.d for r in rows}:
        m = np.zeros((d + 1) ** 2)
        for r in rows:
            if r.d == d:
                m[r.i] = r.v
        m = m.reshape(d + 1, d + 1) / m[0]
        _, axes = np.linalg.eigh(m[1:, 1:] - np.outer(m[0, 1:], m[0, 1:]))
        out[d] = np.ascontiguousarray(axes[:, ::-1][:, :dims])
    return out

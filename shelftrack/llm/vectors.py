"""Vectors in tasks: matrices, whole-number products, best rows per query."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def finite(vector: str) -> Column:
    """A vector without null and non-finite components."""
    whole = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return F.col(vector).isNotNull() & whole


def width(vectors: DataFrame, vector: str) -> int:
    return vectors.agg(F.max(F.size(vector))).first()[0] or 0


def matrix(values: pa.Array, dims: int) -> np.ndarray:
    """Rows of a list column; a shorter one ends in zeros, which no product sees."""
    if isinstance(values, pa.ChunkedArray):
        values = values.combine_chunks()
    bounds = values.offsets.to_numpy()
    flat = values.values.to_numpy(zero_copy_only=False)
    sizes = np.diff(bounds)
    if len(sizes) and (sizes == dims).all():
        return flat[bounds[0] : bounds[-1]].reshape(len(sizes), dims)
    out = np.zeros((len(sizes), dims), flat.dtype)
    row = np.repeat(np.arange(len(sizes)), sizes)
    at = np.arange(len(row)) - np.repeat(bounds[:-1] - bounds[0], sizes)
    out[row, at] = flat[bounds[0] : bounds[-1]]
    return out


def packed(rows: np.ndarray) -> pa.Array:
    return pa.array([r.tobytes() for r in rows], pa.binary())


def unpacked(values, dims: int, dtype) -> np.ndarray:
    body = b"".join(values.to_pylist())
    return np.frombuffer(body, dtype).reshape(-1, dims)


def products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Inner products of whole numbers, exact: in doubles while these hold every sum, else in longs."""
    most = float(np.abs(a).max(initial=0)) * float(np.abs(b).max(initial=0)) * a.shape[1]
    if most < 2**53:
        return (a.astype(np.float64) @ b.astype(np.float64).T).astype(np.int64)
    return a.astype(np.int64) @ b.astype(np.int64).T


def best_rows(scores: np.ndarray, k: int, barred: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Row and column of the ``k`` highest scores of each row; of equal ones the earlier column.

    ``barred`` cells take no part.
    """
    n_rows, n = scores.shape
    k = min(k, n)
    order = np.argsort(np.where(barred, np.inf, -scores.astype(np.float64)), axis=1, kind="stable")[:, :k]
    rows = np.repeat(np.arange(n_rows), k)
    columns = order.reshape(-1)
    keep = ~barred[rows, columns]
    return rows[keep], columns[keep]


def ranked(found: DataFrame, k: int, score: str) -> DataFrame:
    """The ``k`` best of each query over all tasks, with their ``rank``."""
    order = Window.partitionBy("query_id").orderBy(F.col(score).desc(), "vec_id")
    return (
        found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
        .select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", score)
    )


def one_per_id(queries: DataFrame, vector: str) -> DataFrame:
    """Query rows that share an id count once, by their smallest vector."""
    return queries.groupBy("vec_id").agg(F.min(vector).alias(vector))

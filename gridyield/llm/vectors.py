"""Vectors of a table as matrices."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def is_vector(vector: str) -> Column:
    """What ``matrix`` takes: not null, all components finite and not null, one of them not zero."""
    finite = F.forall(vector, lambda x: F.coalesce(F.abs(x.cast("double")) < float("inf"), F.lit(False)))  # nan is the largest number
    return F.coalesce(finite & F.exists(vector, lambda x: x != 0), F.lit(False))


def usual_length(vectors: DataFrame, vector: str) -> tuple[int, int]:
    """(dims, n): the most frequent length among all rows with a vector, of equally frequent ones the largest, and its rows.

    (0, 0) for a table without vectors.
    """
    lengths = vectors.where(is_vector(vector)).groupBy(F.size(vector).alias("dims")).agg(F.count(F.lit(1)).alias("n"))
    most = lengths.agg(F.max(F.struct("n", "dims")).alias("most")).first()["most"]
    return (most["dims"], most["n"]) if most else (0, 0)


def sampled(vectors: DataFrame, vector: str, most: int, seed: int) -> tuple[np.ndarray, int]:
    """(values, n): about ``most`` vectors of the usual length, or all if there are fewer, and how many there are."""
    dims, n = usual_length(vectors, vector)
    if not n:
        return np.zeros((0, 0)), 0
    some = vectors.where(is_vector(vector) & (F.size(vector) == dims)).select(vector)
    rows = (some if n <= most else some.sample(fraction=most / n, seed=seed)).toArrow()
    return matrix(rows.column(0).combine_chunks(), dims)[1] if rows.num_rows else np.zeros((0, dims)), n


def matrix(column: pa.Array, dims: int | None = None) -> tuple[np.ndarray, np.ndarray]:
    """(rows, values): values[k] is the vector of row rows[k], in double precision.

    Null vectors, vectors with null or non-finite components, zero vectors, empty ones and, with ``dims``, those of
    another length are left out. Without ``dims`` the vectors must have one length.
    """
    column = column.cast(pa.list_(pa.float64()))
    sizes = column.value_lengths().to_numpy(zero_copy_only=False)
    sizes = np.where(np.isnan(sizes.astype(np.float64)), 0, sizes).astype(np.int64)
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)  # null components become nan
    starts = np.concatenate([[0], np.cumsum(sizes)])[:-1]
    dims = dims or int(sizes.max(initial=0))
    rows = np.flatnonzero(sizes == dims) if dims else np.zeros(0, np.int64)
    values = flat[starts[rows][:, None] + np.arange(dims)] if len(rows) else np.zeros((0, dims))
    good = np.isfinite(values).all(1) & (values != 0).any(1) if len(rows) else np.zeros(0, bool)
    return rows[good], values[good]

"""Vector columns: which take part, and how they travel."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def is_usable(vector: Column) -> Column:
    """Neither null nor empty nor zero, without null or non-finite components."""
    whole = vector.cast("array<double>")
    odd = F.exists(whole, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    some = F.exists(whole, lambda x: x != 0)
    return F.coalesce(vector.isNotNull() & ~odd & some, F.lit(False))


def usable(rows: DataFrame, row_id: str, vector: str) -> tuple[DataFrame, int]:
    """(id, vector) of the rows that take part, and their dimension (0 without any).

    Rows without an id take no part, nor vectors of another length than most have (the shorter
    one of two equally frequent ones).
    """
    fine = rows.where(F.col(row_id).isNotNull() & is_usable(F.col(vector)))
    sizes = fine.groupBy(F.size(vector).alias("d")).agg(F.count(F.lit(1)).alias("n"))
    most = sizes.orderBy(F.desc("n"), "d").limit(1).collect()
    size = most[0].d if most else 0
    kept = fine.where(F.size(vector) == size)
    return kept.select(F.col(row_id).cast("bigint").alias("id"), F.col(vector).cast("array<double>").alias("vector")), size


def matrix(column: pa.ChunkedArray | pa.Array, size: int) -> np.ndarray:
    """A list column as a matrix of doubles."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.float64, copy=False).reshape(-1, size)


def sample(rows: DataFrame, size: int, limit: int) -> np.ndarray:
    """At most ``limit`` vectors, the least by a hash of the id: the same in every run."""
    chosen = rows.orderBy(F.xxhash64("id"), "id").limit(limit).select("vector").collect()
    return np.array([r.vector for r in chosen], dtype=np.float64).reshape(-1, size)

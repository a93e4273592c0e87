"""Vectors of a table of embeddings that can be computed with."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from weftline.scratch import materialize


def finite(vector: Column) -> Column:
    """Whether a vector is there, has entries, and all of them are finite numbers."""
    bad = F.exists(vector, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return vector.isNotNull() & (F.size(vector) > 0) & ~F.coalesce(bad, F.lit(True))


def usable(table: DataFrame, id_column: str = "vec_id", vector: str = "embedding", also: Column | None = None) -> tuple[DataFrame, int]:
    """(vec_id, v as doubles) of the finite vectors of the length that most have, the longest of equally frequent ones, and that length; 0 without any. Written once."""
    doubles = F.col(vector).cast("array<double>")
    rows = table.select(F.col(id_column).cast("long").alias("vec_id"), doubles.alias("v")).where(finite(F.col("v")))
    rows = materialize(rows if also is None else rows.where(also), "vectors")
    most = rows.groupBy(F.size("v").alias("dims")).agg(F.count("*").alias("n")).agg(F.max(F.struct("n", "dims")).alias("m")).first().m
    dims = most.dims if most else 0
    return rows.where(F.size("v") == dims), dims


def matrix(column, dims: int):
    """An Arrow column of lists of dims doubles without nulls as a matrix."""
    import numpy as np

    values = column.flatten() if len(column) else []
    return np.asarray(values, dtype=np.float64).reshape(len(column), dims)

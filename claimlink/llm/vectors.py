"""Vectors of whole numbers, shared by the operators on embeddings."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def usable(vector: Column) -> Column:
    """A vector that is there and holds finite numbers only."""
    value = lambda x: x.cast("double")
    finite = F.forall(
        vector,
        lambda x: x.isNotNull() & ~F.isnan(value(x)) & (F.abs(value(x)) < F.lit(float("inf"))),
    )
    return vector.isNotNull() & finite


def quantised(vector: Column, scale: int = 256) -> Column:
    """Every component as floor(scale * x), a long; there is no negative zero."""
    return F.transform(vector, lambda x: F.floor(F.lit(float(scale)) * x.cast("double")) + F.lit(0))


def matrix(column: pa.Array) -> np.ndarray:
    """Lists of equal length as the rows of a matrix."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    values = column.flatten().to_numpy(zero_copy_only=False)
    return values.reshape(len(column), -1) if len(column) else values.reshape(0, 0)


def as_lists(values: np.ndarray) -> pa.Array:
    """The rows of a matrix as lists."""
    offsets = np.arange(len(values) + 1, dtype=np.int32) * values.shape[1]
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(values.reshape(-1)))


def most_common_length(df: DataFrame, name: str = "x") -> int:
    """The length that most vectors have (ties: the longest); 0 without a vector."""
    counts = df.groupBy(F.size(name).alias("length")).agg(F.count(F.lit(1)).alias("n"))
    first = counts.orderBy(F.desc("n"), F.desc("length")).first()
    return first["length"] if first else 0

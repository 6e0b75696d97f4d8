"""Vectors of doubles as vectors of whole numbers."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

EXACT = float(1 << 52)  # whole numbers below are exact as doubles


def whole(df: DataFrame, vector_col: str, scale: int, offset: int = 0, name: str = "x") -> DataFrame:
    """Rows whose vector is whole, with floor(scale * entry) + offset of each entry as an array of long.

    A vector that is null, empty or holds a null, a NaN, an infinity or an entry that scaled reaches 2**52 takes no
    part. The other columns stay.
    """
    v = F.transform(F.col(f"`{vector_col}`"), lambda c: c.cast("double"))
    fits: Column = F.forall(v, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c * scale) < EXACT))
    kept = df.filter(F.col(f"`{vector_col}`").isNotNull() & (F.size(v) > 0) & F.coalesce(fits, F.lit(False)))
    return kept.withColumn(name, F.transform(v, lambda c: F.floor(c * scale) + F.lit(offset).cast("long")))


def commonest_length(df: DataFrame, name: str = "x") -> tuple[int, int]:
    """(length, rows) of the length most vectors have, the greater of equals; (0, 0) without vectors."""
    sizes = df.groupBy(F.size(name).alias("d")).agg(F.count(F.lit(1)).alias("n"))
    top = sizes.orderBy(F.desc("n"), F.desc("d")).first()
    return (top["d"], top["n"]) if top else (0, 0)


def matrix(column: pa.Array) -> np.ndarray:
    """Rows of equal length from a column of arrays without nulls."""
    if not len(column):
        return np.zeros((0, 0), np.int64)
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1)

"""What the operators on embedding vectors share: which rows count, and their components as integers.

A vector counts if it and its components are neither null, NaN nor infinite, and if it has the
length that most of them have (of equally frequent lengths the smallest). Empty vectors never
count. Components are scaled by a power of two and rounded down, which is exact in doubles;
what is beyond `LIMIT` after scaling becomes `LIMIT`, so that all sums fit decimals of 38 digits.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

LIMIT = 1 << 40


def finite(vector: str) -> Column:
    known = lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf"))
    return F.coalesce((F.size(vector) > 0) & F.forall(vector, known), F.lit(False))


def usable(rows: DataFrame, vector: str = "embedding") -> tuple[DataFrame, int]:
    """The rows whose vector counts, and the length of the vectors (0 if there are none)."""
    kept = rows.where(finite(vector))
    lengths = kept.groupBy(F.size(vector).alias("length")).agg(F.count("*").alias("n"))
    most = lengths.orderBy(F.desc("n"), "length").limit(1).collect()
    length = most[0]["length"] if most else 0
    return kept.where(F.size(vector) == length), length


def scaled(column: pa.Array, length: int, times: int) -> np.ndarray:
    """An Arrow column of vectors as a matrix of floor(times * x)."""
    values = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, length)
    return np.clip(np.floor(values * times), -LIMIT, LIMIT).astype(np.int64)


def exact(values: np.ndarray, largest: int) -> np.ndarray:
    """values as they are if numbers up to `largest` fit 64 bits, else as Python integers."""
    return values if largest < 1 << 63 else values.astype(object)

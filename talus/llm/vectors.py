"""Whole-number vectors from embedding columns, and their matrices in tasks."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F

#: What a component is multiplied by before it is floored.
SCALE = 256


def usable(vector: Column) -> Column:
    """Whether a vector is there and all its entries are finite numbers; an empty one is usable."""

    def finite(c: Column) -> Column:
        c = c.cast("double")
        return F.coalesce(~F.isnan(c) & (F.abs(c) < float("inf")), F.lit(False))

    return vector.isNotNull() & F.coalesce(F.forall(vector, finite), F.lit(False))


def whole(vector: Column, size: int | Column, scale: int = SCALE) -> Column:
    """``floor(scale * entry)`` as longs; what a long can't hold counts as its end.

    Vectors shorter than ``size`` are as if followed by zeros.
    """
    x = F.transform(vector, lambda c: F.floor(c.cast("double") * float(scale)).cast("long"))
    return F.when(F.size(x) < size, F.concat(x, F.array_repeat(F.lit(0).cast("long"), size - F.size(x)))).otherwise(x)


def matrix(column: pa.Array, size: int) -> np.ndarray:
    """The rows of a column of equally long lists."""
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), size)


def exact(x: np.ndarray, most: int) -> np.ndarray:
    """``x`` as it is where magnitudes up to ``most`` fit into 64 bits, else as Python's unbounded integers."""
    return x if most < 1 << 62 else x.astype(object)


def largest(x: np.ndarray) -> int:
    """The largest magnitude of a matrix."""
    return max(abs(int(x.min())), abs(int(x.max()))) if x.size else 0

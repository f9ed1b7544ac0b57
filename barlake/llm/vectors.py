"""Vectors of an array column as integer matrices."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F


def finite(vector: Column, size: int | None = None) -> Column:
    """True where the array is there, has ``size`` components (any number if None), and
    none of them is null or non-finite."""
    inf = F.lit(float("inf"))
    ok = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < inf))
    if size is not None:
        ok = (F.size(vector) == size) & ok
    return F.coalesce(ok, F.lit(False))


def scaled(column: pa.Array, scale: int, limit: int) -> tuple[np.ndarray, np.ndarray]:
    """floor(scale * x) of all components of a list<double> column without nulls, as int64,
    and the lists' lengths.  A component beyond ``limit`` is an error: later sums of
    products would no longer fit into 64 bits."""
    lengths = np.diff(column.offsets.to_numpy()).astype(np.int64)
    x = np.floor(column.flatten().to_numpy(zero_copy_only=False).astype(np.float64) * scale)
    if x.size and np.abs(x).max() > limit:
        raise ValueError(f"a component beyond {limit / scale:g} has no exact 64-bit result")
    return x.astype(np.int64), lengths


def matrix(column: pa.Array, scale: int, limit: int) -> np.ndarray:
    """The rows as one matrix; shorter vectors are filled up with zeros."""
    flat, lengths = scaled(column, scale, limit)
    wide = int(lengths.max()) if len(lengths) else 0
    out = np.zeros((len(lengths), wide), np.int64)
    out[np.arange(wide) < lengths[:, None]] = flat
    return out


def narrow(a: np.ndarray) -> np.ndarray:
    """The same integers in the smallest signed type that holds them."""
    low, high = (int(a.min()), int(a.max())) if a.size else (0, 0)
    kind = next(k for k in ("i1", "i2", "i4", "i8") if np.iinfo(k).min <= low and high <= np.iinfo(k).max)
    return a.astype(f"<{kind}")

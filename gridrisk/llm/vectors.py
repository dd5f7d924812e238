"""Vector columns as numpy matrices, shared by the operators on embeddings. Works on one Arrow record batch inside a task."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Integers up to here are exact as doubles, so products of such size go through a floating-point matrix product.
EXACT = 1 << 53


def usable(vector: str) -> Column:
    """Neither null nor with a null or non-finite component (an empty vector is usable)."""
    return F.coalesce(F.forall(F.col(vector).cast("array<double>"), lambda x: F.coalesce(F.abs(x) < float("inf"), F.lit(False))), F.lit(False))


def numbers(df: DataFrame, vector: str) -> Column:
    """The vector as it is if its components are floats or doubles, else as doubles."""
    kind = df.schema[vector].dataType.simpleString()
    return F.col(vector) if kind in ("array<float>", "array<double>") else F.col(vector).cast("array<double>")


def width_of(df: DataFrame, vector: str) -> int:
    """Components of the longest vector."""
    return df.agg(F.max(F.size(vector))).first()[0] or 0


def matrix(col: pa.Array, width: int) -> np.ndarray:
    """Rows of doubles; shorter vectors get zeros, components past the width are left out."""
    size = np.asarray(col.value_lengths().fill_null(0)).astype(np.int64)
    out = np.zeros((len(col), width))
    row = np.repeat(np.arange(len(col)), size)
    at = np.arange(len(row)) - np.repeat(np.cumsum(size) - size, size)
    inside = at < width
    out[row[inside], at[inside]] = np.asarray(col.flatten().cast(pa.float64()))[inside]
    return out


def scaled(x: np.ndarray, scale: int) -> np.ndarray:
    """floor(scale * x), as doubles that hold whole numbers."""
    return np.floor(x * float(scale))


def products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Exact inner products (int64) of the rows of two matrices of whole numbers."""
    most = float(np.abs(a).max(initial=0)) * float(np.abs(b).max(initial=0)) * max(1, a.shape[1])
    if most < EXACT:
        return (a @ b.T).astype(np.int64)
    if most >= 1 << 60:
        raise ValueError("components are too large for scores of 64 bits")
    return a.astype(np.int64) @ b.astype(np.int64).T

"""Embedding rows as arrays."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def usable(vector: Column) -> Column:
    """True where a vector takes part: not null, not empty, no null or non-finite component, not all zero."""
    bad = F.exists(vector, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return F.coalesce((F.size(vector) > 0) & ~bad & F.exists(vector, lambda x: x != 0), F.lit(False))


def numbers(rows: DataFrame, vector: str) -> Column:
    """The vector column as it is if single precision, else in double precision."""
    single = rows.schema[vector].dataType.simpleString() == "array<float>"
    return F.col(vector) if single else F.col(vector).cast("array<double>")


def prevailing_size(rows: DataFrame, vector: str) -> int:
    """The commonest length of the vectors (ties: the smallest); others have no product with most rows."""
    best = rows.groupBy(F.size(vector).alias("d")).count().orderBy(F.desc("count"), "d").first()
    return best["d"] if best else 0


def matrix(column: pa.ChunkedArray | pa.Array) -> np.ndarray:
    """Rows of a list column of one length, in double precision."""
    values = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    if isinstance(values, pa.ChunkedArray):
        values = values.chunk(0) if values.num_chunks else pa.array([], column.type)
    flat = values.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    return flat.reshape(len(values), -1) if len(values) else flat.reshape(0, 0)


def scaled(x: np.ndarray) -> np.ndarray:
    """Each row by a power of two, so that squares neither overflow nor vanish; cosines stay the same."""
    return np.ldexp(x, -np.frexp(np.abs(x).max(axis=1, initial=0.0))[1][:, None])


def units(x: np.ndarray) -> np.ndarray:
    x = scaled(x)
    return x / np.linalg.norm(x, axis=1)[:, None]

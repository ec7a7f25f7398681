"""Vectors in list columns as numpy matrices."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def finite(column: str) -> Column:
    """Whether a vector is there and holds neither nulls nor non-finite components."""
    return F.coalesce(F.forall(column, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))), F.lit(False))


def packed(vectors: DataFrame, keep: list[str], column: str) -> DataFrame:
    """``row``, a struct of the columns ``keep``, and ``vec``, the vector in single or double precision."""
    single = vectors.schema[column].dataType.elementType.typeName() == "float"
    vec = vectors[column] if single else vectors[column].cast("array<double>")
    return vectors.select(F.struct(*[vectors[c].alias(c) for c in keep]).alias("row"), vec.alias("vec"))


def lengths(lists: pa.Array) -> np.ndarray:
    return np.asarray(lists.value_lengths().to_numpy(zero_copy_only=False))


def matrix(lists: pa.Array, dims: int) -> tuple[np.ndarray, np.ndarray]:
    """Vectors of the length ``dims`` as rows in double precision, and which rows of the column those are."""
    right = np.flatnonzero(lengths(lists) == dims)
    flat = lists.take(pa.array(right)).flatten().to_numpy(zero_copy_only=False)
    return flat.reshape(-1, dims).astype(np.float64), right

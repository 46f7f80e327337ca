"""What the embedding operators share: usable vectors, digests, unit length."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, FloatType


def usable(vector: Column) -> Column:
    """Whether a vector is not null or empty, has only finite components, and is not zero."""
    finite = F.forall(
        vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf")))
    )
    return F.coalesce(
        vector.isNotNull() & (F.size(vector) > 0) & finite & F.exists(vector, lambda x: x != 0), F.lit(False)
    )


def with_digest(df: DataFrame, vector: str) -> DataFrame:
    """Rows with ``vector`` as doubles (null if unusable) and ``digest``, equal for equal vectors."""
    doubles = F.col(f"`{vector}`").cast("array<double>")
    vector_or_null = F.when(usable(doubles), doubles)
    return df.withColumn("vector", vector_or_null).withColumn(
        "digest", F.unhex(F.md5(F.col("vector").cast("string")))
    )


def element(df: DataFrame, vector: str) -> str:
    """The numpy type in which components are packed: four bytes where the column has no more, else eight."""
    kind = df.schema[vector].dataType
    return "<f4" if isinstance(kind, ArrayType) and isinstance(kind.elementType, FloatType) else "<f8"


def with_packed(df: DataFrame, vector: str, kind: str) -> DataFrame:
    """Rows with ``vector`` as the bytes of its components (null if unusable) and ``digest``, equal for equal vectors."""

    @F.arrow_udf("binary")
    def packed(vectors: pa.Array) -> pa.Array:
        lengths = vectors.value_lengths().fill_null(0).to_numpy().astype(np.int64)
        flat = vectors.flatten().to_numpy(zero_copy_only=False).astype(kind)
        ends = np.cumsum(lengths)
        starts = ends - lengths

        def within(marks: np.ndarray) -> np.ndarray:
            upto = np.concatenate([[0], np.cumsum(marks)])
            return upto[ends] - upto[starts]

        good = (within(~np.isfinite(flat)) == 0) & (within(flat != 0) > 0)
        raw, width = flat.tobytes(), flat.itemsize
        cut = zip(good.tolist(), (starts * width).tolist(), (ends * width).tolist(), strict=True)
        return pa.array([raw[a:b] if on else None for on, a, b in cut], pa.binary())

    given = F.col(f"`{vector}`").cast("array<float>" if kind == "<f4" else "array<double>")
    return df.withColumn("vector", packed(given)).withColumn("digest", F.unhex(F.md5("vector")))


def units_of(raw: bytes, size: int, kind: str) -> np.ndarray:
    """Packed vectors of one dimension as rows of unit length, in doubles."""
    return _units(np.frombuffer(raw, kind).astype(np.float64).reshape(-1, size))


def matrix(column: pa.Array, size: int) -> np.ndarray:
    """The vectors of one dimension as rows of unit length."""
    return _units(column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, size))


def _units(values: np.ndarray) -> np.ndarray:
    if not len(values):
        return values
    values = values / np.abs(values).max(axis=1, keepdims=True)
    return values / np.sqrt((values * values).sum(axis=1, keepdims=True))

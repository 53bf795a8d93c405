"""Embedding columns as numpy matrices."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def usable(embedding):
    """No null, no null or non-finite component."""
    x = embedding.cast("array<double>")
    return embedding.isNotNull() & F.forall(
        x, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < F.lit(float("inf")))
    )


def usable_rows(table: DataFrame) -> DataFrame:
    """vec_id, embedding, a, b of the rows that have an id and a usable vector; a and b name the
    vector (two 64-bit hashes)."""
    rows = table.select(
        F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast("array<double>").alias("embedding")
    ).where(F.col("vec_id").isNotNull() & F.coalesce(usable(F.col("embedding")), F.lit(False)))
    # adding 0 makes one zero of the two, so equal vectors have equal names
    vector = F.transform("embedding", lambda v: v + F.lit(0.0))
    return rows.withColumn("embedding", vector).withColumns(
        {"a": F.xxhash64("embedding"), "b": F.xxhash64(F.lit(7), "embedding", F.lit(11))}
    )


def matrix(column: pa.Array, width: int) -> np.ndarray:
    """Rows of a list column, shorter ones filled up with zeros."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    offsets = np.asarray(column.offsets)
    values = np.asarray(column.values, dtype=np.float64)[offsets[0] : offsets[-1]]
    sizes = np.diff(offsets)
    if len(sizes) and (sizes == width).all():
        return values.reshape(-1, width)
    out = np.zeros((len(sizes), width))
    row = np.repeat(np.arange(len(sizes)), sizes)
    out[row, np.arange(len(values)) - np.repeat(offsets[:-1] - offsets[0], sizes)] = values
    return out


def unpacked(column: pa.Array, width: int, kind: str = "<f8") -> np.ndarray:
    """Rows of a binary column written by packed()."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    raw = b"".join(column.to_pylist())
    return np.frombuffer(raw, kind).reshape(-1, width)


def packed(rows: np.ndarray, kind: str = "<f8") -> pa.Array:
    return pa.array([r.astype(kind).tobytes() for r in rows], pa.binary())

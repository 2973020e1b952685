"""Embedding columns as packed double vectors."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F


def pack_vectors(column: pa.Array) -> list[bytes | None]:
    """The components of each vector as little-endian doubles.

    None for a vector that is null, empty, zero, or holds a null or a component
    that is not finite.
    """
    lengths = np.diff(column.offsets.to_numpy()) if len(column) else np.zeros(0, int)
    flat = column.flatten()
    if len(column) and not column.null_count and not flat.null_count and (lengths == lengths[0]).all() and lengths[0]:
        matrix = flat.to_numpy(zero_copy_only=False).astype("<f8").reshape(len(column), -1)
        good = np.isfinite(matrix).all(1) & (matrix != 0).any(1)
        return [row.tobytes() if ok else None for row, ok in zip(matrix, good)]
    packed = []
    for vector in column.to_pylist():
        row = None if not vector or None in vector else np.array(vector, "<f8")
        packed.append(row.tobytes() if row is not None and np.isfinite(row).all() and row.any() else None)
    return packed


def packed(table: DataFrame) -> DataFrame:
    """vec_id and embedding of ``table`` -> (vec_id long, vec binary or null)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            column = batch.column(1)
            column = column.cast(pa.list_(column.type.value_type)) if not pa.types.is_list(column.type) else column
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(pack_vectors(column), pa.binary())], ["vec_id", "vec"]
            )

    columns = table.select(F.col("vec_id").cast("long").alias("vec_id"), "embedding")
    return columns.mapInArrow(run, "vec_id long, vec binary")


def unpack(column: pa.Array | list[bytes]) -> np.ndarray:
    """Packed vectors of one length as a matrix."""
    values = column.to_pylist() if isinstance(column, (pa.Array, pa.ChunkedArray)) else column
    return np.frombuffer(b"".join(values), "<f8").reshape(len(values), -1)


def unit(matrix: np.ndarray) -> np.ndarray:
    # Scaled by the largest component first: squares of huge or tiny components would leave the range of doubles.
    matrix = matrix / np.abs(matrix).max(1, keepdims=True)
    return matrix / np.sqrt((matrix * matrix).sum(1, keepdims=True))

"""Vectors in Arrow columns as numpy matrices."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc


def finite_vectors(column: pa.Array, dim: int | None = None) -> dict[int, tuple[np.ndarray, np.ndarray]]:
    """By number of components: the rows whose vector has no null or non-finite one, and these vectors as doubles.

    dim: take vectors of this many components only. Null and empty vectors are in none.
    """
    lengths = pc.fill_null(pc.list_value_length(column), 0).to_numpy(zero_copy_only=False)
    out = {}
    for n in [dim] if dim else np.unique(lengths[lengths > 0]).tolist():
        rows = np.nonzero(lengths == n)[0]
        flat = column.take(pa.array(rows)).flatten().cast(pa.float64())
        matrix = flat.to_numpy(zero_copy_only=False).reshape(-1, n)
        fine = np.isfinite(matrix).all(axis=1)
        if fine.any():
            out[n] = rows[fine], matrix[fine]
    return out


def binary_column(matrix: np.ndarray) -> pa.Array:
    """Rows of a matrix as binary values."""
    matrix = np.ascontiguousarray(matrix)
    width = matrix.shape[1] * matrix.itemsize
    return pa.FixedSizeBinaryArray.from_buffers(pa.binary(width), len(matrix), [None, pa.py_buffer(matrix)]).cast(pa.binary())


def matrix_of(column: pa.Array, dtype: str, width: int) -> np.ndarray:
    """Binary values of ``width`` numbers each as a matrix; a view on the column where it has no gaps."""
    ends = np.frombuffer(column.buffers()[1], np.int32)[column.offset : column.offset + len(column) + 1]
    data = np.frombuffer(column.buffers()[2] or b"", np.uint8)[ends[0] : ends[-1]] if len(column) else np.empty(0, np.uint8)
    return data.view(dtype).reshape(-1, width)

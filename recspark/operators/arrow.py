"""Between Arrow list columns and numpy matrices, without a Python loop over rows."""

from __future__ import annotations

import numpy as np
import pyarrow as pa


def to_matrix(column: pa.Array, size: int) -> np.ndarray:
    """``(rows, size)`` float64 matrix of a list column."""
    flat = column.flatten().to_numpy(zero_copy_only=False)
    if len(flat) != len(column) * size:
        raise ValueError(f"every vector must have {size} components")
    return flat.astype(np.float64, copy=False).reshape(len(column), size)


def to_list_column(matrix: np.ndarray, value_type: pa.DataType) -> pa.Array:
    rows, size = matrix.shape
    offsets = np.arange(0, (rows + 1) * size, size, dtype=np.int32)
    values = pa.array(np.ascontiguousarray(matrix).reshape(-1)).cast(value_type)
    return pa.ListArray.from_arrays(pa.array(offsets), values)

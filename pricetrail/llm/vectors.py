"""Integer vectors: which rows count, their components, and their packed form."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F

#: Components are floor(SCALE * x); beyond LIMIT (x of 16,384) they saturate, so that
#: sums of squares stay exact in 64 bits.
SCALE = 1024
LIMIT = 1 << 24


def usable(vector: Column) -> Column:
    """True for a vector that is there and holds neither null nor a non-finite number."""
    bad = F.exists(vector, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return F.coalesce(vector.isNotNull() & ~bad, F.lit(False))


def components(vector: Column) -> Column:
    """The integers of a usable vector."""
    def one(x: Column) -> Column:
        x = F.greatest(F.lit(-float(LIMIT)), F.least(F.lit(float(LIMIT)), F.lit(float(SCALE)) * x.cast("double")))
        return F.floor(x).cast("int")

    return F.transform(vector, one)


def as_matrix(column: pa.Array, width: int) -> np.ndarray:
    """An Arrow column of int lists as rows of ``width`` integers, shorter ones filled with zeros."""
    lengths = column.value_lengths().to_numpy(zero_copy_only=False)
    values = column.flatten().to_numpy(zero_copy_only=False)
    if (lengths == width).all():
        return values.reshape(-1, width).astype(np.int32)
    out = np.zeros((len(lengths), width), np.int32)
    out[np.arange(width)[None, :] < lengths[:, None]] = values
    return out


def pack(matrix: np.ndarray) -> pa.Array:
    """Rows of a matrix as one binary value each."""
    width = matrix.shape[1] * matrix.dtype.itemsize
    raw = np.ascontiguousarray(matrix).astype(matrix.dtype.newbyteorder("<"), copy=False)
    fixed = pa.Array.from_buffers(pa.binary(max(width, 1)), len(matrix), [None, pa.py_buffer(raw.tobytes())])
    return fixed.cast(pa.binary())


def unpack(column: pa.Array, dtype: str, width: int) -> np.ndarray:
    """The matrix of packed rows, without a copy per row."""
    n = len(column)
    if not n:
        return np.zeros((0, width), dtype)
    column = column.cast(pa.binary())
    offsets = np.frombuffer(column.buffers()[1], np.int32)[column.offset:column.offset + n + 1]
    data = np.frombuffer(column.buffers()[2], dtype, count=n * width, offset=int(offsets[0]))
    return data.reshape(n, width)

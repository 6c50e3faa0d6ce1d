"""Vector columns: Arrow views for the kernels and a compact binary form for storage."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

_FLOAT_BYTES = 4


def to_matrix(vectors: pa.Array, dtype=np.float64) -> np.ndarray:
    """Rows of an Arrow list array as a matrix; every row must have one length."""
    if isinstance(vectors, pa.ChunkedArray):
        vectors = vectors.combine_chunks()
    if len(vectors) == 0:
        return np.zeros((0, 0), dtype)
    if vectors.null_count:
        raise ValueError("a vector is null; drop such rows before the search")
    span = pc.min_max(pc.list_value_length(vectors)).as_py()
    if span["min"] != span["max"]:
        raise ValueError(f"vectors differ in length: {span['min']} and {span['max']}")
    flat = vectors.flatten().to_numpy(zero_copy_only=False)
    return flat.reshape(len(vectors), span["max"]).astype(dtype, copy=False)


def to_lists(matrix: np.ndarray, kind: pa.DataType) -> pa.Array:
    rows, width = matrix.shape
    offsets = pa.array(np.arange(0, rows * width + 1, width or 1)[: rows + 1], pa.int32())
    return pa.ListArray.from_arrays(offsets, pa.array(matrix.ravel(), kind))


@F.arrow_udf(T.BinaryType())
def _pack(vectors: pa.Array) -> pa.Array:
    lengths = pc.fill_null(pc.list_value_length(vectors), 0).to_numpy(zero_copy_only=False)
    offsets = np.concatenate([[0], np.cumsum(lengths * _FLOAT_BYTES)]).astype(np.int32)
    data = vectors.flatten().to_numpy(zero_copy_only=False).astype("<f4", copy=False)
    valid = vectors.is_valid().to_numpy(zero_copy_only=False)
    bits = pa.py_buffer(np.packbits(valid, bitorder="little"))
    buffers = [bits, pa.py_buffer(offsets), pa.py_buffer(np.ascontiguousarray(data))]
    return pa.Array.from_buffers(pa.binary(), len(vectors), buffers)


@F.arrow_udf(T.ArrayType(T.FloatType()))
def _unpack(packed: pa.Array) -> pa.Array:
    lengths = pc.fill_null(pc.binary_length(packed), 0).to_numpy(zero_copy_only=False)
    offsets = np.concatenate([[0], np.cumsum(lengths // _FLOAT_BYTES)]).astype(np.int32)
    values = np.frombuffer(b"".join(packed.drop_null().to_pylist()), "<f4")
    mask = packed.is_null() if packed.null_count else None
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(values, pa.float32()), mask=mask)


def pack_vector(vector: Column | str) -> Column:
    """``array<float>`` as little-endian 4-byte floats: what the encrypted tables hold."""
    return _pack(F.col(vector) if isinstance(vector, str) else vector)


def unpack_vector(packed: Column | str) -> Column:
    return _unpack(F.col(packed) if isinstance(packed, str) else packed)

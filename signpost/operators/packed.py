"""Vectors as byte strings, for what goes through shuffles, broadcasts and scratch tables.

Single precision, bit by bit: which components are there (not all bits zero), and the number of each
one's value in the list of a vector's different values. Vectors that this does not shorten are kept
as they are. Counts of trigrams, scaled or not, take about a tenth.
"""

from __future__ import annotations

import struct

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column
from pyspark.sql import functions as F

from signpost.functions.text import _c

_HEAD = struct.Struct("<IB")
# In place of the number of different values: the vector stands as it is.
_PLAIN = 255


def _packed(bits: np.ndarray) -> bytes:
    there = bits != 0
    values, which = np.unique(bits[there], return_inverse=True)
    if len(values) < _PLAIN and len(there) // 8 + 1 + 4 * len(values) + len(which) < 4 * len(bits):
        parts = np.packbits(there), values, which.astype(np.uint8)
        return _HEAD.pack(len(bits), len(values)) + b"".join(p.tobytes() for p in parts)
    return _HEAD.pack(len(bits), _PLAIN) + bits.tobytes()


def _unpacked(packed: bytes) -> np.ndarray:
    size, count = _HEAD.unpack_from(packed)
    at = _HEAD.size
    if count == _PLAIN:
        return np.frombuffer(packed, "<u4", size, at)
    mask = np.frombuffer(packed, np.uint8, (size + 7) // 8, at)
    at += len(mask)
    values = np.frombuffer(packed, "<u4", count, at)
    which = np.frombuffer(packed, np.uint8, offset=at + 4 * count)
    bits = np.zeros(size, "<u4")
    bits[np.unpackbits(mask, count=size).view(bool)] = values[which]
    return bits


def pack(vectors: pa.Array) -> pa.Array:
    """An Arrow list column as binary; null for null."""
    lengths = pc.fill_null(pc.list_value_length(vectors), 0).to_numpy(zero_copy_only=False)
    flat = vectors.flatten().to_numpy(zero_copy_only=False).astype("<f4").view("<u4")
    ends = np.cumsum(lengths)
    known = vectors.is_valid().to_pylist()
    rows = [_packed(flat[e - n : e]) if there else None for e, n, there in zip(ends, lengths, known)]
    return pa.array(rows, pa.binary())


def unpack(packed: pa.Array) -> pa.Array:
    """The vectors of a packed column as an Arrow list column."""
    rows = [None if x is None else _unpacked(x) for x in packed.to_pylist()]
    lengths = np.array([0 if r is None else len(r) for r in rows], np.int64)
    flat = np.concatenate([r for r in rows if r is not None] or [np.empty(0, "<u4")])
    offsets = np.concatenate([[0], np.cumsum(lengths)]).astype(np.int32)
    mask = pa.array([r is None for r in rows], pa.bool_())
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat.view("<f4")), mask=mask)


def pack_column(vector: Column | str) -> Column:
    @F.arrow_udf("binary")
    def packed(vectors: pa.Array) -> pa.Array:
        return pack(vectors)

    return packed(_c(vector))

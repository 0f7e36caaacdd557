"""Number arrays as compact binary cells: byte planes, compressed. Sorted keys go as differences."""

from __future__ import annotations

import numpy as np
import pyarrow as pa

_CODEC = pa.Codec("zstd", 3)


def pack(x: np.ndarray) -> bytes:
    """The array's bytes, plane by plane (all lowest bytes first), after its length in 8 bytes."""
    x = np.ascontiguousarray(x)
    planes = x.view(np.uint8).reshape(len(x), x.itemsize).T.tobytes() if len(x) else b""
    return len(x).to_bytes(8, "little") + (_CODEC.compress(planes, asbytes=True) if planes else b"")


def unpack(cell: bytes, dtype) -> np.ndarray:
    dtype, n = np.dtype(dtype), int.from_bytes(cell[:8], "little")
    if n == 0:
        return np.zeros(0, dtype)
    planes = _CODEC.decompress(cell[8:], n * dtype.itemsize, asbytes=True)
    raw = np.frombuffer(planes, np.uint8).reshape(dtype.itemsize, n)
    return np.ascontiguousarray(raw.T).reshape(-1).view(dtype)


def pack_keys(keys: np.ndarray) -> bytes:
    """Ascending 64-bit keys."""
    return pack(np.diff(keys, prepend=np.uint64(0)))


def unpack_keys(cell: bytes) -> np.ndarray:
    return np.cumsum(unpack(cell, np.uint64), dtype=np.uint64)

"""Whole-number arrays as short byte strings."""

from __future__ import annotations

import numpy as np
import pyarrow as pa


def pack(values: np.ndarray, ascending: bool = False) -> bytes:
    """Byte planes of the values, or of their steps if they ascend, compressed."""
    values = np.ascontiguousarray(values)
    if ascending and len(values):
        values = np.concatenate([values[:1], np.diff(values)])
    planes = values.view(np.uint8).reshape(len(values), values.itemsize).T.tobytes()
    return len(values).to_bytes(8, "little") + pa.Codec("zstd", compression_level=1).compress(planes, asbytes=True)


def unpack(packed: bytes, kind: type, ascending: bool = False) -> np.ndarray:
    n, item = int.from_bytes(packed[:8], "little"), np.dtype(kind).itemsize
    planes = pa.Codec("zstd").decompress(packed[8:], n * item, asbytes=True) if n else b""
    values = np.frombuffer(planes, np.uint8).reshape(item, n).T.copy().reshape(-1).view(kind)
    return np.cumsum(values, dtype=kind) if ascending else values


def pack_bytes(data: bytes | np.ndarray) -> bytes:
    data = bytes(data)
    return len(data).to_bytes(8, "little") + pa.Codec("zstd", compression_level=3).compress(data, asbytes=True)


def unpack_bytes(packed: bytes) -> np.ndarray:
    n = int.from_bytes(packed[:8], "little")
    return np.frombuffer(pa.Codec("zstd").decompress(packed[8:], n, asbytes=True) if n else b"", np.uint8)

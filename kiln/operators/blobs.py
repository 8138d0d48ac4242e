"""Columns of numbers packed into one binary value, for shuffles of many numbers that share a key."""

from __future__ import annotations

import numpy as np
import pyarrow as pa


def packed(columns: list[np.ndarray]) -> bytes:
    """Bytes of the same place follow each other, so those that hardly vary pack well."""
    raw = b"".join(c.view(np.uint8).reshape(len(c), c.itemsize).T.tobytes() for c in columns)
    return np.array([len(c) for c in columns], np.int64).tobytes() + pa.compress(raw, codec="zstd", asbytes=True)


def unpacked(data: bytes, kinds: list) -> list[np.ndarray]:
    """The columns of ``packed``, which are of these kinds."""
    rows, widths = np.frombuffer(data, np.int64, len(kinds)).tolist(), [np.dtype(k).itemsize for k in kinds]
    raw = np.frombuffer(pa.decompress(data[8 * len(kinds):], sum(n * w for n, w in zip(rows, widths, strict=True)), codec="zstd"), np.uint8)
    out, at = [], 0
    for kind, n, width in zip(kinds, rows, widths, strict=True):
        out.append(np.ascontiguousarray(raw[at:at + width * n].reshape(width, n).T).view(kind).ravel())
        at += width * n
    return out

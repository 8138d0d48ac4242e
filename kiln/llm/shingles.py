"""Vectorised word shingles: the numpy kernel shared by the MinHash operators.

Words are the maximal runs of bytes outside ``[\\x20\\x09-\\x0D]`` after lower-casing A-Z; a shingle is
five consecutive words, or the whole sequence when there are fewer. A shingle is identified by a
mixed 64-bit hash, so a set is a sorted array of distinct unsigned 64-bit integers. Two different
shingles of one pair of documents share a hash with probability below n^2 / 2^64.
"""

from __future__ import annotations

import numpy as np

WORDS = 5
_CHUNK = 1 << 20
_SPACE = np.zeros(256, dtype=bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True


def mix(x: np.ndarray) -> np.ndarray:
    """Finaliser of splitmix64: every input bit reaches every output bit."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def stream(n: int, seed: int) -> np.ndarray:
    """``n`` reproducible 64-bit constants (odd)."""
    step = np.uint64(0x9E3779B97F4A7C15)
    base = np.uint64(seed * 0xD1342543DE82EF95 % (1 << 64))
    return mix(base + step * np.arange(1, n + 1, dtype=np.uint64)) | np.uint64(1)


_BYTES = stream(256, 1)
_BYTES[_SPACE] = 0
_POSITION = stream(WORDS, 2)
_BASE = 0x2545F4914F6CDD1D


def _power_table(n: int) -> tuple[np.ndarray, np.ndarray]:
    """``_BASE**i`` and ``_BASE**-i`` modulo 2^64 for i < n."""
    tables = []
    for base in (_BASE, pow(_BASE, -1, 1 << 64)):
        factors = np.full(n, base, dtype=np.uint64)
        factors[0] = 1
        tables.append(np.multiply.accumulate(factors))
    return tables[0], tables[1]


_TABLES = _power_table(1 << 14)


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    global _TABLES
    if n > len(_TABLES[0]):
        _TABLES = _power_table(n)
    return _TABLES


def _words_of_block(data: bytes) -> np.ndarray:
    """Polynomial hash of each word, shifted to the word's own start, with its length mixed in."""
    raw = np.frombuffer(data, dtype=np.uint8)
    edge = np.flatnonzero(np.diff(_SPACE[raw], prepend=True, append=True))
    if not len(edge):
        return np.empty(0, dtype=np.uint64)
    starts, ends = edge[0::2], edge[1::2]
    up, down = _powers(len(raw))
    sums = np.add.reduceat(_BYTES[raw] * up[: len(raw)], starts)
    return mix(sums * down[starts] ^ (ends - starts).astype(np.uint64))


def word_hashes(text: bytes) -> np.ndarray:
    """One hash per word, in order. Long texts go block by block, cut at white space."""
    data = text.lower()
    if len(data) <= _CHUNK:
        return _words_of_block(data)
    parts, at = [], 0
    while at < len(data):
        end = min(at + _CHUNK, len(data))
        while end < len(data) and not _SPACE[data[end]]:
            end += 1
        parts.append(_words_of_block(data[at:end]))
        at = end
    return np.concatenate(parts)


def shingle_sequence(text: bytes | None, words: int = WORDS) -> np.ndarray:
    """Shingle hashes in text order, repeats included; empty without words."""
    if not text:
        return np.empty(0, dtype=np.uint64)
    w = word_hashes(text)
    n = len(w)
    if n == 0:
        return w
    if n < words:
        return mix((w * _POSITION[:n]).sum(keepdims=True, dtype=np.uint64) + np.uint64(n))
    out = w[: n - words + 1] * _POSITION[0]
    for k in range(1, words):
        out = out + w[k: n - words + 1 + k] * _POSITION[k]
    return mix(out + np.uint64(words))


def shingle_set(text: bytes | None, words: int = WORDS) -> np.ndarray:
    """Sorted distinct shingle hashes."""
    return np.unique(shingle_sequence(text, words))


def signed(x: np.ndarray) -> np.ndarray:
    """The same 64 bits as Spark's long."""
    return x.view(np.int64)

"""Word and word-shingle hashes over whole texts, vectorised with numpy.

A word is a maximal run of bytes outside ``[\\x20\\x09-\\x0D]`` of the UTF-8 text after lower-casing A-Z;
UTF-8 never hides those bytes inside a character, so byte-wise splitting equals character-wise splitting.
Texts are hashed in batches: one concatenated byte buffer per batch, word hashes from prefix sums,
then 64-bit mixing.  Batches are cut by bytes, so memory stays bounded by the longest text.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

BATCH_BYTES = 1 << 20

_U = np.uint64
_BASE = 0x9E3779B97F4A7C15 | 1
_INV = pow(_BASE, -1, 1 << 64)


def mix64(x: np.ndarray) -> np.ndarray:
    """Bijective 64-bit finaliser (xor-shift-multiply)."""
    x = x ^ (x >> _U(32))
    x = x * _U(0xD6E8FEB86659FD93)
    x = x ^ (x >> _U(32))
    x = x * _U(0xD6E8FEB86659FD93)
    return x ^ (x >> _U(32))


def _byte_table() -> np.ndarray:
    table = mix64(np.arange(1, 257, dtype=_U) * _U(_BASE))
    table[65:91] = table[97:123]                       # lower-case A-Z only
    return table


_TABLE = _byte_table()
_SPACE = np.zeros(256, dtype=bool)
_SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
_POWERS = {"n": 0, "up": np.empty(0, _U), "down": np.empty(0, _U)}


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base and of its inverse modulo 2^64, grown on demand."""
    if _POWERS["n"] < n:
        size = max(n, BATCH_BYTES + 1024)
        up, down = np.full(size, _U(_BASE)), np.full(size, _U(_INV))
        up[0] = down[0] = 1
        _POWERS.update(n=size, up=np.cumprod(up), down=np.cumprod(down))
    return _POWERS["up"][:n], _POWERS["down"][:n]


def text_batches(batches: Iterator[pa.RecordBatch], column: str = "text", size: int = BATCH_BYTES) -> Iterator[pa.RecordBatch]:
    """Cut record batches so that each holds about ``size`` bytes of text (one row at least)."""
    for batch in batches:
        lengths = np.asarray(pc.fill_null(pc.binary_length(batch[column]), 0), dtype=np.int64)
        start, total = 0, 0
        for i, n in enumerate(lengths):
            if i > start and total + n > size:
                yield batch.slice(start, i - start)
                start, total = i, 0
            total += int(n)
        if start < batch.num_rows:
            yield batch.slice(start)


def text_buffer(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of all texts, each followed by one space, and the offset of every text (n + 1 entries)."""
    blob = [b if b is not None else b"" for b in texts.cast(pa.binary()).to_pylist()]
    ends = np.cumsum([len(b) + 1 for b in blob], dtype=np.int64) if blob else np.empty(0, np.int64)
    data = np.frombuffer(b" ".join(blob) + b" ", dtype=np.uint8)
    return data, np.concatenate([np.zeros(1, np.int64), ends])


def word_hashes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """64-bit hash of every word of every text, and where each text's words start (n + 1 entries)."""
    data, offsets = text_buffer(texts)
    space = _SPACE[data]
    inside = ~space
    starts = np.flatnonzero(inside & np.concatenate([[True], space[:-1]]))
    ends = np.flatnonzero(space & np.concatenate([[False], inside[:-1]]))
    up, down = _powers(len(data) + 1)
    sums = np.concatenate([np.zeros(1, _U), np.cumsum(_TABLE[data] * up[: len(data)])])
    raw = (sums[ends] - sums[starts]) * down[starts]
    hashes = mix64(raw + (ends - starts).astype(_U) * _U(0xA24BAED4963EE407))
    return hashes, np.searchsorted(starts, offsets)


def shingle_hashes(words: np.ndarray, width: int) -> np.ndarray:
    """Hashes of all windows of ``width`` words; a shorter, non-empty sequence counts as one shingle."""
    n = len(words)
    if n == 0:
        return words
    w = min(width, n)
    out = np.full(n - w + 1, _U(w), dtype=_U)
    for i in range(w):
        out = mix64(out * _U(0x9FB21C651E98DF25) + words[i:n - w + 1 + i])
    return out


def shingle_set(words: np.ndarray, width: int) -> np.ndarray:
    """Sorted distinct shingle hashes of one text."""
    return np.unique(shingle_hashes(words, width))

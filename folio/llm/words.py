"""Vectorised word splitting and hashing for Arrow-batched tasks.

A word is a run of bytes other than ``[\\x20\\x09-\\x0D]``.  The helpers work
on UTF-8 bytes, so nothing is decoded, and on blocks of a few megabytes, so
a task's memory is bounded by its largest text.  Hashes are 64 bits wide and
the same in every process.
"""

from __future__ import annotations

import ctypes
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

BLOCK_BYTES = 2 << 20

try:
    _LIBC = ctypes.CDLL("libc.so.6")
except OSError:  # not glibc: freed memory goes back by itself, or not at all
    _LIBC = None

_IS_WORD = np.ones(256, dtype=bool)
_IS_WORD[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = False
_M1, _M2 = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xBF58476D1CE4E5B9)
_S1, _S2 = np.uint64(32), np.uint64(29)
_BASE = np.uint64(0xD6E8FEB86659FD93)
_LOW_BYTES = np.array([(1 << (8 * i)) - 1 for i in range(9)], dtype=np.uint64)


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective 64-bit finaliser."""
    x = x ^ (x >> _S1)
    x = x * _M1
    x = x ^ (x >> _S2)
    x = x * _M2
    return x ^ (x >> _S1)


class Words(NamedTuple):
    """The words of several texts: ``ptr[d]:ptr[d + 1]`` are those of text d."""

    data: np.ndarray
    starts: np.ndarray
    lens: np.ndarray
    ptr: np.ndarray
    text_starts: np.ndarray

    @property
    def doc(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.ptr) - 1), np.diff(self.ptr))


def split_words(texts: list[bytes | None], lower: bool = False) -> Words:
    """Split texts (null: no words); ``lower`` maps A-Z only."""
    blob = b" ".join([t or b"" for t in texts]) + b" " * 8
    data = np.frombuffer(blob.lower() if lower else blob, dtype=np.uint8)
    flips = np.flatnonzero(np.diff(_IS_WORD[data].view(np.int8), prepend=np.int8(0)))
    starts, ends = flips[0::2], flips[1::2]
    offsets = np.zeros(len(texts) + 1, dtype=np.int64)
    np.cumsum([len(t or b"") + 1 for t in texts], out=offsets[1:])
    return Words(data, starts, ends - starts, np.searchsorted(starts, offsets), offsets)


def word_hashes(words: Words) -> np.ndarray:
    """One 64-bit hash a word, eight bytes at a time."""
    eight = np.ndarray((len(words.data) - 7,), dtype="<u8", buffer=words.data, strides=(1,))
    out = mix(words.lens.astype(np.uint64) + _M2)
    live, at = np.arange(len(words.starts)), 0
    while len(live):
        left = words.lens[live] - at
        chunk = eight[words.starts[live] + at] & _LOW_BYTES[np.minimum(left, 8)]
        out[live] = mix((out[live] ^ chunk) * _BASE + _M1)
        at += 8
        live = live[left > 8]
    return out


def window_hashes(hashes: np.ndarray, k: int) -> np.ndarray:
    """Hash of each run of k hashes (``len - k + 1`` of them, or none)."""
    n = len(hashes) - k + 1
    if n <= 0:
        return np.empty(0, dtype=np.uint64)
    if k <= 12:
        acc = hashes[:n].copy()
        for j in range(1, k):
            acc = acc * _BASE + hashes[j:n + j]
        return mix(acc)
    # sum(h[i + j] * B**j) from prefix sums; B is odd, so it has an inverse
    inverse = np.uint64(pow(int(_BASE), -1, 1 << 64))
    powers = np.cumprod(np.full(len(hashes), _BASE, dtype=np.uint64))
    back = np.cumprod(np.full(n, inverse, dtype=np.uint64))
    sums = np.zeros(len(hashes) + 1, dtype=np.uint64)
    np.cumsum(hashes * powers, out=sums[1:])
    return mix((sums[k:] - sums[:n]) * back)


def whole_windows(ptr: np.ndarray, n_words: int, k: int) -> np.ndarray:
    """Marks the windows of k words (by first word) that stay within one text."""
    n = max(0, n_words - k + 1)
    left = np.repeat(ptr[1:], np.diff(ptr))[:n] - np.arange(n)
    return left >= k


def per_text(counts: np.ndarray, ptr: np.ndarray) -> np.ndarray:
    """Sums of a per-word (or per-byte) array over each text."""
    sums = np.zeros(len(counts) + 1, dtype=np.int64)
    np.cumsum(counts, out=sums[1:])
    return sums[ptr[1:]] - sums[ptr[:-1]]


def as_bytes(column: pa.Array) -> list[bytes | None]:
    """A string column's values as UTF-8 bytes, not decoded."""
    return pc.cast(column, pa.binary()).to_pylist()


def give_back() -> None:
    """Return freed memory to the system: workers live on, and an executor's limit holds them all."""
    pa.default_memory_pool().release_unused()
    if _LIBC is not None:
        _LIBC.malloc_trim(0)


def blocks(texts: list[bytes | None], limit: int = BLOCK_BYTES) -> Iterator[tuple[int, int]]:
    """Ranges of rows with about ``limit`` bytes of text, one row at least."""
    low = size = 0
    for i, t in enumerate(texts):
        size += len(t or b"") + 1
        if size >= limit:
            yield low, i + 1
            low, size = i + 1, 0
    if low < len(texts):
        yield low, len(texts)
    give_back()


def signed(x: np.ndarray) -> np.ndarray:
    """The same 64 bits as Spark's signed long."""
    return np.ascontiguousarray(x, dtype=np.uint64).view(np.int64)

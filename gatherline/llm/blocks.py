"""Vectorised text work inside Arrow batches.

Texts of a batch are taken in blocks of about ``BLOCK_BYTES``; a block's UTF-8 bytes lie in one numpy array with the
documents' offsets beside it, so that words, n-grams and their 64-bit hashes are found for many documents at once and
memory stays bounded by the block (or by one document, if that is longer).
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa

BLOCK_BYTES = 1 << 20
U64 = np.uint64
BASE = 0x9E3779B97F4A7C15 | 1
INVERSE = pow(BASE, -1, 1 << 64)
SPACE = np.zeros(256, bool)
SPACE[[0x20, *range(0x09, 0x0E)]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32


def utf8(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and offsets of a string column; null counts as empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.fill_null("") if column.null_count else column
    if len(column) == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    kind = np.int64 if pa.types.is_large_string(column.type) else np.int32
    offsets = np.frombuffer(column.buffers()[1], kind, len(column) + 1, column.offset * np.dtype(kind).itemsize)
    data = column.buffers()[2]
    return (np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)), offsets.astype(np.int64)


def blocks(column: pa.Array, limit: int = BLOCK_BYTES, rows: int = 1 << 16) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, end row, bytes, offsets from 0) of successive blocks of whole documents."""
    data, offsets = utf8(column)
    low, n = 0, len(offsets) - 1
    while low < n:
        high = min(n, low + rows, max(low + 1, int(np.searchsorted(offsets, offsets[low] + limit, "right")) - 1))
        yield low, high, data[offsets[low] : offsets[high]], offsets[low : high + 1] - offsets[low]
        low = high


@lru_cache(maxsize=1)
def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    up, down = np.full(n + 1, BASE, U64), np.full(n + 1, INVERSE, U64)
    up[0] = down[0] = 1
    return np.cumprod(up, dtype=U64), np.cumprod(down, dtype=U64)


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the hash base and of its inverse modulo 2**64, at least ``n`` of each."""
    return _powers(1 << max(16, int(n).bit_length()))


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective scramble of 64-bit values (two xor-multiply rounds)."""
    x = x ^ (x >> U64(32))
    x = x * U64(0xD6E8FEB86659FD93)
    x ^= x >> U64(32)
    x *= U64(0xD6E8FEB86659FD93)
    x ^= x >> U64(32)
    return x


def span_hashes(symbols: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit polynomial hashes of symbols[start:end]; equal spans hash alike wherever they stand."""
    up, down = powers(len(symbols))
    total = np.zeros(len(symbols) + 1, U64)
    np.cumsum((symbols.astype(U64) + U64(1)) * up[: len(symbols)], out=total[1:])
    return mix((total[ends] - total[starts]) * down[starts] + (ends - starts).astype(U64))


def breaks(n: int, offsets: np.ndarray) -> np.ndarray:
    """True where a document begins; one place more than there are symbols."""
    first = np.zeros(n + 1, bool)
    first[offsets] = True
    return first


def runs(inside: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of maximal runs of True that do not cross documents."""
    n = len(inside)
    if n == 0:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    first = breaks(n, offsets)
    start, end = inside.copy(), inside.copy()
    start[1:] &= ~inside[:-1] | first[1:n]
    end[:-1] &= ~inside[1:] | first[1:n]
    return np.flatnonzero(start), np.flatnonzero(end) + 1


def words(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of words [^\\x20\\x09-\\x0D]+, and for each document the index of its first word (one more at the end)."""
    starts, ends = runs(~SPACE[data], offsets)
    return starts, ends, np.searchsorted(starts, offsets)


def letter_words(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """As words(), of runs of ASCII letters and non-ASCII bytes; data is lower-cased."""
    starts, ends = runs(((data >= 97) & (data <= 122)) | (data >= 128), offsets)
    return starts, ends, np.searchsorted(starts, offsets)


def sums(values: np.ndarray, firsts: np.ndarray) -> np.ndarray:
    """Sums of values[first[i]:first[i + 1]] along axis 0; empty ranges give 0."""
    total = np.zeros((len(values) + 1, *values.shape[1:]), np.float64)
    np.cumsum(values, axis=0, dtype=np.float64, out=total[1:])
    return total[firsts[1:]] - total[firsts[:-1]]

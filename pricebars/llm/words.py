"""Vectorised word and shingle helpers over Arrow string buffers.

A word is a run of ASCII letters and digits or non-ASCII characters; ASCII letters
are compared in lower case.  A shingle is ``width`` consecutive words; a text of
fewer words, but at least one, has one shingle made of all its words.  Words and
shingles are 64-bit hashes.  NULL and empty texts have neither.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql.types import StructType

CHUNK_BYTES = 1 << 20
SHINGLE = 5

LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
IS_WORD = np.zeros(256, dtype=bool)
IS_WORD[48:58] = IS_WORD[65:91] = IS_WORD[97:123] = IS_WORD[128:] = True

_BASE = 0x9E3779B97F4A7C15
_POWERS = np.ones(1, dtype=np.uint64)


def mix(x: np.ndarray) -> np.ndarray:
    """Finaliser of splitmix64: every input bit reaches every output bit."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def powers(n: int) -> np.ndarray:
    """The first ``n`` powers of an odd constant, modulo 2^64."""
    global _POWERS
    if len(_POWERS) < n:
        size = max(64, 1 << (n - 1).bit_length())
        p = np.full(size, _BASE, dtype=np.uint64)
        p[0] = 1
        _POWERS = np.cumprod(p, dtype=np.uint64)
    return _POWERS[:n]


def utf8(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of all texts in a row, and the offset of each; NULL is empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = column.fill_null("" if pa.types.is_string(column.type) or pa.types.is_large_string(column.type) else b"")
    wide = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    _, offsets, data = column.buffers()
    if len(column) == 0 or offsets is None:
        return np.zeros(0, np.uint8), np.zeros(len(column) + 1, np.int64)
    o = np.frombuffer(offsets, dtype=np.int64 if wide else np.int32)[column.offset:column.offset + len(column) + 1].astype(np.int64)
    raw = np.frombuffer(data, dtype=np.uint8) if data is not None else np.zeros(0, np.uint8)
    return raw[o[0]:o[-1]], o - o[0]


def slices(column: pa.Array, limit: int = CHUNK_BYTES) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """``(first row, end row, bytes, offsets)`` of runs of about ``limit`` bytes;
    a longer text is a run of its own."""
    data, offsets = utf8(column)
    row, n = 0, len(offsets) - 1
    while row < n:
        end = max(row + 1, int(np.searchsorted(offsets, offsets[row] + limit, side="right")) - 1)
        end = min(end, n)
        yield row, end, data[offsets[row]:offsets[end]], offsets[row:end + 1] - offsets[row]
        row = end


def words(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``(hash of each word, first word of each text, byte (start, end) of each word)``."""
    n = len(data)
    if n == 0:
        return np.zeros(0, np.uint64), np.zeros(len(offsets), np.int64), np.zeros((2, 0), np.int64)
    inside = IS_WORD[data]
    before = np.zeros(n, bool)
    before[1:] = inside[:-1]
    before[offsets[:-1][offsets[:-1] < n]] = False
    after = np.zeros(n, bool)
    after[:-1] = inside[1:]
    after[offsets[1:][offsets[1:] > 0] - 1] = False
    starts = np.flatnonzero(inside & ~before)
    ends = np.flatnonzero(inside & ~after) + 1
    first = np.searchsorted(starts, offsets)
    lengths = ends - starts
    if len(starts) == 0:
        return np.zeros(0, np.uint64), first, np.zeros((2, 0), np.int64)
    at = np.flatnonzero(inside)
    heads = np.zeros(len(starts), np.int64)
    np.cumsum(lengths[:-1], out=heads[1:])
    within = np.arange(len(at)) - np.repeat(heads, lengths)
    value = (LOWER[data[at]].astype(np.uint64) + np.uint64(1)) * powers(int(lengths.max()))[within]
    return mix(np.add.reduceat(value, heads)), first, np.stack([starts, ends])


def shingles(hashes: np.ndarray, first: np.ndarray, width: int = SHINGLE) -> tuple[np.ndarray, np.ndarray]:
    """``(hash of each shingle, first shingle of each text)``.  Shingle ``i`` of a
    text starts at its word ``i``."""
    factor = powers(width + 1)[1:] * np.uint64(0xD6E8FEB86659FD93)
    count = np.diff(first)
    total = np.maximum(count - width + 1, (count > 0).astype(np.int64))
    starts = np.zeros(len(first), np.int64)
    np.cumsum(total, out=starts[1:])
    if starts[-1] == 0:
        return np.zeros(0, np.uint64), starts
    at = np.arange(starts[-1]) + np.repeat(first[:-1] - starts[:-1], total)
    out = np.zeros(len(at), np.uint64)
    short = np.repeat(count < width, total)
    last = np.repeat(first[1:], total) - 1
    for j in range(width):
        here = hashes[np.minimum(at + j, len(hashes) - 1)] * factor[j]
        out += np.where(short & (at + j > last), np.uint64(0), here) if short.any() else here
    return mix(out), starts


def extended(schema: StructType, **added: str) -> StructType:
    """A copy of ``schema`` with more fields; fields of the same names give way."""
    more = StructType.fromDDL(", ".join(f"`{name}` {kind}" for name, kind in added.items()))
    return StructType([f for f in schema.fields if f.name not in added] + more.fields)

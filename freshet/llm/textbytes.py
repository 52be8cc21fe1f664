"""Byte-level text kernels that run inside Arrow tasks (numpy only, one document or batch at a time)."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash

#: Odd number whose powers set the places of a shingle apart.
_FACTOR = 0x9E3779B97F4A7C15


def text_bytes(column) -> list[bytes]:
    """UTF-8 bytes of an Arrow string column, null as empty, without making Python strings."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    binary = column.cast(pa.large_binary())
    return [b"" if x is None else x for x in binary.to_pylist()]


def byte_batches(batches, column: int, limit: int):
    """Arrow batches cut so that the named text column holds at most ``limit`` bytes, or one row."""
    for batch in batches:
        sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False).astype(np.int64)
        ends = np.cumsum(sizes)
        begin = 0
        while begin < batch.num_rows:
            before = ends[begin - 1] if begin else 0
            end = max(begin + 1, int(np.searchsorted(ends, before + limit, side="right")))
            yield batch.slice(begin, end - begin)
            begin = end


def small_batches(batches, column: int, limit: int = 8 << 20):
    return byte_batches(batches, column, limit)


def ascii_words(text: bytes) -> list[bytes]:
    """Words separated by [\\x20\\x09-\\x0D], A-Z lower-cased, other bytes as they are."""
    return text.lower().split()


def mix64(x: np.ndarray) -> np.ndarray:
    """Bijective finaliser of 64-bit values (xor-shift and multiply)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def shingle_set(words: list[bytes], width: int = 5) -> np.ndarray:
    """Sorted distinct hashes of the ``width``-word shingles.

    Fewer words than ``width`` make one shingle of them all; no words make an empty set. A shingle's hash mixes
    the hashes of its words by place, so nothing in the letters of a text can make two shingles equal.
    """
    if not words:
        return np.empty(0, np.uint64)
    hashes = np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words))
    width = min(width, len(words))
    n = len(words) - width + 1
    out = np.full(n, width, np.uint64)
    factor = _FACTOR
    for i in range(width):
        out += hashes[i : i + n] * np.uint64(factor)
        factor = factor * _FACTOR % 2**64
    out = mix64(out)
    out.sort()
    return out[np.concatenate(([True], out[1:] != out[:-1]))]


def digest128(text: bytes) -> tuple[int, int]:
    """Two signed 64-bit halves of a 128-bit content digest."""
    value = xxhash.xxh3_128_intdigest(text)
    high, low = value >> 64, value & (2**64 - 1)
    return high - 2**64 * (high >= 2**63), low - 2**64 * (low >= 2**63)

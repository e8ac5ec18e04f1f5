"""Byte and word arrays of text batches, and their 64-bit fingerprints.

Everything works on numpy arrays over the concatenated UTF-8 bytes of a few documents, so a task
needs memory for one block of texts only (``BLOCK`` bytes, or one text if that is longer).
Fingerprints of two different strings agree with a chance of about 2**-64.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

BLOCK = 1_000_000
WORD = r"[^\x20\x09-\x0D]+"
SHINGLE = 5

_ODD = np.uint64(0x9E3779B97F4A7C15)
_ODD_INVERSE = np.uint64(pow(0x9E3779B97F4A7C15, -1, 2**64))
_SIGN = np.uint64(1 << 63)

IS_SPACE = np.zeros(256, bool)
IS_SPACE[[0x20, *range(0x09, 0x0E)]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32


def mix(x: np.ndarray) -> np.ndarray:
    """The splitmix64 finaliser: spreads every input bit over the whole word."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


BYTE_CODE = mix(np.arange(1, 257, dtype=np.uint64) * _ODD)


def ordered(x: np.ndarray) -> np.ndarray:
    """Signed form of unsigned hashes that keeps their order."""
    return (x ^ _SIGN).view(np.int64)


def unordered(x: np.ndarray) -> np.ndarray:
    """Inverse of :func:`ordered`."""
    return x.view(np.uint64) ^ _SIGN


@lru_cache(maxsize=2)
def _powers(n: int, inverse: bool) -> np.ndarray:
    out = np.full(n, _ODD_INVERSE if inverse else _ODD)
    out[0] = 1
    return np.multiply.accumulate(out)


def powers(n: int, inverse: bool = False) -> np.ndarray:
    size = 1 << max(16, int(n - 1).bit_length())
    return _powers(size, inverse)[:n]


def prefix_hash(data: np.ndarray) -> np.ndarray:
    """h[i]: polynomial hash of the first i bytes (modulo 2**64)."""
    out = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(BYTE_CODE[data] * powers(max(1, len(data)))[: len(data)], out=out[1:])
    return out


def span_hash(prefix: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Fingerprints of the byte ranges [start, end), whatever their place."""
    return mix((prefix[end] - prefix[start]) * powers(len(prefix), inverse=True)[start] + (end - start).astype(np.uint64))


def column_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Concatenated bytes and offsets of a string column; nulls count as empty."""
    column = pc.fill_null(column.cast(pa.large_string()), "")
    _, offsets, data = column.buffers()
    at = np.frombuffer(offsets, np.int64)[column.offset : column.offset + len(column) + 1]
    return (np.frombuffer(data, np.uint8) if data else np.zeros(0, np.uint8)), at


def blocks(batch: pa.RecordBatch, name: str = "text") -> Iterator[tuple[slice, np.ndarray, np.ndarray]]:
    """(rows, bytes, offsets) of consecutive rows with about ``BLOCK`` bytes of text."""
    data, at = column_bytes(batch.column(batch.schema.get_field_index(name)))
    row = 0
    while row < batch.num_rows:
        end = max(row + 1, int(np.searchsorted(at, at[row] + BLOCK, "right")) - 1)
        end = min(end, batch.num_rows)
        yield slice(row, end), data[at[row] : at[end]], at[row : end + 1] - at[row]
        row = end


def word_spans(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start, end and document of every word; words never cross documents."""
    if not len(data):
        none = np.zeros(0, np.int64)
        return none, none, none
    inside = ~IS_SPACE[data]
    edge = np.zeros(len(data) + 1, bool)
    edge[offsets] = True
    start = inside.copy()
    start[1:] &= ~inside[:-1] | edge[1:-1]
    end = inside.copy()
    end[:-1] &= ~inside[1:] | edge[1:-1]
    first = np.flatnonzero(start)
    return first, np.flatnonzero(end) + 1, np.searchsorted(offsets, first, "right") - 1


def word_hashes(data: np.ndarray, offsets: np.ndarray, lower: bool = True) -> tuple[np.ndarray, ...]:
    """Fingerprint, start, end and document of every word."""
    start, end, doc = word_spans(data, offsets)
    prefix = prefix_hash(LOWER[data] if lower else data)
    return span_hash(prefix, start, end), start, end, doc


def shingle_hashes(words: np.ndarray, size: int = SHINGLE) -> np.ndarray:
    """Fingerprint of each run of ``size`` neighbouring words (``len(words) - size + 1``)."""
    n = len(words) - size + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    out = np.zeros(n, np.uint64)
    for i in range(size):
        out = out * _ODD + words[i : i + n]
    return mix(out + np.uint64(size))


def shingle_sets(data: np.ndarray, offsets: np.ndarray, size: int = SHINGLE) -> list[np.ndarray]:
    """Sorted distinct shingles per document; a shorter text is one shingle, a wordless one has none."""
    words, _, _, doc = word_hashes(data, offsets)
    bounds = np.searchsorted(doc, np.arange(len(offsets)))
    every = shingle_hashes(words, size)
    out = []
    for a, b in zip(bounds[:-1], bounds[1:], strict=True):
        if b - a >= size:
            out.append(np.unique(every[a : b - size + 1]))
        elif b > a:
            out.append(shingle_hashes(words[a:b], int(b - a)))
        else:
            out.append(np.zeros(0, np.uint64))
    return out

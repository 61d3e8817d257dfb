"""Word and shingle hashes of Arrow text columns, in numpy over the UTF-8 bytes.

Words are runs of ``[^\\x20\\x09-\\x0D]+`` with A-Z lower-cased. A word's hash is a 64-bit
polynomial of its bytes and its length, a shingle's hash a 64-bit combination of its words'
hashes; equal words and shingles have equal hashes everywhere.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

CHUNK_BYTES = 1 << 20
_SPACE = np.zeros(256, dtype=bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
_LOWER = np.arange(256, dtype=np.uint64) + np.uint64(1)
_LOWER[65:91] += np.uint64(32)
_BASE = np.uint64(0x9E3779B97F4A7C15 | 1)
_powers = np.ones(1, dtype=np.uint64)


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective scrambling of 64-bit values (two multiply-xorshift rounds)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _power_table(n: int) -> np.ndarray:
    global _powers
    if len(_powers) < n:
        _powers = np.cumprod(np.concatenate([[np.uint64(1)], np.full(2 * n, _BASE)]), dtype=np.uint64)
    return _powers


def text_buffers(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and offsets of a text column; a null is an empty text."""
    if column.null_count:
        column = column.fill_null("")
    if pa.types.is_large_string(column.type):
        offsets = np.frombuffer(column.buffers()[1], dtype=np.int64)
    else:
        offsets = np.frombuffer(column.buffers()[1], dtype=np.int32).astype(np.int64)
    offsets = offsets[column.offset : column.offset + len(column) + 1]
    data = column.buffers()[2]
    return (np.frombuffer(data, dtype=np.uint8) if data is not None else np.zeros(0, np.uint8)), offsets


def _hash_words(data: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the words of ``data`` and, for each text between ``bounds``, its first word's position."""
    if not len(data):
        return np.zeros(0, np.uint64), np.zeros(len(bounds), np.int64)
    solid = ~_SPACE[data]
    edge = np.zeros(len(data) + 1, dtype=bool)
    edge[bounds] = True
    before = np.empty(len(data), dtype=bool)
    before[0], before[1:] = True, ~solid[:-1]
    starts = np.flatnonzero(solid & (before | edge[:-1]))
    after = np.empty(len(data), dtype=bool)
    after[-1], after[:-1] = True, ~solid[1:]
    lengths = np.flatnonzero(solid & (after | edge[1:])) + 1 - starts
    if not len(starts):
        return np.zeros(0, np.uint64), np.zeros(len(bounds), np.int64)
    first = np.cumsum(lengths) - lengths
    place = np.arange(int(lengths.sum())) - np.repeat(first, lengths)
    terms = _LOWER[data[solid]] * _power_table(int(lengths.max()))[place]
    hashes = mix(np.add.reduceat(terms, first) + lengths.astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93))
    return hashes, np.searchsorted(starts, bounds)


def word_hashes(column: pa.Array, chunk_bytes: int = CHUNK_BYTES) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(first row, hashes, word bounds) for chunks of rows; row r of a chunk has hashes[bounds[r]:bounds[r + 1]]."""
    data, offsets = text_buffers(column)
    row, n = 0, len(column)
    while row < n:
        stop = max(row + 1, int(np.searchsorted(offsets, offsets[row] + chunk_bytes, side="right")) - 1)
        stop = min(stop, n)
        low, high = offsets[row], offsets[stop]
        hashes, bounds = _hash_words(data[low:high], offsets[row : stop + 1] - low)
        yield row, hashes, bounds
        row = stop


def shingles(words: np.ndarray, width: int) -> np.ndarray:
    """Sorted distinct shingle hashes of one text; fewer words than ``width`` form one shingle, none form none."""
    if not len(words):
        return words
    span = min(width, len(words))
    n = len(words) - span + 1
    total = np.full(n, np.uint64(span))
    for k in range(span):
        total = (total ^ words[k : k + n]) * np.uint64(0xFF51AFD7ED558CCD) + np.uint64(2 * k + 1)
        total ^= total >> np.uint64(29)
    return np.unique(mix(total))


def shingle_sets(column: pa.Array, width: int) -> Iterator[tuple[int, np.ndarray]]:
    """(row, shingle set) of every row of a text column."""
    for row, hashes, bounds in word_hashes(column):
        for i in range(len(bounds) - 1):
            yield row + i, shingles(hashes[bounds[i] : bounds[i + 1]], width)

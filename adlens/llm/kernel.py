"""Vectorised text kernels over the UTF-8 bytes of an Arrow string column.

Words, lower-casing and word hashes work on whole batches without making a Python string.
A word hash has 64 bits: equal words have equal hashes, and unequal ones collide with
probability 2**-64 a pair.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa

U64 = np.uint64
_ODD = U64(0x9E3779B97F4A7C15)
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32

#: Word bytes of [^\x20\x09-\x0D]+.
NOT_SPACE = np.ones(256, bool)
NOT_SPACE[[0x20, *range(0x09, 0x0E)]] = False
#: Word bytes of [^\x00-\x2F\x3A-\x60\x7B-\x7F]+ after A-Z have become a-z: digits, letters, all beyond ASCII.
ALNUM = np.zeros(256, bool)
ALNUM[[*range(0x30, 0x3A), *range(0x41, 0x5B), *range(0x61, 0x7B), *range(0x80, 0x100)]] = True


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser (splitmix64)."""
    x = x ^ (x >> U64(30))
    x = x * U64(0xBF58476D1CE4E5B9)
    x ^= x >> U64(27)
    x *= U64(0x94D049BB133111EB)
    x ^= x >> U64(31)
    return x


def utf8(column: pa.Array | pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of a string column and the n + 1 offsets of its rows; null counts as empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = column.fill_null("")
    if not len(column):
        return np.empty(0, np.uint8), np.zeros(1, np.int64)
    wide = pa.types.is_large_string(column.type)
    _, places, data = column.buffers()
    at = np.frombuffer(places, np.int64 if wide else np.int32)[column.offset:column.offset + len(column) + 1]
    at = at.astype(np.int64)
    if data is None or at[0] == at[-1]:
        return np.empty(0, np.uint8), at - at[0]
    return np.frombuffer(data, np.uint8)[at[0]:at[-1]], at - at[0]


def words(data: np.ndarray, offsets: np.ndarray, table: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of all words, and for each row the index of its first word (n + 1 numbers)."""
    inside = table[data]
    begin, last = inside.copy(), inside.copy()
    begin[1:] &= ~inside[:-1]
    last[:-1] &= ~inside[1:]
    size = len(data)
    heads = offsets[:-1][offsets[:-1] < size]
    tails = offsets[1:][offsets[1:] > 0] - 1
    begin[heads] |= inside[heads]
    last[tails] |= inside[tails]
    starts = np.flatnonzero(begin)
    return starts, np.flatnonzero(last) + 1, np.searchsorted(starts, offsets)


def hash_words(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, lower: bool = True) -> np.ndarray:
    """64-bit hash of each word, eight bytes at a time."""
    padded = np.concatenate([LOWER[data] if lower else data, np.zeros(8, np.uint8)])
    eight = np.lib.stride_tricks.as_strided(padded, (len(data) + 1, 8), (1, 1))
    left = ends - starts
    out = left.astype(U64) * _ODD
    at, row = starts, None
    while len(at):
        chunk = eight[at].view("<u8").ravel()
        chunk &= ~U64(0) >> (U64(64) - (np.minimum(left, 8).astype(U64) << U64(3)))
        if row is None:
            out = mix(out ^ chunk)
        else:
            out[row] = mix(out[row] ^ chunk)
        more = np.flatnonzero(left > 8)
        at, left = at[more] + 8, left[more] - 8
        row = more if row is None else row[more]
    return out


def grams(hashes: np.ndarray, size: int) -> np.ndarray:
    """Hash of ``size`` hashes in a row, starting at each place (len - size + 1 numbers)."""
    if len(hashes) < size:
        return np.empty(0, U64)
    n = len(hashes) - size + 1
    total = np.full(n, U64(size))
    for k in range(size):
        total *= U64(0xD6E8FEB86659FD93)
        total += hashes[k:k + n]
    return mix(total)


def shingle_sets(hashes: np.ndarray, first: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct shingles of every row and their n + 1 offsets. A row with fewer words than
    ``size`` has its whole sequence as one shingle; one without words has none."""
    rolled = grams(hashes, size)
    sets = []
    for a, b in zip(first[:-1].tolist(), first[1:].tolist(), strict=True):
        if b - a >= size:
            own = np.sort(rolled[a:b - size + 1])
            sets.append(own[np.concatenate([[True], own[1:] != own[:-1]])])
        elif b > a:
            sets.append(grams(hashes[a:b], b - a))
        else:
            sets.append(np.empty(0, U64))
    counts = np.array([len(s) for s in sets], np.int64)
    return np.concatenate(sets) if sets else np.empty(0, U64), np.concatenate([[0], np.cumsum(counts)])


def pieces(batch: pa.RecordBatch, column: str, limit: int = 1 << 20):
    """Slices of a record batch with about ``limit`` bytes of text each (one row at least)."""
    lengths = np.diff(utf8(batch.column(column))[1])
    total = np.cumsum(lengths)
    i = 0
    while i < batch.num_rows:
        base = total[i - 1] if i else 0
        j = max(i + 1, int(np.searchsorted(total, base + limit, "right")))
        yield batch.slice(i, j - i)
        i = j

"""Vectorised hashes of byte ranges inside Arrow text buffers (numpy, inside tasks)."""

from __future__ import annotations

import functools
import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

BASE = 0x9E3779B97F4A7C15 | 1  # odd, so it has an inverse modulo 2**64
BLOCK = 1 << 21  # bytes hashed at a time
M1, M2 = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser: every input bit reaches every output bit."""
    x = x ^ (x >> np.uint64(30))
    x *= M1
    x ^= x >> np.uint64(27)
    x *= M2
    x ^= x >> np.uint64(31)
    return x


@functools.cache
def powers() -> tuple[np.ndarray, np.ndarray]:
    """BASE**i and BASE**-i for i up to BLOCK."""
    def table(base: int) -> np.ndarray:
        out = np.full(BLOCK + 1, base, dtype=np.uint64)
        out[0] = 1
        return np.cumprod(out, dtype=np.uint64)
    return table(BASE), table(pow(BASE, -1, 1 << 64))


def hash_ranges(buf: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hash of each ``buf[starts[i]:ends[i]]``; the ranges are in order of their starts.

    A polynomial over the bytes, from prefix sums block by block, so memory does not grow with
    the buffer. Ranges longer than a block are digested on their own.
    """
    out = np.empty(len(starts), dtype=np.uint64)
    up, down = powers()
    long = (ends - starts) > BLOCK // 2
    for i in np.flatnonzero(long).tolist():
        out[i] = int.from_bytes(hashlib.blake2b(buf[starts[i]:ends[i]].tobytes(),
                                                digest_size=8).digest(), "little")
    todo = np.flatnonzero(~long)
    k = 0
    while k < len(todo):
        first = int(starts[todo[k]])
        stop = int(np.searchsorted(starts[todo], first + BLOCK // 2, side="left"))
        rows = todo[k:stop]
        last = int(ends[rows].max())
        sums = np.zeros(last - first + 1, dtype=np.uint64)
        np.cumsum((buf[first:last].astype(np.uint64) + np.uint64(1)) * up[:last - first],
                  dtype=np.uint64, out=sums[1:])
        a, b = starts[rows] - first, ends[rows] - first
        out[rows] = mix((sums[b] - sums[a]) * down[a]
                        + (b - a).astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93))
        k = stop
    return out


def text_buffer(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All bytes of a text column (null: empty) and the n+1 offsets of its rows in them."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = pc.fill_null(column.cast(pa.large_binary()), b"")
    offsets = np.frombuffer(column.buffers()[1], dtype=np.int64)[
        column.offset:column.offset + len(column) + 1]
    data = column.buffers()[2]
    raw = np.frombuffer(data, dtype=np.uint8) if data is not None else np.zeros(0, np.uint8)
    return raw[offsets[0]:offsets[-1]], offsets - offsets[0]


def slices(batch: pa.RecordBatch, column: str, most_bytes: int = 2 << 20) -> Iterator[pa.RecordBatch]:
    """Parts of a batch with about ``most_bytes`` of text each, one row at least."""
    sizes = pc.fill_null(pc.binary_length(batch[column]), 0).to_numpy(
        zero_copy_only=False).astype(np.int64)
    block = np.cumsum(sizes) // most_bytes
    cuts = [0, *(np.flatnonzero(np.diff(block)) + 1).tolist(), batch.num_rows]
    for a, b in zip(cuts, cuts[1:], strict=False):
        if b > a:
            yield batch.slice(a, b - a)


def gather(arena: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """The ranges of ``arena`` one after the other."""
    ends = np.cumsum(lengths)
    total = int(ends[-1]) if len(ends) else 0
    at = np.repeat(starts - (ends - lengths), lengths)
    at += np.arange(total, dtype=at.dtype)
    return arena[at]


def lower_ascii_bytes(buf: np.ndarray) -> np.ndarray:
    upper = (buf >= 65) & (buf <= 90)
    return np.where(upper, buf + np.uint8(32), buf)


BLANK = np.zeros(256, dtype=bool)
BLANK[[9, 10, 11, 12, 13, 32]] = True


def words(buf: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start and end of every word (bytes other than 9-13 and 32), and the row of each."""
    solid = ~BLANK[buf]
    edge = np.zeros(len(buf) + 1, dtype=bool)
    edge[offsets] = True  # words do not cross rows
    before = np.concatenate([[False], solid[:-1]]) if len(buf) else solid
    after = np.concatenate([solid[1:], [False]]) if len(buf) else solid
    starts = np.flatnonzero(solid & (~before | edge[:-1]))
    ends = np.flatnonzero(solid & (~after | edge[1:])) + 1
    return starts, ends, np.searchsorted(offsets, starts, side="right") - 1


def shingles(word_hash: np.ndarray, word_row: np.ndarray, size: int,
             n_rows: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(hash, row, index of the first word) of all runs of ``size`` words within a row; a row with
    fewer words, but one at least, gives its whole sequence as one."""
    def combined(first: np.ndarray, width: int) -> np.ndarray:
        total = np.full(len(first), width, dtype=np.uint64)
        for k in range(width):
            total = mix(total * np.uint64(0xA24BAED4963EE407) + word_hash[first + k])
        return total

    n = np.bincount(word_row, minlength=n_rows)
    begin = np.cumsum(n) - n
    first = np.flatnonzero(np.arange(len(word_hash)) - begin[word_row] <= n[word_row] - size)
    hashes, rows, at = [combined(first, size)], [word_row[first]], [first]
    for width in range(1, size):
        short = np.flatnonzero(n == width)
        if len(short):
            hashes.append(combined(begin[short], width))
            rows.append(short)
            at.append(begin[short])
    return np.concatenate(hashes), np.concatenate(rows), np.concatenate(at)

"""Texts inside Arrow batches: bounded slices, words as positions in one buffer, hashes of byte ranges.

Everything works on whole texts. A slice holds about ``SLICE_BYTES`` of text, or one longer text, so
that the memory of a task follows the longest text and not the size of an Arrow batch.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash

SLICE_BYTES = 8 << 20
LONG_WORD = 256
U = np.uint64

#: White space of all word rules here: [\x20\x09-\x0D].
SPACES = b" \t\n\x0b\x0c\r"
IS_SPACE = np.zeros(256, bool)
IS_SPACE[list(SPACES)] = True


def encoded(column: pa.Array) -> list[bytes]:
    """UTF-8 bytes of a string column; null counts as empty."""
    return [b"" if x is None else x for x in column.cast(pa.binary()).to_pylist()]


def slices(batches: Iterable[pa.RecordBatch], column_name: str = "text", limit: int = SLICE_BYTES) -> Iterator[tuple[pa.RecordBatch, list[bytes]]]:
    """Runs of rows with at most ``limit`` bytes of text (one row at least), and their texts."""
    for batch in batches:
        column = batch.column(batch.schema.get_field_index(column_name))
        sizes = pc.fill_null(pc.binary_length(column), 0).to_numpy(zero_copy_only=False)
        total = np.cumsum(sizes)
        first = 0
        while first < len(sizes):
            before = int(total[first - 1]) if first else 0
            last = max(int(np.searchsorted(total, before + limit, "right")), first + 1)
            part = batch.slice(first, last - first)
            yield part, encoded(part.column(part.schema.get_field_index(column_name)))
            first = last


@dataclass
class Words:
    """Words of several texts as byte ranges of one buffer.

    ``first[d]`` is the number of the first word of text ``d``; ``first[-1]`` is the number of words.
    """

    data: np.ndarray
    start: np.ndarray
    end: np.ndarray
    first: np.ndarray

    def owner(self) -> np.ndarray:
        """The text of each word."""
        return np.repeat(np.arange(len(self.first) - 1), np.diff(self.first))


def words(texts: list[bytes]) -> Words:
    """Maximal runs of bytes other than white space."""
    data = np.frombuffer(b"\n" + b"\n".join(texts) + b"\n" + bytes(8), np.uint8)
    space = IS_SPACE[data[:-8]]
    edges = np.flatnonzero(space[1:] != space[:-1]) + 1
    sizes = np.fromiter((len(t) + 1 for t in texts), np.int64, len(texts))
    begins = np.concatenate([[1], 1 + np.cumsum(sizes)])
    return Words(data, edges[0::2], edges[1::2], np.searchsorted(edges[0::2], begins))


def _lanes(data: np.ndarray) -> np.ndarray:
    """The eight bytes from each position on, as little-endian integers."""
    return np.ndarray((len(data) - 7,), "<u8", data.data, strides=(1,))


_LOW = np.array([(1 << (8 * i)) - 1 for i in range(8)] + [2**64 - 1], np.uint64)


def mix(h: np.ndarray) -> np.ndarray:
    """A bijective finaliser of 64-bit integers."""
    h = (h ^ (h >> U(32))) * U(0xD6E8FEB86659FD93)
    h = (h ^ (h >> U(32))) * U(0xD6E8FEB86659FD93)
    return h ^ (h >> U(32))


def word_hashes(w: Words, seed: int = 0) -> np.ndarray:
    """A 64-bit hash of each word's bytes."""
    size = w.end - w.start
    lanes = _lanes(w.data)
    h = mix((lanes[w.start] & _LOW[np.minimum(size, 8)]) ^ (size.astype(U) * U(0x9E3779B97F4A7C15) + U(seed)))
    at = np.flatnonzero((size > 8) & (size <= LONG_WORD))
    k = 8
    while len(at):
        h[at] = mix(h[at] * U(0x9E3779B97F4A7C15) + (lanes[w.start[at] + k] & _LOW[np.minimum(size[at] - k, 8)]))
        k += 8
        at = at[size[at] > k]
    for i in np.flatnonzero(size > LONG_WORD):
        h[i] = U(xxhash.xxh64_intdigest(w.data[w.start[i] : w.end[i]].tobytes(), seed))
    return h


_P1, _P2, _P3 = U(0x9E3779B185EBCA87), U(0xC2B2AE3D27D4EB4F), U(0x165667B19E3779F9)
_P4, _P5 = U(0x85EBCA77C2B2AE63), U(0x27D4EB2F165667C5)


def _turn(x: np.ndarray, n: int) -> np.ndarray:
    return (x << U(n)) | (x >> U(64 - n))


def xxh64(data: np.ndarray, start: np.ndarray, size: np.ndarray, seed: int) -> np.ndarray:
    """XXH64 of byte ranges; ``data`` has eight spare bytes at its end.

    Ranges of fewer than 32 bytes, nearly all shingles, are hashed column by column.
    """
    lanes = _lanes(data)
    acc = size.astype(U) + (U(seed) + _P5)
    for k in range(3):
        at = np.flatnonzero(size >= 8 * (k + 1))
        lane = lanes[start[at] + 8 * k]
        acc[at] = _turn(acc[at] ^ (_turn(lane * _P2, 31) * _P1), 27) * _P1 + _P4
    at = np.flatnonzero(size & 4)
    acc[at] = _turn(acc[at] ^ ((lanes[start[at] + (size[at] & ~7)] & _LOW[4]) * _P1), 23) * _P2 + _P3
    for k in range(3):
        at = np.flatnonzero((size & 3) > k)
        acc[at] = _turn(acc[at] ^ (data[start[at] + (size[at] & ~3) + k].astype(U) * _P5), 11) * _P1
    acc = (acc ^ (acc >> U(33))) * _P2
    acc = (acc ^ (acc >> U(29))) * _P3
    acc ^= acc >> U(32)
    for i in np.flatnonzero(size >= 32):
        acc[i] = U(xxhash.xxh64_intdigest(data[start[i] : start[i] + size[i]].tobytes(), seed))
    return acc

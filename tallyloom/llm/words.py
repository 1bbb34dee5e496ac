"""Words of whole texts, found and hashed for a batch at a time.

A word is a run of letters, digits and non-ASCII characters after lower-casing
A-Z: ``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+``. On UTF-8 this is a rule on single
bytes, so whole batches are handled with array operations.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

# Bytes of text that are worked on at once; a longer text is a chunk of its own.
CHUNK_BYTES = 1 << 20

_U = np.uint64


def mix(x: np.ndarray) -> np.ndarray:
    """Scramble 64-bit numbers (xor-shift and multiply rounds)."""
    x = (x ^ (x >> _U(30))) * _U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> _U(27))) * _U(0x94D049BB133111EB)
    return x ^ (x >> _U(31))


def _byte_classes() -> np.ndarray:
    """Per byte: 0 between words, else the byte as it stands in a word."""
    table = np.arange(256, dtype=np.uint8)
    table[65:91] += 32
    table[:0x30] = 0
    table[0x3A:0x41] = 0
    table[0x5B:0x61] = 0
    table[0x7B:0x80] = 0
    return table


_CLASS = _byte_classes()
_VALUE = mix(np.arange(1, 257, dtype=np.uint64) * _U(0x9E3779B97F4A7C15))
_BASE = 0x5851F42D4C957F2D


def powers(base: int, n: int) -> np.ndarray:
    """``base ** i`` modulo 2**64 for i < n."""
    out = np.full(max(n, 1), base, np.uint64)
    out[0] = 1
    return np.multiply.accumulate(out)


def text_chunks(column: pa.Array, limit: int = CHUNK_BYTES) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """``first row, bytes, offsets`` for runs of whole texts of about ``limit`` bytes; null is empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = column.fill_null("")
    if not len(column):
        return
    width = np.int64 if pa.types.is_large_string(column.type) else np.int32
    offsets = np.frombuffer(column.buffers()[1], width)[column.offset : column.offset + len(column) + 1]
    offsets = offsets.astype(np.int64)
    data = column.buffers()[2]
    data = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    first = 0
    while first < len(column):
        last = max(first + 1, int(np.searchsorted(offsets, offsets[first] + limit, "right")) - 1)
        last = min(last, len(column))
        yield first, data[offsets[first] : offsets[last]], offsets[first : last + 1] - offsets[first]
        first = last


@dataclass
class Words:
    """Words of some texts, in order: byte ranges, hashes, text numbers."""

    lowered: np.ndarray
    starts: np.ndarray
    ends: np.ndarray
    hashes: np.ndarray
    owner: np.ndarray
    counts: np.ndarray

    @property
    def firsts(self) -> np.ndarray:
        """Number of the first word of each text."""
        return np.concatenate([[0], np.cumsum(self.counts)[:-1]]).astype(np.int64)

    def join(self, a: int, b: int) -> str:
        """Words ``a`` to ``b`` (exclusive), separated by single spaces."""
        pieces = (self.lowered[s:e].tobytes() for s, e in zip(self.starts[a:b], self.ends[a:b]))
        return b" ".join(pieces).decode("utf-8", "replace")

    def shingles(self, size: int) -> tuple[np.ndarray, np.ndarray]:
        """``word number, hash`` of every run of ``size`` words within one text."""
        n = len(self.hashes) - size + 1
        if n <= 0:
            return np.zeros(0, np.int64), np.zeros(0, np.uint64)
        at = np.flatnonzero(self.owner[:n] == self.owner[size - 1 :])
        total = np.zeros(n, np.uint64)
        for i, power in enumerate(powers(0xD1342543DE82EF95, size)):
            total += self.hashes[i : i + n] * power
        return at, mix(total[at] + _U(size))


def split_words(data: np.ndarray, offsets: np.ndarray) -> Words:
    """Words of the texts that lie in ``data`` between the ``offsets``."""
    lowered = np.frombuffer(data.tobytes().translate(_CLASS.tobytes()), np.uint8)
    inside = lowered > 0
    begins = inside.copy()
    begins[1:] &= ~inside[:-1]
    finishes = inside.copy()
    finishes[:-1] &= ~inside[1:]
    edge = offsets[:-1][offsets[:-1] < len(data)]
    begins[edge] = inside[edge]
    edge = edge[edge > 0] - 1
    finishes[edge] = inside[edge]
    starts, ends = np.flatnonzero(begins), np.flatnonzero(finishes) + 1
    owner = np.searchsorted(offsets[:-1], starts, "right") - 1
    lengths = ends - starts
    if len(starts):
        firsts = np.concatenate([[0], np.cumsum(lengths)[:-1]])
        place = np.arange(firsts[-1] + lengths[-1]) - np.repeat(firsts, lengths)
        hashes = np.add.reduceat(
            _VALUE[lowered[inside]] * powers(_BASE, int(lengths.max()))[place], firsts
        )
        hashes = mix(hashes + lengths.astype(np.uint64))
    else:
        hashes = np.zeros(0, np.uint64)
    counts = np.bincount(owner, minlength=len(offsets) - 1).astype(np.int64)
    return Words(lowered, starts, ends, hashes, owner, counts)

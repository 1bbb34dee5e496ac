"""Texts as chunks with a dictionary each, so that large vocabularies are joined and never broadcast.

A chunk holds some whole texts: the distinct words, how often each occurs, and the sequence of the words as
numbers. What a word means for the whole corpus (its count, its rank) comes to a chunk by one join of the
dictionaries, whose rows are far fewer than the words, and goes back to it as arrays. So a task needs one chunk
and its own dictionary in memory, whatever the size of the vocabulary.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Bytes of text in a chunk; a longer text is a chunk of its own.
CHUNK_BYTES = 1 << 23

# Bytes of text that are split at once.
SLICE_BYTES = 1 << 20

# Code of a break (end of a piece or of a text) in a chunk's sequence; words count from 1.
BREAK = 0

_BREAK_BYTE = b"\n"


def byte_table(spaces: str, breaks: str) -> bytes:
    """Translation of bytes: A-Z to lower case, the given ones to a blank or to a line feed."""
    table = np.arange(256, dtype=np.uint8)
    table[65:91] += 32
    for signs, target in ((spaces, b" "), (breaks, _BREAK_BYTE)):
        table[np.frombuffer(signs.encode("ascii"), np.uint8)] = target[0]
    return table.tobytes()


def coded(data: np.ndarray, offsets: np.ndarray, table: bytes) -> tuple[pa.Array, np.ndarray]:
    """Distinct words of the texts between the ``offsets``, and the texts as codes with a break after each."""
    plain = data.tobytes().translate(table)
    parts, first = [], 0
    while first < len(offsets) - 1:
        # Some texts at a time, since a word is far larger as an object than as bytes.
        last = max(first + 1, int(np.searchsorted(offsets, offsets[first] + SLICE_BYTES, "right")) - 1)
        spaced = b"\n".join(plain[a:b] for a, b in zip(offsets[first:last], offsets[first + 1 : last + 1])) + b"\n"
        # Only codes and distinct words of a slice are held on to.
        parts.append(pa.array([t for t in spaced.replace(b"\n", b" \n ").split(b" ") if t], pa.large_binary()).dictionary_encode())
        first = last
    parts = pa.chunked_array(parts).unify_dictionaries().chunks
    dictionary = parts[0].dictionary
    at = dictionary.index(pa.scalar(_BREAK_BYTE, pa.large_binary())).as_py()
    codes = np.concatenate([part.indices.to_numpy() for part in parts])
    del parts
    breaks = codes == at
    # The break is 0, so words that were met before it move up by one.
    codes = codes + (codes < at)
    codes[breaks] = BREAK
    words = pa.concat_arrays([dictionary[:at], dictionary[at + 1 :]])
    return words.cast(pa.large_string()).cast(pa.string()), codes


def packed(*columns: np.ndarray) -> bytes:
    """Arrays of small numbers, each as differences in as few bytes as hold them, compressed together."""
    out = []
    for values in columns:
        plain = np.asarray(values, np.int64)
        steps = np.diff(plain, prepend=0)
        # Rising numbers are small as differences, others as they are.
        stepped = len(steps) > 0 and max(steps.max(), -steps.min()) < max(plain.max(), -plain.min())
        body = steps if stepped else plain
        del steps
        least, most = (int(body.min()), int(body.max())) if len(body) else (0, 0)
        kind = next(k for k in ("<i1", "<i2", "<i4", "<i8") if np.iinfo(k).min <= least and most <= np.iinfo(k).max)
        out.append(bytes([int(stepped), np.dtype(kind).itemsize]) + len(body).to_bytes(8, "little") + body.astype(kind).tobytes())
    return zstandard.ZstdCompressor(level=3).compress(b"".join(out))


def unpacked(data: bytes) -> list[np.ndarray]:
    """The arrays of ``packed``."""
    plain = zstandard.ZstdDecompressor().decompress(data)
    out, at = [], 0
    while at < len(plain):
        stepped, width, size = plain[at], plain[at + 1], int.from_bytes(plain[at + 2 : at + 10], "little")
        body = np.frombuffer(plain, f"<i{width}", size, at + 10).astype(np.int64)
        out.append(np.cumsum(body) if stepped else body)
        at += 10 + width * size
    return out


def look_up(rows: DataFrame, table: DataFrame, keys: Sequence[str], columns: Sequence[str]) -> DataFrame:
    """``chunk, found``: for each of the rows ``chunk, at, keys`` that ``table`` holds, its place and the columns asked for.

    ``table`` has one row for each value of ``keys``. A chunk gathers no more rows than its dictionary has words.
    """
    return (
        rows.join(table.select(*keys, *columns), list(keys))
        .groupBy("chunk")
        .agg(F.collect_list(F.struct("at", *columns)).alias("found"))
    )


def one_row(**columns: object) -> pa.RecordBatch:
    """A batch of one row; arrays become lists, bytes, numbers and texts stay."""
    arrays = []
    for value in columns.values():
        if isinstance(value, np.ndarray):
            value = pa.array(value)
        if isinstance(value, pa.Array):
            arrays.append(pa.ListArray.from_arrays(pa.array([0, len(value)], pa.int32()), value))
        else:
            arrays.append(pa.array([value]))
    return pa.RecordBatch.from_arrays(arrays, names=list(columns))


def struct_columns(rows: pa.Array, names: Sequence[str]) -> list[np.ndarray]:
    """Fields of one row's list of structs as arrays; null or an empty list gives empty ones."""
    if rows is None or len(rows) == 0:
        return [np.zeros(0, np.int64) for _ in names]
    return [rows.field(name).to_numpy(zero_copy_only=False) for name in names]

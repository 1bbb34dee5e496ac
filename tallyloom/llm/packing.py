"""Packing of token sequences by best-fit decreasing.

Documents are tokenized, closed by an end id, and cut only if they are longer than a
sequence; all pieces but the first are then full. Full pieces are sequences of
their own. The others are dealt evenly into groups of a fixed size, and each
group is packed by itself: longest first, into the open sequence with the least
room that suffices, found in a segment tree over remaining capacities. At most
one sequence in a group stays open for want of more pieces.

Ids are those of the ``tokenizers`` file. The same vocabulary as ``tiktoken`` ranks gives
equal ids several times faster and is used for all texts except those in which a
special token of the file is spelled out; these go through ``tokenizers`` itself.

A null text is empty: one piece that holds the end id alone. Repeated rows are
packed each. Extra columns are ignored.
"""

from __future__ import annotations

import base64
import json
import os
import zlib
from collections.abc import Iterator, Sequence
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyloom.operators.lineage import stored

CAPACITY = 1024
END_ID = 2
GROUP_PIECES = 50_000

_PIECES = "doc_id BIGINT, piece INT, start BIGINT, length BIGINT, ids_crc32 BIGINT"
_PACKED = _PIECES + ", sequence_id BIGINT, offset BIGINT"


class Encoder:
    """Ids of texts by a ``tokenizers`` file, with the ranks of the same vocabulary for speed."""

    def __init__(self, file: str, ranks: str, pattern: str) -> None:
        import tiktoken

        with open(file, encoding="utf-8") as f:
            added = json.load(f).get("added_tokens", [])
        self.file, self.whole = file, None
        self.special = [t["content"] for t in added]
        with open(ranks, "rb") as f:
            pairs = [line.split() for line in f if line.strip()]
        self.fast = tiktoken.Encoding(
            "ranks",
            pat_str=pattern,
            mergeable_ranks={base64.b64decode(a): int(b) for a, b in pairs},
            special_tokens={},
        )

    def encode(self, text: str) -> Sequence[int]:
        if any(s in text for s in self.special):
            if self.whole is None:
                os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
                from tokenizers import Tokenizer

                self.whole = Tokenizer.from_file(self.file)
            return self.whole.encode(text, add_special_tokens=False).ids
        return self.fast.encode_ordinary(text)


@lru_cache(maxsize=4)
def encoder(file: str, ranks: str, pattern: str) -> Encoder:
    """One encoder per worker."""
    return Encoder(file, ranks, pattern)


def piece_bounds(n: int, capacity: int = CAPACITY) -> list[tuple[int, int]]:
    """``start, length`` of the pieces of ``n`` ids; only the first may be shorter than ``capacity``."""
    head = n % capacity or min(n, capacity)
    return [(0, head)] + [(s, capacity) for s in range(head, n, capacity)]


def token_pieces(
    docs: DataFrame, file: str, ranks: str, pattern: str, capacity: int = CAPACITY, end_id: int = END_ID
) -> DataFrame:
    """``doc_id, piece, start, length, ids_crc32`` for every piece of every document."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = encoder(file, ranks, pattern)
        for batch in batches:
            rows = []
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                ids = np.array([*coder.encode(text.as_py() or ""), end_id], "<u4")
                for piece, (start, length) in enumerate(piece_bounds(len(ids), capacity)):
                    rows.append((doc_id, piece, start, length, zlib.crc32(ids[start : start + length].tobytes())))
            columns = list(zip(*rows)) or [[]] * 5
            types = (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64())
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(columns, types)],
                names=["doc_id", "piece", "start", "length", "ids_crc32"],
            )

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(cut, _PIECES)


class RoomTree:
    """Open sequences by remaining room, with a segment tree over the rooms 0 .. capacity.

    A node counts the open sequences of its range; the tightest fit is found by
    one way up and one way down the tree.
    """

    def __init__(self, capacity: int) -> None:
        self.leaves = 1 << capacity.bit_length()
        self.count = [0] * (2 * self.leaves)
        self.open: list[list[int]] = [[] for _ in range(self.leaves)]

    def _add(self, room: int, n: int) -> None:
        node = self.leaves + room
        while node:
            self.count[node] += n
            node >>= 1

    def put(self, room: int, sequence: int) -> None:
        self.open[room].append(sequence)
        self._add(room, 1)

    def take(self, least: int) -> tuple[int, int] | None:
        """Remove and return ``room, sequence`` with the least room of at least ``least``."""
        node = self.leaves + least
        if not self.count[node]:
            while node > 1 and (node & 1 or not self.count[node + 1]):
                node >>= 1
            if node <= 1:
                return None
            node += 1
            while node < self.leaves:
                node = 2 * node if self.count[2 * node] else 2 * node + 1
        room = node - self.leaves
        self._add(room, -1)
        return room, self.open[room].pop()


def best_fit_decreasing(lengths: np.ndarray, capacity: int = CAPACITY) -> tuple[np.ndarray, np.ndarray]:
    """``sequence, offset`` per piece; pieces are taken longest first, equal ones in the given order."""
    sequence, offset = np.zeros(len(lengths), np.int64), np.zeros(len(lengths), np.int64)
    tree, opened = RoomTree(capacity), 0
    for k in np.argsort(-lengths, kind="stable").tolist():
        length = int(lengths[k])
        found = tree.take(length) if length < capacity else None
        if found is None:
            room, number, opened = capacity, opened, opened + 1
        else:
            room, number = found
        sequence[k], offset[k] = number, capacity - room
        if room > length:
            tree.put(room - length, number)
    return sequence, offset


def pack_pieces(pieces: DataFrame, capacity: int = CAPACITY, group_pieces: int = GROUP_PIECES) -> DataFrame:
    """The stored pieces with ``sequence_id, offset``, packed in groups of about ``group_pieces``.

    ``pieces`` must be a table on disk: row numbers deal its rows out evenly,
    whatever their keys, and are the same if a task runs again.
    """
    groups = max(1, -(-pieces.count() // group_pieces))
    dealt = pieces.withColumn("group", F.pmod(F.monotonically_increasing_id(), F.lit(groups)))

    def pack(table: pa.Table) -> pa.Table:
        table = table.combine_chunks().sort_by(
            [("doc_id", "ascending"), ("piece", "ascending"), ("ids_crc32", "ascending")]
        )
        if not table.num_rows:
            return pa.table({f: [] for f in ()})
        sequence, offset = best_fit_decreasing(table["length"].to_numpy(), capacity)
        first = table["group"][0].as_py() << 32
        return (
            table.drop_columns(["group"])
            .append_column("sequence_id", pa.array(sequence + first))
            .append_column("offset", pa.array(offset))
        )

    return dealt.groupBy("group").applyInArrow(pack, _PACKED)


def pack_documents(
    docs: DataFrame, file: str, ranks: str, pattern: str, capacity: int = CAPACITY, end_id: int = END_ID
) -> DataFrame:
    """Pieces of all documents with their place in a sequence; see ``token_pieces``, ``pack_pieces``."""
    return pack_pieces(stored(token_pieces(docs, file, ranks, pattern, capacity, end_id)), capacity)

"""Removal of long byte strings that occur more than once in a corpus, by suffix sorting.

Every byte covered by a string of ``LENGTH`` bytes that also starts anywhere else is removed;
texts are judged as UTF-8 bytes, strings never cross texts.

The corpus is too large for one suffix array, so suffixes are first dealt into groups
that keep equal strings together. A string's *anchor* is the ``GRAM``-byte piece of it with
the least hash (ties: the last one); equal strings have equal anchors. Runs of string starts with
the same anchor occurrence form a *stretch*: the run and the bytes its strings
cover. Only anchors that occur twice or more can hold repeated strings. Equal
stretches are counted and then stand as one, so a passage copied any number of times is
sorted once. If an anchor's stretches are all equal, each of their strings is repeated; otherwise the
stretches are brought together in parts of bounded size, their suffixes are sorted in two
stages, and neighbours with a common prefix of ``LENGTH`` bytes mark the repeated
strings. An anchor with more than ``MOST_STRETCHES`` different stretches would
overfill a part; its strings are told apart by their place and hash instead, which is
exact as well (128 bits) and sums up before every shuffle.

A null text is empty. Repeated rows are documents of their own and repeat each other. Extra
columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyloom.llm.suffix_sort import repeated_starts
from tallyloom.llm.words import mix, powers, text_chunks
from tallyloom.operators.lineage import stored

LENGTH, GRAM = 400, 32
# Bytes of stretches sorted together, and different stretches of one anchor among them.
PART_BYTES, MOST_STRETCHES = 256 * 1024, 200
# Starts of a stretch that are told apart together first.
BLOCK = 32

_U = np.uint64
_BASE = 0x9E3779B97F4A7C15
_INVERSE = pow(_BASE, -1, 1 << 64)
_VALUE = mix(np.arange(1, 257, dtype=np.uint64) * _U(0xD1342543DE82EF95))
_STRETCH = "a: BIGINT, e: BIGINT, lo: BIGINT, n: INT, j: INT, times: INT"
_RANGES = "a BIGINT, e BIGINT, ranges ARRAY<STRUCT<`from`: INT, `to`: INT>>"

_cache: dict[int, np.ndarray] = {}


def _powers(base: int, n: int) -> np.ndarray:
    if len(_cache.get(base, ())) < n:
        _cache[base] = powers(base, max(n, 1 << 16))
    return _cache[base][:n]


class Hashes:
    """Hashes of substrings of a byte string."""

    def __init__(self, data: np.ndarray) -> None:
        self.sums = np.zeros(len(data) + 1, np.uint64)
        np.cumsum(_VALUE[data] * _powers(_BASE, len(data)), out=self.sums[1:])
        self.back = _powers(_INVERSE, len(data) + 1)

    def of(self, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        return mix((self.sums[ends] - self.sums[starts]) * self.back[starts] + (ends - starts).astype(np.uint64))


def _sliding_min(values: np.ndarray, width: int) -> np.ndarray:
    span, out = 1, values
    while 2 * span <= width:
        out = np.minimum(out[:-span], out[span:])
        span *= 2
    rest = width - span
    return np.minimum(out[: len(out) - rest], out[rest:]) if rest else out


def stretches(
    data: np.ndarray, offsets: np.ndarray, length: int = LENGTH, gram: int = GRAM
) -> tuple[np.ndarray, ...]:
    """``owner, anchor, equal, lo, starts, before, times`` for every stretch of some texts.

    ``anchor`` hashes the anchor, ``equal`` the whole stretch; ``lo`` is its first start in the text,
    ``starts`` the number of its starts, ``before`` the bytes from the first start to the anchor. Equal stretches one
    right after the other, as in text of a short period, are one entry with their number in ``times``.
    """
    if len(data) < length:
        return tuple(np.zeros(0, t) for t in (np.int64, np.uint64, np.uint64, *[np.int64] * 4))
    hashes = Hashes(data)
    places = np.arange(len(data) - gram + 1)
    grams = hashes.of(places, places + gram)
    ranked = (grams & _U(0xFFFFFFFF00000000)) | (_U(0xFFFFFFFF) - places.astype(np.uint64))
    least = _sliding_min(ranked, length - gram + 1)
    ends = np.repeat(offsets[1:], np.diff(offsets))[: len(least)]
    starts = np.flatnonzero(ends - places[: len(least)] >= length)
    anchors = (_U(0xFFFFFFFF) - (least[starts] & _U(0xFFFFFFFF))).astype(np.int64)
    if not len(starts):
        return stretches(data[:0], offsets[:1], length, gram)
    first = np.flatnonzero(
        np.concatenate([[True], (anchors[1:] != anchors[:-1]) | (starts[1:] != starts[:-1] + 1)])
    )
    lo, n = starts[first], np.diff(np.append(first, len(starts)))
    before = anchors[first] - lo
    equal = mix(hashes.of(lo, lo + n - 1 + length) + before.astype(np.uint64) * _U(0xC2B2AE3D27D4EB4F))
    owner = np.searchsorted(offsets, lo, "right") - 1
    anchor = grams[anchors[first]]
    goes_on = (
        (anchor[1:] == anchor[:-1]) & (equal[1:] == equal[:-1]) & (owner[1:] == owner[:-1]) & (lo[1:] == lo[:-1] + n[:-1])
    )
    leads = np.flatnonzero(np.concatenate([[True], ~goes_on]))
    times = np.diff(np.append(leads, len(lo)))
    owner, anchor, equal, lo, n, before = (x[leads] for x in (owner, anchor, equal, lo, n, before))
    return owner, anchor, equal, lo - offsets[owner], n, before, times


def _keyed(docs: DataFrame) -> DataFrame:
    text = F.coalesce(F.col("text"), F.lit(""))
    return docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.unhex(F.md5(text)).alias("node"), text.alias("text")
    )


def _all_stretches(keyed: DataFrame, length: int, gram: int) -> DataFrame:
    """``doc_id, node, found`` for the documents that have stretches."""
    entry = pa.struct(
        [("a", pa.int64()), ("e", pa.int64()), ("lo", pa.int64()), ("n", pa.int32()), ("j", pa.int32()), ("times", pa.int32())]
    )

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, data, offsets in text_chunks(batch.column(2)):
                owner, anchor, equal, lo, n, before, times = stretches(data, offsets, length, gram)
                counts = np.bincount(owner, minlength=len(offsets) - 1)
                used = np.flatnonzero(counts)
                fields = [
                    pa.array(anchor.view(np.int64)),
                    pa.array(equal.view(np.int64)),
                    pa.array(lo),
                    pa.array(n.astype(np.int32)),
                    pa.array(before.astype(np.int32)),
                    pa.array(times.astype(np.int32)),
                ]
                listed = pa.ListArray.from_arrays(
                    pa.array(np.concatenate([[0], np.cumsum(counts[used])]).astype(np.int32)),
                    pa.StructArray.from_arrays(fields, fields=list(entry)),
                )
                rows = batch.select([0, 1]).take(pa.array(first + used))
                yield pa.RecordBatch.from_arrays([*rows.columns, listed], names=["doc_id", "node", "found"])

    return keyed.mapInArrow(find, f"doc_id BIGINT, node BINARY, found ARRAY<STRUCT<{_STRETCH}>>")


def _with_bytes(keyed: DataFrame, wanted: DataFrame, length: int) -> DataFrame:
    """``a, e, c, n, j, hot, bytes`` of the stretches wanted, each cut out of one document that holds it."""
    listed = wanted.groupBy("doc_id", "node").agg(
        F.collect_list(F.struct("a", "e", "c", "lo", "n", "j", "hot")).alias("cut")
    )
    same = keyed["doc_id"].eqNullSafe(listed["doc_id"]) & (keyed["node"] == listed["node"])
    joined = keyed.join(listed, same).select("text", "cut")

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for text, wanted_here in zip(batch.column(0), batch.column(1).to_pylist()):
                data = text.as_buffer().to_pybytes()
                for w in wanted_here:
                    lo = w.pop("lo")
                    rows.append(w | {"bytes": data[lo : lo + w["n"] - 1 + length]})
            yield pa.RecordBatch.from_pylist(rows, schema=schema)

    schema = pa.schema(
        [("a", pa.int64()), ("e", pa.int64()), ("c", pa.int64()), ("n", pa.int32()), ("j", pa.int32())]
        + [("hot", pa.bool_()), ("bytes", pa.binary())]
    )
    return joined.mapInArrow(cut, "a BIGINT, e BIGINT, c BIGINT, n INT, j INT, hot BOOLEAN, bytes BINARY")


def runs_of(flags: np.ndarray) -> list[dict[str, int]]:
    """``from, to`` (inclusive) of the runs of true values."""
    edges = np.flatnonzero(np.diff(np.concatenate([[0], flags.view(np.int8), [0]]))).tolist()
    return [{"from": a, "to": b - 1} for a, b in zip(edges[::2], edges[1::2])]


_RANGES_SCHEMA = pa.schema(
    [
        ("a", pa.int64()),
        ("e", pa.int64()),
        ("ranges", pa.list_(pa.struct([("from", pa.int32()), ("to", pa.int32())]))),
    ]
)


def _sorted_ranges(pieces: DataFrame, length: int, part_bytes: int) -> DataFrame:
    """Repeated starts of the stretches, found by sorting the suffixes of each part."""
    total = pieces.agg(F.coalesce(F.sum(F.octet_length("bytes")), F.lit(0))).first()[0]
    parts = max(1, -(-total // part_bytes))

    def sort(table: pa.Table) -> pa.Table:
        held: dict[tuple[int, int], dict] = {}
        for row in table.to_pylist():
            known = held.setdefault((row["a"], row["e"]), row)
            known["c"] = max(known["c"], row["c"])
        rows = list(held.values())
        text = np.frombuffer(b"".join(r["bytes"] for r in rows), np.uint8)
        first = np.cumsum([0] + [len(r["bytes"]) for r in rows])
        starts = [np.arange(f, f + r["n"]) for f, r in zip(first, rows)]
        repeated = repeated_starts(text, np.concatenate(starts), length)
        out, at = [], 0
        for r in rows:
            flags = repeated[at : at + r["n"]] | (r["c"] > 1)
            at += r["n"]
            if flags.any():
                out.append({"a": r["a"], "e": r["e"], "ranges": runs_of(flags)})
        return pa.Table.from_pylist(out, schema=_RANGES_SCHEMA)

    part = F.pmod(F.xxhash64("a"), F.lit(parts)).alias("part")
    return pieces.groupBy(part).applyInArrow(sort, _RANGES)


def _hashed_ranges(pieces: DataFrame, length: int) -> DataFrame:
    """The same for anchors with very many different stretches, by place and hash of blocks, then of strings.

    A block is a run of up to ``BLOCK`` starts at fixed places before the anchor. Equal
    blocks are repeated as a whole. Blocks whose strings have no common part with another
    block's hold no repeated string. The strings of all others are counted one by one.
    """

    def bounds(j: int, n: int) -> Iterator[tuple[int, int, int]]:
        """``block, first, last`` start of each block of a stretch."""
        at = 0
        while at < n:
            block = (j - at) // BLOCK
            last = min(n - 1, j - block * BLOCK)
            yield block, at, last
            at = last + 1

    block_schema = pa.schema(
        [("a", pa.int64()), ("e", pa.int64()), ("c", pa.int64()), ("q", pa.int32()), ("from", pa.int32())]
        + [("to", pa.int32()), ("core", pa.int64()), ("whole", pa.int64()), ("bytes", pa.binary())]
    )

    def block_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for r in batch.to_pylist():
                data = np.frombuffer(r["bytes"], np.uint8)
                listed = list(bounds(r["j"], r["n"]))
                q, lo, hi = (np.array(x, np.int64) for x in zip(*listed))
                hashes = Hashes(data)
                # All strings of a block cover these bytes, whichever of its starts a stretch holds.
                core_lo = r["j"] - q * BLOCK
                core_hi = np.maximum(core_lo, r["j"] - q * BLOCK - (BLOCK - 1) + length)
                core = hashes.of(np.minimum(core_lo, len(data)), np.minimum(core_hi, len(data)))
                whole = mix(hashes.of(lo, hi + length) + (r["j"] - lo).astype(np.uint64))
                for k in range(len(q)):
                    out.append(
                        {"a": r["a"], "e": r["e"], "c": r["c"], "q": int(q[k]), "from": int(lo[k]), "to": int(hi[k])}
                        | {"core": int(core.view(np.int64)[k]), "whole": int(whole.view(np.int64)[k])}
                        | {"bytes": r["bytes"][lo[k] : hi[k] + length] + int(r["j"]).to_bytes(4, "little")}
                    )
            yield pa.RecordBatch.from_pylist(out, schema=block_schema)

    blocks = stored(
        pieces.dropDuplicates(["a", "e"]).mapInArrow(
            block_rows,
            "a BIGINT, e BIGINT, c BIGINT, q INT, `from` INT, `to` INT, core BIGINT, whole BIGINT, bytes BINARY",
        )
    )
    cores = blocks.groupBy("a", "q", "core").agg(F.sum("c").alias("n_core")).filter("n_core > 1")
    wholes = blocks.groupBy("a", "q", "whole").agg(F.sum("c").alias("n_whole"), F.min("e").alias("least"))
    known = stored(blocks.join(cores, ["a", "q", "core"]).join(wholes, ["a", "q", "whole"]))
    repeated = known.filter("n_whole > 1").select("a", "e", "from", "to")

    string_schema = pa.schema([("a", pa.int64()), ("e", pa.int64()), ("j", pa.int32()), ("at", pa.int32()), ("h", pa.int64()), ("c", pa.int64())])

    def string_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for r in batch.to_pylist():
                data, j = np.frombuffer(r["bytes"], np.uint8)[:-4], int.from_bytes(r["bytes"][-4:], "little")
                at = np.arange(r["to"] - r["from"] + 1)
                h = Hashes(data).of(at, at + length).view(np.int64)
                for k in at.tolist():
                    place = r["from"] + k
                    out.append({"a": r["a"], "e": r["e"], "j": j - place, "at": place, "h": int(h[k]), "c": r["n_whole"]})
            yield pa.RecordBatch.from_pylist(out, schema=string_schema)

    single = known.filter("n_whole = 1 or e = least").select("a", "e", "from", "to", "n_whole", "bytes")
    strings = stored(single.mapInArrow(string_rows, "a BIGINT, e BIGINT, j INT, at INT, h BIGINT, c BIGINT"))
    twice = strings.groupBy("a", "j", "h").agg(F.sum("c").alias("n")).filter("n > 1")
    more = strings.join(twice, ["a", "j", "h"]).select("a", "e", F.col("at").alias("from"), F.col("at").alias("to"))
    listed = repeated.unionByName(more).groupBy("a", "e").agg(F.collect_list(F.struct("from", "to")).alias("ranges"))

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for r in batch.to_pylist():
                flags = np.zeros(max(x["to"] for x in r["ranges"]) + 1, bool)
                for x in r["ranges"]:
                    flags[x["from"] : x["to"] + 1] = True
                out.append(r | {"ranges": runs_of(flags)})
            yield pa.RecordBatch.from_pylist(out, schema=_RANGES_SCHEMA)

    return listed.mapInArrow(merge, _RANGES)


def repeated_spans(
    docs: DataFrame,
    length: int = LENGTH,
    gram: int = GRAM,
    part_bytes: int = PART_BYTES,
    most_stretches: int = MOST_STRETCHES,
) -> DataFrame:
    """Documents with repeated strings: ``doc_id, node, spans``, the spans (``from, to`` in bytes, end exclusive) unmerged.

    ``node`` is the MD5 digest of the text, which tells rows with one id apart.
    """
    keyed = _keyed(docs)
    found = stored(_all_stretches(keyed, length, gram)).select("doc_id", "node", F.inline("found"))
    repeated = found.groupBy("a").agg(F.sum("times").alias("times")).filter("times > 1")
    rows = stored(found.join(repeated.select("a"), "a"))
    place = F.struct("doc_id", "node", "lo")
    equal = stored(
        rows.groupBy("a", "e").agg(
            F.sum("times").alias("c"), F.min(place).alias("place"), F.first("n").alias("n"), F.first("j").alias("j")
        )
    )
    kinds = equal.groupBy("a").agg(F.count(F.lit(1)).alias("kinds"))
    judged = equal.join(kinds, "a")
    alone = judged.filter("kinds = 1").select(
        "a",
        "e",
        F.array(F.struct(F.lit(0).alias("from"), (F.col("n") - 1).alias("to"))).alias("ranges"),
    )
    wanted = judged.filter("kinds > 1").select(
        "place.doc_id", "place.node", "place.lo", "a", "e", "c", "n", "j", (F.col("kinds") > most_stretches).alias("hot")
    )
    pieces = stored(_with_bytes(keyed, wanted, length))
    ranges = (
        alone.unionByName(_sorted_ranges(pieces.filter("not hot"), length, part_bytes))
        .unionByName(_hashed_ranges(pieces.filter("hot"), length))
    )
    # Stretches that follow their like are repeated as they stand.
    several = rows.filter("times > 1").select("doc_id", "node", "lo", F.lit(0).alias("from"), F.expr("n * times - 1").alias("to"))
    single = rows.filter("times = 1").join(ranges, ["a", "e"]).select("doc_id", "node", "lo", F.inline("ranges"))
    return several.unionByName(single).groupBy("doc_id", "node").agg(
        F.collect_list(
            F.struct((F.col("lo") + F.col("from")).alias("from"), (F.col("lo") + F.col("to") + length).alias("to"))
        ).alias("spans")
    )


def cut_text(data: bytes, spans: list[dict[str, int]]) -> tuple[bytes, int]:
    """The bytes outside the spans, and the number of maximal removed runs."""
    kept, at, n = [], 0, 0
    end = -1
    for s in sorted(spans, key=lambda x: x["from"]):
        if s["from"] > end:
            n += 1
            kept.append(data[at : s["from"]])
        end = max(end, s["to"])
        at = end
    return b"".join([*kept, data[at:]]), n


def remove_repeats(docs: DataFrame, spans: DataFrame) -> DataFrame:
    """``doc_id, n_bytes, n_removed, n_spans, kept_sha256`` for every document, given its spans."""
    keyed = _keyed(docs)
    same = keyed["doc_id"].eqNullSafe(spans["doc_id"]) & (keyed["node"] == spans["node"])
    joined = keyed.join(spans, same, "left").select(keyed["doc_id"], "text", "spans")

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for doc_id, text, cuts in zip(batch.column(0).to_pylist(), batch.column(1), batch.column(2).to_pylist()):
                data = text.as_buffer().to_pybytes()
                kept, n = cut_text(data, cuts) if cuts else (data, 0)
                rows.append((doc_id, len(data), len(data) - len(kept), n, hashlib.sha256(kept).hexdigest()))
            columns = list(zip(*rows)) or [[]] * 5
            types = (pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.string())
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(columns, types)],
                names=["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"],
            )

    return joined.mapInArrow(cut, "doc_id BIGINT, n_bytes BIGINT, n_removed BIGINT, n_spans BIGINT, kept_sha256 STRING")

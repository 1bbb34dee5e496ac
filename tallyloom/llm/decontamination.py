"""Benchmark decontamination by a prefix-filtered set join.

A benchmark item is cut into windows of ``WINDOW`` consecutive words (an item of
fewer words, but not none, is one window). A window is the set of its word
shingles at their places. Containment is exact, so every shingle of a window must
occur, and its necessary prefix is a single token: the shingle that is rarest in
the whole corpus. Only documents that hold the prefix token of a window are joined with
it; the place of the token fixes where the window would start (positional bound)
and end (length bound), and the words there are compared one by one.

Nulls: a null text has no words; a null ``item_id`` hits words but is not counted.
Texts without words have no windows. Repeated rows of ``docs`` each get their row.
Extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyloom.llm.bitmap import build_bitmap, may_contain
from tallyloom.llm.words import split_words, text_chunks
from tallyloom.operators.lineage import settled

WINDOW = 13
SHINGLE = 5
# Shares into which the rows of one prefix token are dealt, whatever their number.
SHARES = 32

_WINDOW_ROWS = "item_id STRING, window STRING, length INT, tokens ARRAY<STRUCT<token: BIGINT, offset: INT>>"
_COUNTS = "token BIGINT, n BIGINT"
_SCANNED = (
    "doc_id BIGINT, text_key STRING, n_words BIGINT, "
    "found ARRAY<STRUCT<token: BIGINT, pos: INT, first: INT, context: STRING>>"
)


def item_windows(items: DataFrame, window: int = WINDOW, shingle: int = SHINGLE) -> DataFrame:
    """Distinct windows: ``window, length, items, tokens`` with the items' ids and the window's shingles."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: list[tuple] = []
            ids = batch.column(0).to_pylist()
            for first, data, offsets in text_chunks(batch.column(1)):
                words = split_words(data, offsets)
                places: dict[int, dict[int, int]] = {}
                for k, (start, n) in enumerate(zip(words.firsts, words.counts)):
                    length = min(window, int(n))
                    size = min(shingle, length)
                    if not size:
                        continue
                    if size not in places:
                        at, tokens = words.shingles(size)
                        places[size] = dict(zip(at.tolist(), tokens.view(np.int64).tolist()))
                    place = places[size]
                    for s in range(int(start), int(start) + int(n) - length + 1):
                        named = [{"token": place[s + i], "offset": i} for i in range(length - size + 1)]
                        out.append((ids[first + k], words.join(s, s + length), length, named))
            yield pa.RecordBatch.from_pylist(
                [dict(zip(("item_id", "window", "length", "tokens"), r)) for r in out], schema=_schema_of_windows()
            )

    rows = items.select(F.col("item_id").cast("string").alias("item_id"), F.col("text").cast("string").alias("text"))
    return (
        rows.mapInArrow(cut, _WINDOW_ROWS)
        .groupBy("window", "length")
        .agg(F.collect_set("item_id").alias("items"), F.first("tokens").alias("tokens"))
    )


def _schema_of_windows() -> pa.Schema:
    token = pa.struct([("token", pa.int64()), ("offset", pa.int32())])
    return pa.schema(
        [("item_id", pa.string()), ("window", pa.string()), ("length", pa.int32()), ("tokens", pa.list_(token))]
    )


def token_counts(docs: DataFrame, bitmap: np.ndarray, sizes: list[int]) -> DataFrame:
    """Occurrences in all documents of the shingles that pass the bitmap: ``token, n``."""
    shared = docs.sparkSession.sparkContext.broadcast(bitmap)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [np.zeros(0, np.uint64)]
            for _, data, offsets in text_chunks(batch.column(0)):
                words = split_words(data, offsets)
                for size in sizes:
                    tokens = words.shingles(size)[1]
                    found.append(tokens[may_contain(shared.value, tokens)])
            tokens, n = np.unique(np.concatenate(found), return_counts=True)
            yield pa.RecordBatch.from_arrays(
                [pa.array(tokens.view(np.int64)), pa.array(n.astype(np.int64))], names=["token", "n"]
            )

    return docs.select("text").mapInArrow(count, _COUNTS).groupBy("token").agg(F.sum("n").alias("n"))


def prefix_windows(windows: DataFrame, counts: DataFrame) -> DataFrame:
    """Each window with its rarest shingle (ties: the first): ``token, offset, window, length, items``."""
    listed = windows.select("window", "length", F.explode("tokens").alias("t"))
    listed = listed.select("window", "length", "t.token", "t.offset").join(counts, "token", "left")
    rarest = F.min(F.struct(F.coalesce("n", F.lit(0)).alias("n"), "offset", "token"))
    chosen = listed.groupBy("window", "length").agg(rarest.alias("r"))
    return windows.select("window", "items").join(
        chosen.select("window", "length", "r.token", "r.offset"), "window"
    )


def _scan(docs: DataFrame, bitmap: np.ndarray, sizes: list[int], window: int) -> DataFrame:
    """Every document with its number of words and the prefix tokens that may be in it."""
    shared = docs.sparkSession.sparkContext.broadcast(bitmap)
    entry = pa.struct(
        [("token", pa.int64()), ("pos", pa.int32()), ("first", pa.int32()), ("context", pa.string())]
    )

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n_words = np.zeros(batch.num_rows, np.int64)
            found: list[list[dict]] = [[] for _ in range(batch.num_rows)]
            for first, data, offsets in text_chunks(batch.column(2)):
                words = split_words(data, offsets)
                n_words[first : first + len(words.counts)] = words.counts
                starts = words.firsts
                for size in sizes:
                    at, tokens = words.shingles(size)
                    hit = may_contain(shared.value, tokens)
                    for w, token in zip(at[hit].tolist(), tokens[hit].view(np.int64).tolist()):
                        k = int(words.owner[w])
                        start, n = int(starts[k]), int(words.counts[k])
                        a, b = max(start, w - window + 1), min(start + n, w + window)
                        found[first + k].append(
                            {"token": token, "pos": w - start, "first": a - start, "context": words.join(a, b)}
                        )
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(n_words), pa.array(found, pa.list_(entry))],
                names=["doc_id", "text_key", "n_words", "found"],
            )

    return docs.select("doc_id", "text_key", "text").mapInArrow(scan, _SCANNED)


def _union_length(spans: Column) -> Column:
    """Number of places covered by sorted ``from, to`` spans that may overlap."""
    none = F.struct(F.lit(0).cast("long").alias("n"), F.lit(0).cast("long").alias("end"))

    def add(acc: Column, s: Column) -> Column:
        new = F.greatest(F.lit(0).cast("long"), s["to"] - F.greatest(s["from"], acc["end"]))
        return F.struct((acc["n"] + new).alias("n"), F.greatest(acc["end"], s["to"]).alias("end"))

    return F.aggregate(spans, none, add, lambda acc: acc["n"])


def occurrences(
    docs: DataFrame, items: DataFrame, window: int = WINDOW, shingle: int = SHINGLE
) -> tuple[DataFrame, DataFrame]:
    """All documents (``doc_id, text_key, n_words``) and the windows in them.

    The second frame has one row per window and place: ``doc_id, text_key, from,
    to`` (word numbers, end exclusive), ``window, items``.
    """
    keyed = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.md5(F.coalesce("text", F.lit(""))).alias("text_key"),
        F.coalesce(F.col("text"), F.lit("")).alias("text"),
    )
    windows = settled(item_windows(items, window, shingle))
    tokens = windows.select("length", F.explode("tokens").alias("t"))
    sizes = sorted({min(shingle, r["length"]) for r in windows.select("length").distinct().collect()})
    every = build_bitmap(tokens.select("t.token"), "token", tokens.count())
    prefixes = settled(prefix_windows(windows, token_counts(keyed, every, sizes)))
    chosen = build_bitmap(prefixes, "token", prefixes.count())
    scanned = settled(_scan(keyed, chosen, sizes, window))

    share = F.pmod(F.xxhash64("doc_id", "text_key"), F.lit(SHARES)).cast("int")
    placed = scanned.select(
        "doc_id", "text_key", "n_words", share.alias("share"), F.inline("found")
    )
    dealt = prefixes.withColumn("share", F.explode(F.sequence(F.lit(0), F.lit(SHARES - 1))))
    start = F.col("pos") - F.col("offset")
    there = F.slice(F.split("context", " "), start - F.col("first") + 1, F.col("length"))
    hits = (
        placed.join(dealt, ["token", "share"])
        .filter((start >= 0) & (start + F.col("length") <= F.col("n_words")))
        .filter(F.array_join(there, " ") == F.col("window"))
        .select(
            "doc_id",
            "text_key",
            start.cast("long").alias("from"),
            (start + F.col("length")).cast("long").alias("to"),
            "window",
            "items",
        )
    )
    return scanned.select("doc_id", "text_key", "n_words"), hits


def decontaminate(
    docs: DataFrame, items: DataFrame, window: int = WINDOW, shingle: int = SHINGLE
) -> DataFrame:
    """One row per document: ``doc_id, text_key, n_words, n_hit, items, contaminated``.

    ``n_hit`` counts words inside any occurrence of a window, ``items`` lists the
    ids of the items with occurring windows, sorted as text. A document is
    contaminated if a twentieth of its words or more are hit.
    """
    every, hits = occurrences(docs, items, window, shingle)
    summed = hits.groupBy("doc_id", "text_key").agg(
        _union_length(F.array_sort(F.collect_set(F.struct("from", "to")))).alias("n_hit"),
        F.array_sort(F.array_distinct(F.flatten(F.collect_set("items")))).alias("items"),
    )
    same = every["doc_id"].eqNullSafe(summed["doc_id"]) & (every["text_key"] == summed["text_key"])
    n_hit = F.coalesce(summed["n_hit"], F.lit(0).cast("long"))
    return every.join(summed, same, "left").select(
        every["doc_id"],
        every["text_key"],
        every["n_words"],
        n_hit.alias("n_hit"),
        F.coalesce(summed["items"], F.array().cast("array<string>")).alias("items"),
        ((n_hit > 0) & (n_hit * 20 >= every["n_words"])).alias("contaminated"),
    )


def keep_clean(docs: DataFrame, judged: DataFrame) -> DataFrame:
    """The documents that are not contaminated, columns as given.

    Only ids and text digests of contaminated documents are joined; null ids are matched too.
    """
    bad = judged.filter("contaminated").select("doc_id", F.col("text_key").alias("__bad_key")).distinct()
    keyed = docs.withColumn("__key", F.md5(F.coalesce("text", F.lit(""))))
    same = keyed["doc_id"].eqNullSafe(bad["doc_id"]) & (keyed["__key"] == bad["__bad_key"])
    return keyed.join(bad, same, "left_anti").select(docs.columns)

"""Phrases whose words occur together more often than chance, by direct-address tiles of ranked ids.

Words that occur often enough get ids in order of their frequency. Two neighbouring ids are a cell of a square
table, which is cut into tiles: a tile that holds many occurrences is counted in place with a dense ``bincount``,
the others as sorted coordinates. Frequent pairs are ranked anew, and a frequent phrase together with its next
word is the pair of the next level, so the same counting gives phrases of three, four and five words.

Texts stay in chunks (see ``chunk_words``). Per level a task counts the pairs of one chunk and deals them by hash
into buckets; Spark brings the pairs of a bucket together from all chunks, as one packed row from each. A
task adds up one bucket of bounded size and answers each chunk with the places of its frequent pairs. A chunk thus knows
the counts of every part of a frequent phrase it holds; one chunk for each phrase, the one of least number, reports it with
its parts, so neither parts nor texts are looked up again, and no pair is ever a row of its own. Chunks are stored in buckets
of their numbers, so what comes back to them is shuffled and they are not.

Rows: a null text has no words, a null language is ``und``. Repeated rows count as often as they stand there. An
empty table gives no rows. Other columns are not read. A document of any length is one chunk at most.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from xxhash import xxh3_64_intdigest

from tallyloom.llm.bitmap import build_bitmap, may_contain
from tallyloom.llm.chunk_words import BREAK, CHUNK_BYTES, byte_table, coded, look_up, one_row, packed, struct_columns, unpacked
from tallyloom.llm.words import mix, text_chunks
from tallyloom.operators.lineage import discard, settled, stored, stored_by_key

# A phrase is a candidate if it occurs so often, and has so many words at most.
LEAST, LONGEST = 100, 5

# Phrases reported per language.
PLACES = 2000

# Rows and columns of a tile; a tile is counted densely if an occurrence comes to so many cells.
TILE, CELLS_EACH = 256, 8

# Places of possible phrases for each bucket of pairs, which bounds what a task adds up at once.
BUCKET_PLACES = 1 << 20

# The most frequent words that every task holds, and the most bytes of one; all other words are joined.
HEAD_WORDS, HEAD_BYTES = 1 << 16, 64

# Signs that end a piece, and signs between words.
PIECE_ENDS, BETWEEN = ".,;:!?\n\x0b\x0c\r", " \t"

_CHUNK = "chunk LONG, lang STRING, words ARRAY<STRING>, counts ARRAY<LONG>, codes BINARY"
_REPORTS = "ARRAY<STRUCT<phrase: STRING, a: LONG, firsts: ARRAY<LONG>, rests: ARRAY<LONG>>>"
_STATE = f"chunk LONG, lang STRING, words ARRAY<STRING>, codes BINARY, levels ARRAY<BINARY>, places LONG, reports {_REPORTS}"
_THIN = "chunk LONG, lang STRING, words ARRAY<STRING>, ids ARRAY<LONG>, f ARRAY<LONG>, codes BINARY, open ARRAY<STRUCT<at: INT, word: STRING>>"
_PAIRS = "bucket LONG, chunk LONG, pairs BINARY"
_MARKS = "bucket LONG, chunk LONG, marks BINARY"
_REPORT_TYPE = pa.struct(
    [("phrase", pa.string()), ("a", pa.int64()), ("firsts", pa.list_(pa.int64())), ("rests", pa.list_(pa.int64()))]
)


def chunks_of(docs: DataFrame, chunk_bytes: int = CHUNK_BYTES) -> DataFrame:
    """Pieces of all texts as coded chunks of one language each."""
    table = byte_table(BETWEEN, PIECE_ENDS)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId() << 33
        for batch in batches:
            langs = batch.column(0).fill_null("und")
            for lang in langs.unique().to_pylist():
                texts = batch.column(1).filter(pc.equal(langs, lang))
                for _, data, offsets in text_chunks(texts, chunk_bytes):
                    words, codes = coded(data, offsets, table)
                    counts = np.bincount(codes, minlength=len(words) + 1)[1:]
                    yield one_row(chunk=number, lang=lang, words=words, counts=counts, codes=packed(codes))
                    number += 1

    return docs.select(F.col("lang").cast("string"), "text").mapInArrow(cut, _CHUNK)


def ranked(found: DataFrame, *order: Column) -> DataFrame:
    """The rows, written out, with an ``id`` that rises in the given order."""
    return stored(found.orderBy(*order).withColumn("id", F.monotonically_increasing_id()))


def count_pairs(left: np.ndarray, right: np.ndarray, n_left: int, n_right: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct pairs as ``left * n_right + right``, with their counts, tile by tile.

    Ids are ranks below ``n_left`` and ``n_right``, the most frequent first, so the first tiles are the full ones.
    """
    across = -(-n_right // TILE)
    tile = (left // TILE) * across + right // TILE
    tiles, occurrences = np.unique(tile, return_counts=True)
    full = tiles[occurrences * CELLS_EACH >= TILE * TILE]
    keys, counts = [], []
    for one in full:
        here = tile == one
        cells = np.bincount((left[here] % TILE) * TILE + right[here] % TILE, minlength=TILE * TILE)
        used = np.flatnonzero(cells)
        keys.append((one // across * TILE + used // TILE) * n_right + one % across * TILE + used % TILE)
        counts.append(cells[used])
    sparse = ~np.isin(tile, full)
    coordinates = np.sort(left[sparse] * n_right + right[sparse])
    first = np.flatnonzero(np.concatenate([[True], coordinates[1:] != coordinates[:-1]])[: len(coordinates)])
    keys.append(coordinates[first])
    counts.append(np.diff(np.append(first, len(coordinates))))
    return np.concatenate(keys), np.concatenate(counts)


class _Levels:
    """A chunk's sequence with, for each number of words, the frequent phrase that starts at each place.

    ``rank[m][i]`` is the rank within the chunk of the phrase of ``m + 1`` words at place ``i``, -1 if there is none;
    ``ids``, ``f`` and ``mine`` have, by rank, its id, its count, and whether this chunk reports it.
    """

    def __init__(self, codes: np.ndarray, ids: np.ndarray, f: np.ndarray) -> None:
        self.rank, self.ids, self.f, self.mine = [codes - 1], [ids], [f], [np.zeros(len(ids), bool)]
        self.keys: list[np.ndarray] = []

    @staticmethod
    def of_row(codes: bytes, levels: list[bytes]) -> _Levels:
        found = _Levels(unpacked(codes)[0], *unpacked(levels[0]))
        for level in levels[1:]:
            found.add(*unpacked(level))
        return found

    def add(self, key: np.ndarray, number: np.ndarray, f: np.ndarray, mine: np.ndarray) -> None:
        """Take in the frequent phrases of one more word, in order of their ids, by the keys they have here."""
        at, here = self.pairs()
        rank = np.full(len(self.rank[0]), -1, np.int64)
        if len(key):
            by_key = np.argsort(key)
            slot = np.minimum(np.searchsorted(key, here, sorter=by_key), len(key) - 1)
            hit = key[by_key[slot]] == here
            rank[at[hit]] = by_key[slot[hit]]
        self.rank.append(rank)
        self.keys.append(key)
        self.ids.append(number)
        self.f.append(f)
        self.mine.append(mine.astype(bool))

    def next_word(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Places, phrase and next word, where a phrase of one more word may be frequent.

        It may be if both its first and its last part without one word are frequent.
        """
        last, words = self.rank[-1], self.rank[0]
        size = len(self.rank)
        n = max(len(words) - size, 0)
        at = np.flatnonzero((last[:n] >= 0) & (words[size : size + n] >= 0) & (last[1 : n + 1] >= 0))
        return at, last[at], words[at + size]

    def pairs(self) -> tuple[np.ndarray, np.ndarray]:
        """Places and keys of the possible phrases of one more word."""
        at, left, right = self.next_word()
        return at, left * len(self.ids[0]) + right

    def dealt_pairs(self, buckets: int) -> tuple[np.ndarray, ...]:
        """``bounds, keys, left, right, counts`` of the possible phrases of one more word, bucket after bucket.

        Bucket ``b`` has the entries from ``bounds[b]`` to ``bounds[b + 1]``, always in the same order.
        """
        _, left, right = self.next_word()
        width = max(len(self.ids[0]), 1)
        keys, counts = count_pairs(left, right, len(self.ids[-1]), width)
        left, right = self.ids[-1][keys // width], self.ids[0][keys % width]
        bucket = (_token(left, right) % np.uint64(buckets)).astype(np.int64)
        order = np.lexsort((keys, bucket))
        bounds = np.concatenate([[0], np.cumsum(np.bincount(bucket, minlength=buckets))])
        return bounds, keys[order], left[order], right[order], counts[order]

    def count(self, size: int) -> np.ndarray:
        """Occurrences in the corpus of the phrase of ``size`` words at each place, 0 if it is not frequent."""
        rank = self.rank[size - 1]
        return np.where(rank >= 0, np.append(self.f[size - 1], 0)[rank], 0)


    def covered(self) -> np.ndarray:
        """Places that belong to a frequent phrase of the longest size so far."""
        starts = (self.rank[-1] >= 0).astype(np.int64)
        reach = np.cumsum(starts)
        reach[len(self.rank) :] -= reach[: -len(self.rank)].copy()
        return reach > 0

    def pruned(self) -> tuple[np.ndarray, _Levels]:
        """Ranks of the words that are left, and the levels without the places that are not ``covered``."""
        kept = self.covered()
        breaks = ~kept
        kept[1:] |= kept[:-1]
        kept = np.flatnonzero(kept)
        words = np.where(breaks[kept], -1, self.rank[0][kept])
        used = np.unique(words[words >= 0])
        codes = np.where(words >= 0, np.searchsorted(used, words) + 1, BREAK)
        new = _Levels(codes, self.ids[0][used], self.f[0][used])
        for rank, ids, f, mine in zip(self.rank[1:], self.ids[1:], self.f[1:], self.mine[1:]):
            at, keys = new.pairs()
            old = rank[kept[at]]
            found, first = np.unique(old, return_index=True)
            found, first = found[found >= 0], first[found >= 0]
            new.add(keys[first], ids[found], f[found], mine[found])
        return used, new

    def level_bytes(self) -> list[bytes]:
        """The levels as ``of_row`` reads them."""
        higher = zip(self.keys, self.ids[1:], self.f[1:], self.mine[1:])
        return [packed(self.ids[0], self.f[0]), *(packed(*columns) for columns in higher)]

    def reports(self, words: np.ndarray, size: int, longer: np.ndarray) -> list[dict]:
        """Phrases of ``size`` words that this chunk reports, but for those that a phrase of one more word stands for.

        A phrase has the count of a longer one around it only if every occurrence lies in one of the longer, so any
        place where it occurs tells, and one more word is enough to look at.
        """
        counts = [self.count(k) for k in range(1, size + 1)]
        ranks, first = np.unique(self.rank[size - 1], return_index=True)
        at = first[(ranks >= 0) & np.append(self.mine[size - 1], False)[ranks]]
        a = counts[-1]
        before = np.where(at > 0, longer[at - 1], 0)
        at = at[(longer[at] < a[at]) & (before < a[at])]
        return [
            {
                "phrase": " ".join(words[self.rank[0][i : i + size]]),
                "a": int(a[i]),
                "firsts": [int(counts[k - 1][i]) for k in range(1, size)],
                "rests": [int(counts[size - k - 1][i + k]) for k in range(1, size)],
            }
            for i in at.tolist()
        ]


def _rows(batch: pa.RecordBatch) -> Iterator[tuple[dict, _Levels]]:
    """Rows of a batch of chunks with their levels."""
    for i in range(batch.num_rows):
        row = {name: batch.column(name)[i] for name in batch.schema.names}
        yield row, _Levels.of_row(row["codes"].as_py(), row["levels"].as_py())


def _hashes(langs: list, words: list) -> np.ndarray:
    return np.array([xxh3_64_intdigest(f"{lang}\t{word}") for lang, word in zip(langs, words)], np.uint64)


def _tokens(table: DataFrame, *columns: str, token: Callable[..., np.ndarray]) -> DataFrame:
    """``token`` of each row, as a signed number."""

    def tokens(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.RecordBatch.from_pydict({"token": token(*batch.columns).view(np.int64)})

    return table.select(*columns).mapInArrow(tokens, "token LONG")


def _start(chunks: DataFrame, vocabulary: DataFrame) -> DataFrame:
    """Chunks in which only frequent words are left, coded by rank; others are breaks.

    The head of the vocabulary, bounded in words and bytes, is known to every task; what may be in the rest by a
    bitmap of bounded size is joined. The chunks given are discarded.
    """
    context = chunks.sparkSession.sparkContext
    short = F.octet_length("word") + F.octet_length("lang") <= HEAD_BYTES
    head = vocabulary.filter(short).orderBy("id").limit(HEAD_WORDS).toArrow()
    last = max(head.column("id").to_pylist(), default=-1)
    rest = vocabulary.filter(~short | (F.col("id") > last))
    bits = build_bitmap(_tokens(rest, "lang", "word", token=lambda a, b: _hashes(a.to_pylist(), b.to_pylist())), "token", rest.count())
    known = context.broadcast({lang: head.filter(pc.equal(head["lang"], lang)).combine_chunks() for lang in head["lang"].unique().to_pylist()})
    shared = context.broadcast(bits)

    def thin(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Only words that are or may be frequent stay; those of the head get id and count, others -1 at first."""
        for batch in batches:
            for i in range(batch.num_rows):
                lang, words = batch.column("lang")[i].as_py(), batch.column("words")[i].values
                number, f = np.full(len(words), -1, np.int64), np.full(len(words), -1, np.int64)
                if lang in known.value:
                    table = known.value[lang]
                    place = pc.index_in(words, value_set=table["word"].combine_chunks())
                    hit = place.is_valid().to_numpy(zero_copy_only=False)
                    place = place.drop_null()
                    number[hit] = table["id"].combine_chunks().take(place).to_numpy()
                    f[hit] = table["f"].combine_chunks().take(place).to_numpy()
                kept = number >= 0
                unknown = np.flatnonzero(~kept)
                tokens = _hashes([lang] * len(unknown), words.take(pa.array(unknown)).to_pylist())
                kept[unknown] = may_contain(shared.value, tokens)
                used = np.flatnonzero(kept)
                code = np.zeros(len(words) + 1, np.int64)
                code[used + 1] = np.arange(1, len(used) + 1)
                codes = code[unpacked(batch.column("codes")[i].as_py())[0]]
                stay = codes != BREAK
                stay[1:] |= codes[:-1] != BREAK
                at = np.flatnonzero(number[used] < 0)
                yield one_row(
                    chunk=batch.column("chunk")[i].as_py(), lang=lang, words=words.take(pa.array(used)),
                    ids=number[used], f=f[used], codes=packed(codes[stay]),
                    open=pa.StructArray.from_arrays([pa.array(at, pa.int32()), words.take(pa.array(used[at]))], names=["at", "word"]),
                )

    def recode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                at, more, more_f = struct_columns(batch.column("found")[i].values, ("at", "id", "f"))
                number, f = (batch.column(name)[i].values.to_numpy().copy() for name in ("ids", "f"))
                number[at.astype(np.int64)], f[at.astype(np.int64)] = more, more_f
                words, used = batch.column("words")[i].values, np.flatnonzero(number >= 0)
                used = used[np.argsort(number[used])]
                rank = np.zeros(len(words) + 1, np.int64)
                rank[used + 1] = np.arange(1, len(used) + 1)
                codes = rank[unpacked(batch.column("codes")[i].as_py())[0]]
                levels = _Levels(codes, number[used], f[used])
                yield one_row(
                    chunk=batch.column("chunk")[i].as_py(),
                    lang=batch.column("lang")[i].as_py(),
                    words=words.take(pa.array(used)),
                    codes=packed(codes),
                    levels=pa.array(levels.level_bytes(), pa.binary()),
                    places=len(levels.next_word()[0]),
                    reports=pa.array([], _REPORT_TYPE),
                )

    thinned = stored_by_key(chunks.drop("counts").mapInArrow(thin, _THIN), "chunk")
    discard(chunks)
    found = look_up(thinned.select("chunk", "lang", F.inline("open")), rest, ["lang", "word"], ["id", "f"])
    state = stored_by_key(thinned.drop("open").join(found, "chunk", "left").mapInArrow(recode, _STATE), "chunk")
    shared.destroy()
    known.destroy()
    discard(thinned)
    return state


def _token(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    return mix(mix(left.astype(np.uint64)) + right.astype(np.uint64))


def _pairs(state: DataFrame, buckets: int) -> DataFrame:
    """Possible phrases of one more word with their counts in a chunk, one packed row for each bucket and chunk."""

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row, levels in _rows(batch):
                bounds, _, left, right, counts = levels.dealt_pairs(buckets)
                used = np.flatnonzero(np.diff(bounds))
                cuts = [slice(bounds[b], bounds[b + 1]) for b in used.tolist()]
                pairs = [packed(left[cut], right[cut], counts[cut]) for cut in cuts]
                chunk = np.full(len(used), row["chunk"].as_py(), np.int64)
                yield pa.RecordBatch.from_pydict({"bucket": used, "chunk": chunk, "pairs": pa.array(pairs, pa.binary())})

    return state.mapInArrow(deal, _PAIRS)


def frequent_entries(
    left: np.ndarray, right: np.ndarray, n: np.ndarray, chunk: np.ndarray, least: int
) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """``entries, rank, f, mine`` of those entries whose pair occurs ``least`` times in all.

    ``rank`` numbers the pairs, the most frequent first; ``mine`` marks a pair's entry of the least chunk.
    """
    order = np.lexsort((chunk, right, left))
    left, right = left[order], right[order]
    new = np.concatenate([[True], (left[1:] != left[:-1]) | (right[1:] != right[:-1])])[: len(order)]
    first = np.flatnonzero(new)
    f = np.add.reduceat(n[order], first) if len(first) else np.zeros(0, np.int64)
    often = np.flatnonzero(f >= least)
    rank = np.full(len(f), -1, np.int64)
    rank[often[np.argsort(-f[often], kind="stable")]] = np.arange(len(often))
    pair = np.cumsum(new) - 1
    stay = np.flatnonzero(rank[pair] >= 0)
    return order[stay], rank[pair[stay]], f[pair[stay]], new[stay]


def _frequent(pairs: DataFrame, least: int, buckets: int) -> DataFrame:
    """For each bucket and chunk its frequent pairs: place among the entries, id, count, and whether the chunk reports it.

    Ids are ranks within a bucket with the buckets side by side, so they rise as counts fall, as near as hashing makes
    buckets alike.
    """

    def add_up(table: pa.Table) -> pa.Table:
        bucket = table["bucket"][0].as_py()
        chunks = table["chunk"].to_numpy()
        parts = [unpacked(row.as_py()) for row in table["pairs"]]
        sizes = np.array([len(part[0]) for part in parts])
        left, right, n = (np.concatenate(column) for column in zip(*parts))
        del parts
        owner = np.repeat(np.arange(len(chunks)), sizes)
        place = np.arange(len(owner)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
        entries, rank, f, mine = frequent_entries(left, right, n, chunks[owner], least)
        back = np.argsort(entries)
        entries, rank, f, mine = (x[back] for x in (entries, rank, f, mine))
        bounds = np.searchsorted(owner[entries], np.arange(len(chunks) + 1))
        used = np.flatnonzero(np.diff(bounds))
        cuts = [slice(bounds[k], bounds[k + 1]) for k in used.tolist()]
        marks = [packed(place[entries[cut]], rank[cut] * buckets + bucket, f[cut], mine[cut]) for cut in cuts]
        return pa.table({"bucket": np.full(len(used), bucket), "chunk": chunks[used], "marks": pa.array(marks, pa.binary())})

    return pairs.groupBy("bucket").applyInArrow(add_up, _MARKS)


def _with_phrases(state: DataFrame, least: int, last: bool) -> DataFrame:
    """The chunks with the frequent phrases of one more word they hold.

    Phrases of the size before are reported, since it is now known which of them a longer one stands for; after
    that only words in frequent phrases of the new size matter. In the ``last`` round the new ones are reported too.
    """

    places = state.agg(F.coalesce(F.sum("places"), F.lit(0))).first()[0]
    buckets = max(1, -(-places // BUCKET_PLACES))

    def marked(levels: _Levels, marks: list[dict]) -> tuple[np.ndarray, ...]:
        """Key, id, count and mark of the frequent phrases, in order of their ids."""
        bounds, keys, *_ = levels.dealt_pairs(buckets)
        parts = [(keys[:0],) * 4]
        for mark in marks:
            place, number, f, mine = unpacked(mark["marks"])
            parts.append((keys[bounds[mark["bucket"]] + place], number, f, mine))
        key, number, f, mine = (np.concatenate(column) for column in zip(*parts))
        by_id = np.argsort(number)
        return key[by_id], number[by_id], f[by_id], mine[by_id]

    def take_in(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row, levels in _rows(batch):
                levels.add(*marked(levels, row["marks"].as_py() or []))
                size, words = len(levels.rank), np.array(row["words"].as_py(), dtype=object)
                reports = levels.reports(words, size - 1, levels.count(size)) if size > 2 else []
                if last:
                    reports += levels.reports(words, size, np.zeros(len(levels.rank[0]), np.int64))
                used, levels = levels.pruned()
                yield one_row(
                    chunk=row["chunk"].as_py(),
                    lang=row["lang"].as_py(),
                    words=row["words"].values.take(pa.array(used)),
                    codes=packed(levels.rank[0] + 1),
                    levels=pa.array(levels.level_bytes(), pa.binary()),
                    places=len(levels.next_word()[0]),
                    reports=pa.array(reports, _REPORT_TYPE),
                )

    found = _frequent(_pairs(state, buckets), least, buckets)
    marks = found.groupBy("chunk").agg(F.collect_list(F.struct("bucket", "marks")).alias("marks"))
    grown = state.drop("reports").join(marks, "chunk", "left").mapInArrow(take_in, _STATE)
    return stored(grown) if last else stored_by_key(grown, "chunk")


def collocations(docs: DataFrame, least: int = LEAST, longest: int = LONGEST, chunk_bytes: int = CHUNK_BYTES) -> DataFrame:
    """Candidates with their lowest-scoring cut: ``lang, phrase, a, l, r, n, score``.

    The score is ``1000 * a * n / (l * r)`` without its fraction, in decimals of 38 digits, which hold these products
    as long as a language has fewer than 10**17 words.
    """
    if longest < 2:
        raise ValueError("a phrase has at least two words")
    chunks = stored(chunks_of(docs, chunk_bytes))
    counted = chunks.select("lang", F.inline(F.arrays_zip("words", "counts")))
    totals = counted.groupBy("lang", F.col("words").alias("word")).agg(F.sum("counts").alias("f"))
    sizes = chunks.select("lang", F.aggregate("counts", F.lit(0).cast("long"), lambda t, x: t + x).alias("n"))
    vocabulary = ranked(totals.filter(F.col("f") >= least), F.desc("f"), "lang", "word")
    sizes = settled(sizes.groupBy("lang").agg(F.sum("n").alias("n")))
    state = _start(chunks, vocabulary)
    discard(vocabulary)
    reports = []
    for size in range(2, longest + 1):
        before, state = state, _with_phrases(state, least, size == longest)
        if size <= 3:
            discard(before)
        if size > 2 or size == longest:
            reports.append(state.select("lang", F.inline("reports")))
    cuts = F.transform(
        F.arrays_zip("firsts", "rests"),
        lambda cut, k: F.struct(
            F.expr("CAST(1000 * CAST(a AS DECIMAL(19)) * n AS DECIMAL(38))").alias("top"),
            (cut["firsts"].cast("decimal(19)") * cut["rests"].cast("decimal(19)")).alias("under"),
            k.alias("k"),
            cut["firsts"].alias("l"),
            cut["rests"].alias("r"),
        ),
    )
    scores = F.transform(
        cuts, lambda c: F.struct(F.call_function("div", c["top"], c["under"]).alias("score"), c["k"].alias("k"), c["l"], c["r"])
    )
    return (
        reduce(DataFrame.unionAll, reports)
        .join(sizes, "lang")
        .withColumn("cut", F.array_min(scores))
        .select("lang", "phrase", "a", "cut.l", "cut.r", "n", "cut.score")
    )


def best_collocations(found: DataFrame, places: int = PLACES) -> DataFrame:
    """The first so many of each language, by score, then count, then the phrase's bytes, with their ``rank``."""
    order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    return found.withColumn("rank", F.row_number().over(order).cast("long")).filter(F.col("rank") <= places)

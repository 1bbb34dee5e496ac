"""Phrases against a plain count of all of them."""

from __future__ import annotations

import random
import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from tallyloom.llm import collocations
from tallyloom.llm.registry import op13_collocations
from tallyloom.sources import read_table
from tests.compare import connect, difference

SCHEMA = "doc_id LONG, text STRING, lang STRING"


def plain(rows: list[tuple], least: int, longest: int = 5) -> dict[tuple[str, str], tuple]:
    """Candidates by language and phrase: ``a, l, r, n, score``."""
    lower = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})
    counts: dict[str, Counter] = {}
    for _, text, lang in rows:
        found = counts.setdefault("und" if lang is None else lang, Counter())
        for piece in re.split("[.,;:!?\n\x0b\x0c\r]", (text or "").translate(lower)):
            words = [w for w in re.split("[ \t]", piece) if w]
            for size in range(1, longest + 1):
                found.update(tuple(words[i : i + size]) for i in range(len(words) - size + 1))
    out = {}
    for lang, found in counts.items():
        n = sum(c for p, c in found.items() if len(p) == 1)
        often = {p: c for p, c in found.items() if c >= least and len(p) > 1}
        held = Counter()
        for p, c in often.items():
            for size in range(2, len(p)):
                for i in range(len(p) - size + 1):
                    held[p[i : i + size]] = max(held[p[i : i + size]], c)
        for p, a in often.items():
            if held[p] >= a:
                continue
            score, k = min((1000 * a * n // (found[p[:k]] * found[p[k:]]), k) for k in range(1, len(p)))
            out[lang, " ".join(p)] = (a, found[p[:k]], found[p[k:]], n, score)
    return out


def found_by(spark, rows, least, longest=5, chunk_bytes=collocations.CHUNK_BYTES):
    docs = spark.createDataFrame(rows, SCHEMA)
    found = collocations.collocations(docs, least, longest, chunk_bytes).collect()
    keyed = {(r["lang"], r["phrase"]): (r["a"], r["l"], r["r"], r["n"], r["score"]) for r in found}
    assert len(keyed) == len(found)
    return keyed


def made_up(n: int, seed: int) -> list[tuple]:
    draw = random.Random(seed)
    words = ["a", "A", "b", "c", "dé", "e f", "g-h", "x" * 300, "ß", "\x01"]
    rows = []
    for i in range(n):
        text = ""
        for _ in range(draw.randrange(60)):
            text += draw.choice(words[: draw.choice((3, 10))]) + draw.choice([" ", " ", " ", "  ", "\t", ". ", ",", "\n", "?!", "\r\n"])
        rows.append((i, draw.choice([text, text, text.strip(), ""]), draw.choice(["en", "fr", None, "und", ""])))
    return rows


@pytest.mark.parametrize("least,longest", [(2, 5), (5, 3), (12, 2)])
def test_same_as_plain(spark, least, longest):
    rows = made_up(150, least)
    expected = plain(rows, least, longest)
    assert expected
    assert found_by(spark, rows, least, longest) == expected


def test_many_small_chunks(spark):
    """Results do not depend on where chunks end."""
    rows = made_up(80, 7)
    expected = plain(rows, 3)
    assert found_by(spark, rows, 3, chunk_bytes=200) == expected


def test_tiles_count_all_pairs(monkeypatch):
    draw = np.random.default_rng(3)
    left, right = draw.zipf(1.3, 20_000) % 700, draw.zipf(1.5, 20_000) % 900
    expected = Counter((left * 900 + right).tolist())
    for tile, cells in ((256, 8), (16, 1), (4, 10**9)):
        monkeypatch.setattr(collocations, "TILE", tile)
        monkeypatch.setattr(collocations, "CELLS_EACH", cells)
        keys, counts = collocations.count_pairs(left, right, 700, 900)
        assert len(keys) == len(expected) and dict(zip(keys.tolist(), counts.tolist())) == expected
    none = np.zeros(0, np.int64)
    keys, counts = collocations.count_pairs(none, none, 0, 0)
    assert len(keys) == len(counts) == 0


def test_frequent_entries():
    draw = np.random.default_rng(5)
    left, right, n, chunk = draw.integers(0, 9, 600), draw.integers(0, 9, 600) << 40, draw.integers(1, 4, 600), np.repeat(np.arange(6), 100)
    keys = list(zip(chunk.tolist(), left.tolist(), right.tolist()))
    one = sorted({key: i for i, key in enumerate(keys)}.values())
    left, right, n, chunk = (x[one] for x in (left, right, n, chunk))
    totals, tellers = Counter(), {}
    for c, a, b, times in zip(chunk.tolist(), left.tolist(), right.tolist(), n.tolist()):
        totals[a, b] += times
        tellers[a, b] = min(c, tellers.get((a, b), c))
    entries, rank, f, mine = collocations.frequent_entries(left, right, n, chunk, 12)
    pairs = list(zip(left[entries].tolist(), right[entries].tolist()))
    assert sorted(set(pairs)) == sorted(p for p, c in totals.items() if c >= 12)
    assert f.tolist() == [totals[p] for p in pairs]
    assert mine.tolist() == [chunk[e] == tellers[p] for e, p in zip(entries.tolist(), pairs)]
    by_rank = dict(zip(rank.tolist(), f.tolist()))
    assert len(set(zip(rank.tolist(), pairs))) == len(by_rank) and sorted(by_rank) == list(range(len(by_rank)))
    assert [by_rank[k] for k in sorted(by_rank)] == sorted(by_rank.values(), reverse=True)
    none = np.zeros(0, np.int64)
    assert [len(x) for x in collocations.frequent_entries(none, none, none, none, 1)] == [0] * 4


def test_pairs_travel_as_packed_rows(spark, monkeypatch):
    """Any number of buckets gives the same phrases, and rows between chunks and buckets do not grow with the pairs."""
    rows = made_up(80, 9)
    expected = plain(rows, 2)
    taken = []
    frequent = collocations._frequent

    def counted(pairs, least, buckets):
        found = frequent(pairs, least, buckets)
        taken.append((buckets, pairs.select("chunk").distinct().count(), pairs.count(), found.count()))
        return found

    monkeypatch.setattr(collocations, "_frequent", counted)
    for places in (1, 50, 10**6):
        monkeypatch.setattr(collocations, "BUCKET_PLACES", places)
        assert found_by(spark, rows, 2) == expected
    for buckets, chunks, dealt, marked in taken:
        assert marked <= dealt <= buckets * chunks
    assert [b for b, *_ in taken][:2] != [1, 1] and [b for b, *_ in taken][-4:] == [1] * 4


def test_products_beyond_64_bits(spark):
    """The score is exact where its numerator has more than 64 bits."""
    a, n, first, rest = 10**10 + 7, 10**13 + 9, 10**10 + 9, 10**10 + 33
    row = spark.createDataFrame([(a, n, first, rest)], "a LONG, n LONG, l LONG, r LONG")
    top = F.expr("CAST(1000 * CAST(a AS DECIMAL(19)) * n AS DECIMAL(38))")
    under = F.col("l").cast("decimal(19)") * F.col("r").cast("decimal(19)")
    assert row.select(F.call_function("div", top, under)).first()[0] == 1000 * a * n // (first * rest)


def test_empty_rows_repeated_rows_and_other_columns(spark):
    docs = spark.createDataFrame([(1, "x y. x y", "en", 5, 1), (1, "x y. x y", "en", 5, 1), (None, None, "fr", 0, 2), (3, "", None, 0, 3)],
                                 "doc_id LONG, text STRING, lang STRING, chunk INT, id INT")
    found = collocations.collocations(docs, 4).collect()
    assert [tuple(r) for r in found] == [("en", "x y", 4, 4, 4, 8, 2000)]
    assert collocations.collocations(docs.limit(0), 4).collect() == []
    with pytest.raises(ValueError):
        collocations.collocations(docs, longest=1)


def test_long_text_and_ties(spark):
    """One long text without a piece end; equal scores go by count, then by the bytes of the phrase."""
    rows = [(1, "u v " * 40_000 + "w", "en"), (2, "p q. r s. é z. " * 5, "fr")]
    docs = spark.createDataFrame(rows, SCHEMA)
    found = collocations.collocations(docs, 5)
    keyed = {(r["lang"], r["phrase"]): tuple(r)[2:] for r in found.collect()}
    assert keyed == plain(rows, 5)
    best = collocations.best_collocations(found, 2).filter("lang = 'fr'").orderBy("rank").collect()
    assert [(r["rank"], r["phrase"]) for r in best] == [(1, "p q"), (2, "r s")]


def test_query_against_sql(spark, tables):
    from tallyloom.llm.oracles import ORACLES

    found = op13_collocations(spark, tables)
    assert difference(found, connect(tables), ORACLES["op13_collocations"]) is None
    assert read_table(spark, f"{tables}/documents.parquet").count() > 0

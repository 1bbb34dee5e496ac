"""Decontamination against a plain search, and the registered query against its SQL."""

import random
import time

import pytest

from tallyloom.llm import decontamination as dc
from tallyloom.llm.oracles import ORACLES
from tallyloom.llm.registry import QUERIES
from tests.compare import connect, difference
from tests.llm.test_words import plain_words

DOCS = "doc_id BIGINT, text STRING, items STRING"


def brute_force(text, items, window=13):
    words = plain_words(text)
    hit, found = set(), set()
    for item_id, item in items:
        own = plain_words(item)
        length = min(window, len(own))
        for s in range(len(own) - length + 1) if length else ():
            for p in range(len(words) - length + 1):
                if words[p : p + length] == own[s : s + length]:
                    hit.update(range(p, p + length))
                    found.add(item_id)
    return len(words), len(hit), sorted(str(i) for i in found if i is not None), bool(hit) and 20 * len(hit) >= len(words)


def test_against_a_plain_search(spark):
    draw = random.Random(3)
    word = lambda: draw.choice(["ab", "cd", "ef", "Gh", "ij", "é1"])
    items = [(i, " ".join(word() for _ in range(draw.randint(0, 20)))) for i in range(12)]
    items += [(3, items[5][1]), (99, items[6][1]), (None, "null item words here"), (50, None), (51, ""), (52, "solo")]
    docs = []
    for d in range(40):
        text = [word() for _ in range(draw.randint(0, 25))]
        if d % 2:
            text += (items[draw.randrange(len(items))][1] or "").split()
            text += [word() for _ in range(3)]
        docs.append((d, ", ".join(text), "x"))
    docs += [(100, None, "x"), (101, "", None), (None, "null item words here, SOLO", "x"), (7, docs[7][1], "x"), (7, "solo " * 3000, "x")]
    judged = dc.decontaminate(
        spark.createDataFrame(docs, DOCS), spark.createDataFrame(items, "item_id INT, text STRING")
    )
    found = sorted((str(r["doc_id"]), r["n_words"], r["n_hit"], r["items"], r["contaminated"]) for r in judged.collect())
    assert found == sorted((str(i), *brute_force(t, items)) for i, t, _ in docs)
    kept = dc.keep_clean(spark.createDataFrame(docs, DOCS), judged)
    assert kept.columns == ["doc_id", "text", "items"]
    assert kept.count() == sum(not brute_force(t, items)[3] for _, t, _ in docs)


def test_empty_tables(spark):
    docs, items = spark.createDataFrame([(1, "a b", "")], DOCS), spark.createDataFrame([], "item_id INT, text STRING")
    assert [tuple(r)[2:] for r in dc.decontaminate(docs, items).collect()] == [(2, 0, [], False)]
    assert dc.decontaminate(docs.limit(0), items).count() == 0


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_and_sql(spark, tables, name):
    assert difference(QUERIES[name](spark, tables), connect(tables), ORACLES[name]) is None


def test_many_items_in_one_chunk(spark):
    rows = [(f"i{k}", " ".join(f"w{k}x{j}" for j in range(20))) for k in range(8000)]
    items = spark.createDataFrame(rows, "item_id STRING, text STRING").coalesce(1)
    start = time.monotonic()
    # Twenty words have eight windows; shingles made anew for every item took minutes here.
    assert dc.item_windows(items).count() == 8 * len(rows)
    assert time.monotonic() - start < 40

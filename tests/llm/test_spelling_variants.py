"""Near words, forms and roots against a comparison of all words."""

from __future__ import annotations

import random
import re
from collections import Counter
from itertools import combinations
from zlib import crc32

import pytest

from tallyloom.llm import spelling_variants as sv
from tallyloom.llm.registry import op12_spelling_variants
from tests.compare import connect, difference

SCHEMA = "doc_id LONG, text STRING"


def one_edit(a: str, b: str) -> bool:
    if len(a) > len(b):
        a, b = b, a
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    return len(b) == len(a) + 1 and any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def plain(rows: list[tuple], edit_each: int) -> dict[str, tuple]:
    counts: Counter = Counter()
    for doc, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = "".join(c.lower() if "A" <= c <= "Z" else c for c in run)
            h = crc32(f"{'' if doc is None else doc}:{run}".encode())
            if h % edit_each == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            counts[run] += 1
    words = {w: n for w, n in counts.items() if len(w) >= 5 and n >= 3}
    near: dict[str, list] = {w: [] for w in words}
    for a, b in combinations(words, 2):
        if one_edit(a, b):
            near[a].append((-words[b], b))
            near[b].append((-words[a], a))
    form = {w: min(near[w]) for w in words if near[w] and -min(near[w])[0] >= 2 * words[w]}
    out = {}
    for w, n in words.items():
        root = w
        while root in form:
            root = form[root][1]
        out[w] = (form[w][1] if w in form else None, root, n, len(near[w]), -form[w][0] if w in form else None)
    return out


def found_by(spark, rows, edit_each=97, symbols=None):
    found = sv.spelling_variants(spark.createDataFrame(rows, SCHEMA), edit_each, symbols).collect()
    keyed = {r["word"]: (r["form"], r["root"], r["n"], r["n_near"], r["form_n"]) for r in found}
    assert len(keyed) == len(found)
    return keyed


def made_up(seed: int) -> list[tuple]:
    draw = random.Random(seed)
    stems = ["".join(draw.choice("abcdéßÀ÷") for _ in range(draw.randrange(4, 9))) for _ in range(25)]
    rows = []
    for i in range(120):
        words = []
        for _ in range(draw.randrange(40)):
            word = draw.choice(stems[: draw.choice((3, 25))])
            if draw.random() < 0.3:
                at = draw.randrange(len(word))
                word = word[:at] + draw.choice(["", "x", "aé", "B"]) + word[at + draw.choice((0, 1)) :]
            words.append(draw.choice((word, word.upper(), word.capitalize())))
        rows.append((draw.choice((i, i, 7, None)), draw.choice((" ", "-", "1", "\n")).join(words)))
    return rows


@pytest.mark.parametrize("seed,edit_each,symbols", [(1, 97, None), (2, 3, 4), (3, 5, 16)])
def test_same_as_plain(spark, seed, edit_each, symbols):
    rows = made_up(seed)
    expected = plain(rows, edit_each)
    assert any(f and r != f for f, r, *_ in expected.values()) or seed != 1
    assert found_by(spark, rows, edit_each, symbols) == expected


def test_roots_at_the_end_of_long_ways(spark):
    """Each word is the form of the one before it, eight steps long; ties of counts go to the first word."""
    ways = [("aaaaa" + "b" * i, 3 * 2**i) for i in range(9)]
    ties = [("mnopq", 3), ("mnopr", 6), ("mnops", 6)]
    rows = [(1, " ".join(" ".join([w] * n) for w, n in ways + ties))]
    found = found_by(spark, rows, edit_each=10**9)
    assert found == plain(rows, 10**9)
    assert found["aaaaa"][1] == ways[-1][0] and found["mnopq"][0] == "mnopr"


def test_empty_repeated_long_and_other_columns(spark):
    docs = spark.createDataFrame(
        [(1, None, 1, "x"), (2, "", 1, "x"), (3, "1234 !", 1, "x"), (4, "hello " * 2, 1, "x"), (4, "hello " * 2, 1, "x"), (None, "y" * 300 + " hallo", 1, "x")],
        "doc_id LONG, text STRING, n INT, form STRING",
    )
    assert [tuple(r) for r in sv.spelling_variants(docs, 10**9).collect()] == [("hello", None, "hello", 4, 0, None)]
    assert sv.spelling_variants(docs.limit(0)).collect() == []
    long = "y" * 300
    rows = [(i, f"{long} {long}z {long}") for i in range(3)]
    assert found_by(spark, rows, 10**9) == plain(rows, 10**9)


def test_text_ids(spark):
    docs = spark.createDataFrame([("a", "abcdef")] * 3, "doc_id STRING, text STRING")
    assert sv.spelling_variants(docs, 10**9).count() == 1


def test_query_against_sql(spark, tables):
    from tallyloom.llm.oracles import ORACLES

    assert difference(op12_spelling_variants(spark, tables), connect(tables), ORACLES["op12_spelling_variants"]) is None

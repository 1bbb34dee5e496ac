"""Suffix sorting and removal of repeats against plain searches."""

import hashlib
import random
from collections import Counter

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from tallyloom.llm import repeated_text as rt
from tallyloom.llm.suffix_sort import repeated_starts, sort_suffixes

DOCS = "doc_id BIGINT, text STRING, node STRING, spans INT"


@settings(max_examples=150, deadline=None)
@given(st.one_of(st.binary(max_size=60), st.text("ab", max_size=80).map(str.encode)))
def test_suffixes_in_order(data):
    text = np.frombuffer(data, np.uint8)
    order = sort_suffixes(text, 1000).tolist()
    assert order == sorted(range(len(data)), key=lambda i: data[i:])


@settings(max_examples=60, deadline=None)
@given(st.text("abc", min_size=12, max_size=120).map(str.encode), st.integers(3, 12))
def test_repeated_starts(data, depth):
    text = np.frombuffer(data, np.uint8)
    starts = np.arange(len(data) - depth + 1)
    seen = Counter(data[s : s + depth] for s in starts)
    assert repeated_starts(text, starts, depth).tolist() == [seen[data[s : s + depth]] > 1 for s in starts]


def plain_removal(rows, length):
    texts = [(t or "").encode() for _, t in rows]
    seen = Counter(t[s : s + length] for t in texts for s in range(len(t) - length + 1))
    out = []
    for (doc_id, _), t in zip(rows, texts):
        gone = [False] * len(t)
        for s in range(len(t) - length + 1):
            if seen[t[s : s + length]] > 1:
                gone[s : s + length] = [True] * length
        kept = bytes(b for b, g in zip(t, gone) if not g)
        runs = sum(g and not (i and gone[i - 1]) for i, g in enumerate(gone))
        out.append((str(doc_id), len(t), sum(gone), runs, hashlib.sha256(kept).hexdigest()))
    return sorted(out)


def corpus():
    draw = random.Random(12)
    prose = lambda n: "".join(draw.choice("abcdefgh éñ") for _ in range(n))
    shared = [prose(90), prose(41), prose(200)]
    rows = []
    for d in range(60):
        parts = [prose(draw.randint(0, 120))]
        for _ in range(draw.randint(0, 3)):
            part = draw.choice(shared)
            if draw.random() < 0.4:
                part = part[draw.randrange(20) :]
            parts += [part, prose(draw.randint(0, 60))]
        rows.append((d, "".join(parts)))
    rows += [(200, "ab" * 300), (201, "x" * 70 + "ab" * 90), (202, "line of text, again\n" * 30), (203, "q" * 39), (204, "q" * 41)]
    rows += [(300, None), (301, ""), (None, rows[3][1]), (5, rows[5][1]), (302, rows[7][1]), (303, rows[7][1]), (5, prose(50))]
    return rows


@pytest.mark.parametrize("part_bytes, most", [(10_000, 200), (700, 200), (10_000, 1), (10_000, 3)])
def test_removal_against_a_plain_search(spark, part_bytes, most):
    rows, length = corpus(), 40
    frame = spark.createDataFrame([(i, t, "n", 1) for i, t in rows], DOCS)
    spans = rt.repeated_spans(frame, length, 8, part_bytes, most)
    found = rt.remove_repeats(frame, spans).collect()
    assert sorted((str(r["doc_id"]), *tuple(r)[1:]) for r in found) == plain_removal(rows, length)


def test_no_rows(spark):
    frame = spark.createDataFrame([], DOCS)
    assert rt.remove_repeats(frame, rt.repeated_spans(frame)).count() == 0


def test_registered_query(spark, tables):
    from tallyloom.llm.registry import QUERIES

    docs = spark.read.parquet(f"{tables}/documents.parquet").select("doc_id", "text").collect()
    found = QUERIES["op6_repeated_text"](spark, tables).collect()
    columns = ("n_bytes", "n_removed", "n_spans", "kept_sha256")
    assert sorted((str(r["doc_id"]), *(r[c] for c in columns)) for r in found) == plain_removal([tuple(d) for d in docs], 400)

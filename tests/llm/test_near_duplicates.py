"""Signatures, and classes against all pairs."""

import random
import tracemalloc
from collections import Counter

import numpy as np
import pytest

from tallyloom.llm import near_duplicates as nd
from tallyloom.llm.components import components
from tests.llm.test_words import plain_words

DOCS = "doc_id BIGINT, text STRING, node STRING, bands INT"


def plain_set(text):
    words = plain_words(text)
    size = min(5, len(words))
    return Counter(tuple(words[i : i + size]) for i in range(len(words) - size + 1)) if size else Counter()


def plain_similarity(a, b):
    least = sum((a & b).values())
    total = sum(a.values()) + sum(b.values()) - least
    return least / total if total else 0.0


def plain_classes(rows):
    sets = [plain_set(t) for _, t in rows]
    root = list(range(len(rows)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i in range(len(rows)):
        for j in range(i):
            same = rows[i][1] == rows[j][1] and rows[i][1]
            if same or (sets[i] and plain_similarity(sets[i], sets[j]) >= 0.8):
                a, b = sorted((find(i), find(j)))
                root[b] = a
    groups = {}
    for i, (doc, _) in enumerate(rows):
        groups.setdefault(find(i), []).append(doc)
    return [(min((d for d in groups[find(i)] if d is not None), default=None), len(groups[find(i)])) for i in range(len(rows))]


def family(draw, n, words=60, edits=(0, 1, 2, 3)):
    base = [f"w{draw.randrange(4000)}" for _ in range(words)]
    out = []
    for _ in range(n):
        own = list(base)
        for _ in range(draw.choice(edits)):
            own[draw.randrange(words)] = f"x{draw.randrange(9999)}"
        out.append(" ".join(own))
    return out


def test_classes_against_all_pairs(spark, monkeypatch):
    monkeypatch.setattr(nd, "BLOCK_TEXTS", 4)
    draw = random.Random(8)
    texts = [t for _ in range(6) for t in family(draw, 9)] + family(draw, 40, 50, (1, 2, 3))
    texts += ["one two", "one  TWO", "one two", "", "", None, "?!", "?!", "a b c d e " * 40, "a b c d e " * 41]
    draw.shuffle(texts)
    rows = list(enumerate(texts, start=10)) + [(None, texts[0]), (11, texts[1])]
    frame = spark.createDataFrame([(i, t, "n", 1) for i, t in rows], DOCS)
    classes = nd.near_duplicate_classes(frame)
    found = sorted((str(r["doc_id"]), str(r["class_id"]), r["class_size"]) for r in classes.collect())
    assert found == sorted((str(i), str(c), n) for (i, _), (c, n) in zip(rows, plain_classes(rows)))
    kept = nd.keep_one_of_each(frame, classes)
    assert kept.columns == ["doc_id", "text", "node", "bands"]
    expected = {c for (_, t), (c, _) in zip(rows, plain_classes(rows)) if t}
    assert sorted(r["doc_id"] for r in kept.collect() if r["text"]) == sorted(expected)
    assert sum(1 for r in kept.collect() if not r["text"]) == sum(1 for _, t in rows if not t)


def test_unrelated_texts_with_a_null_or_repeated_id_stay(spark):
    draw = random.Random(12)
    texts = [family(draw, 1, edits=(0,))[0] for _ in range(9)]
    near = texts[0].rsplit(" ", 1)[0] + " other"
    rows = [(None, t) for t in texts[:4]] + [(None, near), (None, ""), (None, None)]
    rows += [(7, t) for t in texts[4:7]] + [(7, ""), (7, texts[4]), (8, texts[7]), (None, texts[7]), (9, texts[8])]
    frame = spark.createDataFrame([(i, t, "n", 1) for i, t in rows], DOCS)
    classes = nd.near_duplicate_classes(frame)
    kept = [(r["doc_id"], r["text"]) for r in nd.keep_one_of_each(frame, classes).collect()]
    one = [t for _, t in kept if t in (texts[0], near)]
    assert len(one) == 1 and all(i is None for i, t in kept if t in one)
    expected = [(None, t) for t in texts[1:4]] + [(None, ""), (None, None)] + [(7, t) for t in texts[4:7]] + [(7, ""), (8, texts[7]), (9, texts[8])]
    assert sorted(map(str, (k for k in kept if k[1] not in one))) == sorted(map(str, expected))
    assert classes.filter("root is not null").select("root").distinct().count() == 9


def test_no_rows(spark):
    frame = spark.createDataFrame([], DOCS)
    assert nd.near_duplicate_classes(frame).count() == 0
    only_empty = spark.createDataFrame([(1, None, "", 1), (2, "", "", 1)], DOCS)
    assert sorted(r["class_id"] for r in nd.near_duplicate_classes(only_empty).collect()) == [1, 2]


@pytest.mark.parametrize("weights", [(1.0, 1.0), (0.3, 2.5), (5.0, 0.1)])
def test_equal_coordinates_estimate_the_similarity(weights):
    draw = np.random.default_rng(4)
    tokens = draw.integers(0, 2**63, 300).astype(np.uint64)
    wa = draw.choice(weights, 300)
    wb = np.where(draw.random(300) < 0.7, wa, wa * draw.uniform(0.2, 1.8, 300))
    owner = np.repeat([0, 1], 300)
    rows = nd.dart_signatures(owner, np.concatenate([tokens, tokens]), np.concatenate([wa, wb]), 2, 2000)
    expected = np.minimum(wa, wb).sum() / np.maximum(wa, wb).sum()
    assert np.isfinite(rows).all() and abs((rows[0] == rows[1]).mean() - expected) < 0.04


def test_small_sets_fill_all_coordinates():
    rows = nd.dart_signatures(np.array([0, 2]), np.array([5, 5], np.uint64), np.array([1.0, 1.0]), 3, 64)
    assert np.isfinite(rows[[0, 2]]).all() and (rows[0] == rows[2]).all() and np.isinf(rows[1]).all()


def test_components_of_a_long_chain_and_a_star(spark):
    links = [(i, i + 1) for i in range(1, 40)] + [(100, 100 + i) for i in range(1, 50)] + [(7, 7)]
    found = dict(tuple(r) for r in components(spark.createDataFrame(links, "a INT, b INT")).collect())
    assert found == {**{i: 1 for i in range(2, 41)}, **{100 + i: 100 for i in range(1, 50)}}


def test_signatures_of_short_texts_in_bounded_memory(monkeypatch):
    n = 4000
    owner, tokens = np.repeat(np.arange(n), 3), np.arange(3 * n, dtype=np.uint64)
    weights = np.tile([1.0, 2.0, 1.0], n)
    tracemalloc.start()
    whole = nd.dart_signatures(owner, tokens, weights, n, 24)
    _, peak = tracemalloc.get_traced_memory()
    tracemalloc.stop()
    assert peak < 16e6 + whole.nbytes, peak
    monkeypatch.setattr(nd, "STRIPS", 50)
    assert np.array_equal(whole[:200], nd.dart_signatures(owner[:600], tokens[:600], weights[:600], 200, 24))

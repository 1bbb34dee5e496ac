"""The language model against plain recursions and plain counts."""

from __future__ import annotations

import re
from collections import Counter
from itertools import product
from math import log10
from zlib import crc32

import numpy as np
import pytest
from pyspark.sql import functions as F

from tallyloom.llm import hidden_markov as hm
from tallyloom.llm.registry import op11_language_model
from tallyloom.sources import read_table


def some_chain(states: int, classes: int, seed: int) -> hm.Chain:
    draw = np.random.default_rng(seed)
    moves, emits = draw.random((states, states)) + 0.05, draw.random((classes, states)) + 0.01
    start = draw.random(states)
    return hm.Chain(start / start.sum(), moves / moves.sum(axis=1, keepdims=True), emits / emits.sum(axis=0))


def by_paths(chain: hm.Chain, words: list[int]) -> tuple[float, hm.Counts]:
    """Probability and expected counts from all paths of states."""
    states = len(chain.start)
    total, counts = 0.0, hm.Counts.none(states, len(chain.emits))
    for path in product(range(states), repeat=len(words)):
        p = chain.start[path[0]]
        for t, (s, w) in enumerate(zip(path, words)):
            p *= chain.emits[w, s] * (chain.moves[path[t - 1], s] if t else 1.0)
        total += p
        counts.start[path[0]] += p
        for t, (s, w) in enumerate(zip(path, words)):
            counts.emits[w, s] += p
            if t:
                counts.moves[path[t - 1], s] += p
    return total, counts.scaled(1 / total)


def joined(texts: list[list[int]]) -> tuple[np.ndarray, np.ndarray]:
    return np.array([w for t in texts for w in t], np.int64), np.array([len(t) for t in texts], np.int64)


@pytest.mark.parametrize("long_text,block,group", [(1 << 14, 1 << 11, 1 << 18), (3, 2, 5), (1, 1, 1)])
def test_recursions_against_all_paths(monkeypatch, long_text, block, group):
    """Also where texts are cut into blocks and groups."""
    for name, value in (("LONG_TEXT", long_text), ("BLOCK", block), ("GROUP", group)):
        monkeypatch.setattr(hm, name, value)
    chain = some_chain(3, 5, 2)
    texts = [[0], [1, 4, 2, 0], [3, 0], [2, 2, 2, 1, 4, 3, 0], [0], [4, 1, 0]]
    expected = [by_paths(chain, t) for t in texts]
    classes, lengths = joined(texts)
    np.testing.assert_allclose(hm.text_likelihoods(chain, classes, lengths), np.log([p for p, _ in expected]), rtol=1e-12)
    found = hm.expected_counts(chain, classes, lengths)
    for name in ("start", "moves", "emits"):
        np.testing.assert_allclose(getattr(found, name), sum(getattr(c, name) for _, c in expected), rtol=1e-10)
    assert found.likelihood == pytest.approx(sum(np.log(p) for p, _ in expected))


def test_very_long_text_in_blocks(monkeypatch):
    """A text of many blocks has the likelihood and the counts it has in one stretch; nothing runs out of range."""
    chain = some_chain(4, 50, 5)
    classes = np.random.default_rng(1).integers(0, 50, 20_011)
    lengths = np.array([20_000, 11])
    assert lengths[0] > hm.LONG_TEXT
    in_blocks, counts = hm.text_likelihoods(chain, classes, lengths), hm.expected_counts(chain, classes, lengths)
    monkeypatch.setattr(hm, "LONG_TEXT", 1 << 30)
    np.testing.assert_allclose(in_blocks, hm.text_likelihoods(chain, classes, lengths), rtol=1e-12)
    whole = hm.expected_counts(chain, classes, lengths)
    for name in ("start", "moves", "emits"):
        np.testing.assert_allclose(getattr(counts, name), getattr(whole, name), rtol=1e-8)
    none = np.zeros(0, np.int64)
    assert len(hm.text_likelihoods(chain, none, none)) == 0


ROWS = [
    (1, "The cat  sat\ton the MAT"), (2, "the dog sat"), (3, None), (4, ""), (4, ""), (None, "cat dog"), (5, " \n"),
    (6, "Énorme énorme x" + "y" * 100), (7, "the " * 500), (8, "unseen words here"), (9, "cat"), (10, "the \x01 mat"),
]


def plain(rows: list[tuple]) -> list[tuple]:
    lower = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})
    held = [doc is not None and crc32(str(doc).encode()) % 7 == 2 for doc, _ in rows]
    tokens = [[w for w in re.split("[ \t-\r]", (t or "").translate(lower)) if w] + [None] for _, t in rows]
    c = Counter(w for h, ws in zip(held, tokens) if not h for w in ws)
    n, v = sum(c.values()), len(c)
    return sorted(
        (str(doc), h, len(ws), sum(c[w] > 0 for w in ws), n, round(sum(log10((c[w] + 1) / (n + v + 1)) for w in ws), 6))
        for (doc, _), h, ws in zip(rows, held, tokens)
    )


def scored(docs) -> list:
    return hm.score_corpus(docs, F.crc32(F.col("doc_id").cast("string")) % 7 == 2, states=3).collect()


def shaped(rows) -> list[tuple]:
    return sorted((str(r[0]), *r[1:5], round(r["base_score"], 6)) for r in rows)


def test_counts_and_base_scores_against_plain(spark):
    rows = ROWS + [(i, f"the cat number{i % 3} sat") for i in range(20, 40)]
    assert any(h for _, h, *_ in plain(rows))
    found = scored(spark.createDataFrame(rows, "doc_id LONG, text STRING"))
    assert shaped(found) == plain(rows)
    assert all(np.isfinite(r["score"]) and r["score"] < 0 for r in found)


def test_no_rows_no_training_and_other_columns(spark):
    held = next(i for i in range(100) if crc32(str(i).encode()) % 7 == 2)
    docs = spark.createDataFrame([(held, "a b", 1, 2), (held, None, 1, 2)], "doc_id LONG, text STRING, part INT, chunk INT")
    found = scored(docs)
    assert shaped(found) == [(str(held), True, 1, 0, 0, 0.0), (str(held), True, 3, 0, 0, 0.0)]
    assert scored(docs.limit(0)) == []
    text_ids = spark.createDataFrame([("x", "a b c"), (None, "a")], "doc_id STRING, text STRING")
    assert sorted((str(r["doc_id"]), r["n_tokens"]) for r in scored(text_ids)) == [("None", 2), ("x", 4)]


def test_probabilities_add_up(spark):
    """Starts, moves and emissions are distributions; all words are counted."""
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(["a b", "b", "", "c a b", "a a"])], "doc_id LONG, text STRING")
    chunks = hm.stored(hm._chunks(docs, F.lit(False)))
    known = hm.count_words(chunks)
    chain, _ = hm.fit_chain(hm.encode(chunks, known), known, states=2)
    np.testing.assert_allclose([chain.start.sum(), *chain.moves.sum(axis=1), *chain.emits.sum(axis=0)], 1.0)
    assert known.class_counts.sum() == known.tokens == 5 + 8
    assert known.distinct == 4


def test_words_that_share_a_class(spark, monkeypatch):
    """With no words of their own class, a class's known words and its unknown one have probability one together."""
    monkeypatch.setattr(hm, "HEAD_LEAST", 10**9)
    texts = ["xing", "xing ying", "xing", "ying zing"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id LONG, text STRING")
    chunks = hm.stored(hm._chunks(docs, F.lit(False)))
    known = hm.count_words(chunks)
    assert {r["c"] for r in known.words.collect()} == {1, 2, 3}
    within = {d["n_tokens"]: 10 ** d["within"] for r in hm.encode(chunks, known).select("docs").collect() for d in r["docs"]}
    assert within[2] == pytest.approx((3 - hm.DISCOUNT) / 7)
    number = 1 + hm.HEAD_WORDS + crc32(b"ing") % hm.ENDINGS
    assert (known.class_counts[number], known.class_words[number]) == (6, 3)
    # Three discounted words and what is left for unknown ones.
    assert sum((c - hm.DISCOUNT) / 7 for c in (3, 2, 1)) + (3 * hm.DISCOUNT + 1) / 7 == pytest.approx(1)


def test_training_raises_the_likelihood(spark, tables):
    docs = read_table(spark, f"{tables}/documents.parquet")
    held = F.crc32(F.col("doc_id").cast("string")) % 7 == 2
    chunks = hm.stored(hm._chunks(docs, held))
    known = hm.count_words(chunks)
    _, likelihoods = hm.fit_chain(hm.encode(chunks, known), known, states=4, full_rounds=4)
    # Pseudo-counts are added in each round, hence not strictly.
    assert all(b > a - 1e-4 * abs(a) for a, b in zip(likelihoods, likelihoods[1:]))
    assert likelihoods[-1] > likelihoods[0]


def test_query_on_the_tables(spark, tables):
    rows = read_table(spark, f"{tables}/documents.parquet").select("doc_id", "text").collect()
    found = op11_language_model(spark, tables).collect()
    assert shaped(found) == plain([tuple(r) for r in rows])
    held = [r for r in found if r["held_out"]]
    assert sum(r["score"] for r in held) > sum(r["base_score"] for r in held)


def test_chunk_dictionaries_from_rows_in_any_batches(spark):
    rows = [(chunk, at, 10 * chunk + at, at % 3) for chunk in (0, 5, 7) for at in range(8)]
    words = spark.createDataFrame(rows[::-1], "chunk LONG, at INT, c LONG, class INT")
    before = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", 3)
    try:
        found = {r["chunk"]: [v.tolist() for v in hm.unpacked(bytes(r["found"]))] for r in hm._gathered(words).collect()}
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", before)
    assert found == {n: [[10 * n + at for at in range(8)], [at % 3 for at in range(8)]] for n in (0, 5, 7)}

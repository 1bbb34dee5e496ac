"""Tokens, pieces and best-fit decreasing."""

import zlib

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from tallyloom.llm import packing
from tallyloom.llm.registry import QUERIES

FILES = (
    public_tokenizers.path("byte_bpe_50k.json"),
    public_tokenizers.path("byte_bpe_50k.tiktoken"),
    public_tokenizers.PATTERN,
)
DOCS = "doc_id BIGINT, text STRING, piece STRING, length STRING"


@pytest.fixture(scope="module")
def tokenizer():
    return Tokenizer.from_file(FILES[0])


@settings(max_examples=100, deadline=None)
@given(st.text(max_size=60))
def test_ids_are_those_of_the_file(text):
    tokenizer = Tokenizer.from_file(FILES[0]) if not hasattr(packing, "_t") else packing._t
    packing._t = tokenizer
    assert list(packing.encoder(*FILES).encode(text)) == tokenizer.encode(text, add_special_tokens=False).ids


def test_special_strings_and_long_runs(tokenizer):
    for text in ("a <|endoftext|> b", "x" * 5000, " " * 3000 + "é\n\n\t" * 50, "1234567 'll <|endoftext"):
        assert list(packing.encoder(*FILES).encode(text)) == tokenizer.encode(text, add_special_tokens=False).ids


@pytest.mark.parametrize("n", [1, 5, 8, 9, 16, 17, 40])
def test_piece_bounds(n):
    bounds = packing.piece_bounds(n, 8)
    assert sum(k for _, k in bounds) == n and all(k == 8 for _, k in bounds[1:]) and 0 < bounds[0][1] <= 8
    assert [s for s, _ in bounds] == np.cumsum([0, *(k for _, k in bounds)])[:-1].tolist()


@settings(max_examples=100, deadline=None)
@given(st.lists(st.integers(1, 20), max_size=60))
def test_best_fit_against_a_plain_version(lengths):
    sequence, offset = packing.best_fit_decreasing(np.array(lengths, np.int64), 20)
    rooms = []
    for k in sorted(range(len(lengths)), key=lambda k: -lengths[k]):
        fits = [r for r in rooms if r >= lengths[k]]
        if fits:
            rooms.remove(min(fits))
            rooms.append(min(fits) - lengths[k])
        else:
            rooms.append(20 - lengths[k])
    assert len(set(sequence.tolist())) == len(rooms)
    check_places([(s, o, n) for s, o, n in zip(sequence, offset, lengths)], 20)


def check_places(places, capacity):
    by_sequence = {}
    for s, o, n in places:
        by_sequence.setdefault(s, []).append((o, n))
    for parts in by_sequence.values():
        end = 0
        for o, n in sorted(parts):
            assert o == end
            end = o + n
        assert end <= capacity


def check_rows(rows, docs, tokenizer, capacity=1024):
    expected = {}
    for doc_id, text in docs:
        ids = np.array([*tokenizer.encode(text or "", add_special_tokens=False).ids, 2], "<u4")
        for p, (s, n) in enumerate(packing.piece_bounds(len(ids), capacity)):
            expected.setdefault((doc_id, p, s, n, zlib.crc32(ids[s : s + n].tobytes())), []).append(1)
    found = {}
    for r in rows:
        found.setdefault((r["doc_id"], r["piece"], r["start"], r["length"], r["ids_crc32"]), []).append(1)
    assert found == expected
    check_places([(r["sequence_id"], r["offset"], r["length"]) for r in rows], capacity)
    return len({r["sequence_id"] for r in rows}), -(-sum(r["length"] for r in rows) // capacity)


def test_packed_documents(spark, tokenizer):
    docs = [(i, "word " * (i * 7 % 90)) for i in range(80)] + [(1, "same"), (1, "same"), (None, None), (3, "")]
    frame = spark.createDataFrame([(i, t, "p", "l") for i, t in docs], DOCS)
    rows = packing.pack_documents(frame, *FILES, capacity=32).collect()
    used, least = check_rows(rows, docs, tokenizer, 32)
    assert used <= least + 2
    assert packing.pack_documents(frame.limit(0), *FILES).count() == 0


def test_registered_query(spark, tables, tokenizer):
    docs = [tuple(r) for r in spark.read.parquet(f"{tables}/documents.parquet").select("doc_id", "text").collect()]
    used, least = check_rows(QUERIES["op7_packing"](spark, tables).collect(), docs, tokenizer)
    assert used <= 1.02 * least + 1

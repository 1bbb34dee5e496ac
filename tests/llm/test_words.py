"""Words of texts against the plain pattern, and the bitmap."""

import re

import numpy as np
import pyarrow as pa
from hypothesis import given, settings
from hypothesis import strategies as st

from tallyloom.llm.bitmap import build_bitmap, may_contain
from tallyloom.llm.words import split_words, text_chunks

WORD = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def plain_words(text):
    return WORD.findall((text or "").translate(LOWER))


@settings(max_examples=60, deadline=None)
@given(st.lists(st.one_of(st.none(), st.text(alphabet="aAzZé0 9.\n-ßñ", max_size=30)), max_size=8), st.integers(1, 40))
def test_words_of_a_batch(texts, limit):
    found = [[] for _ in texts]
    hashes = {}
    for first, data, offsets in text_chunks(pa.array(texts, pa.string()), limit):
        words = split_words(data, offsets)
        assert len(words.counts) == len(offsets) - 1
        for k, owner in enumerate(words.owner.tolist()):
            word = words.join(k, k + 1)
            found[first + owner].append(word)
            assert hashes.setdefault(word, words.hashes[k]) == words.hashes[k]
    assert found == [plain_words(t) for t in texts]
    assert len(set(hashes.values())) == len(hashes)


def test_shingles_stay_within_texts():
    _, data, offsets = next(text_chunks(pa.array(["a b c", "d", "", "a b c"])))
    words = split_words(data, offsets)
    at, tokens = words.shingles(2)
    assert at.tolist() == [0, 1, 4, 5] and tokens[0] == tokens[2] and tokens[0] != tokens[1]
    assert len(words.shingles(9)[0]) == 0


def test_a_bitmap_passes_all_of_its_set(spark):
    numbers = np.random.default_rng(1).integers(-(2**63), 2**63 - 1, 500)
    frame = spark.createDataFrame([(int(n),) for n in numbers], "token BIGINT")
    bitmap = build_bitmap(frame, "token", 500)
    assert may_contain(bitmap, numbers.astype(np.int64).view(np.uint64)).all()
    others = np.random.default_rng(2).integers(0, 2**63 - 1, 5000).astype(np.uint64)
    assert may_contain(bitmap, others).mean() < 0.05
    assert not may_contain(build_bitmap(frame.limit(0), "token", 0), others).any()

"""The lookup table against a plain filling, and placement."""

import numpy as np
import pytest

from tallyloom.llm import sharding


def plain_table(shards, size):
    orders = []
    for s in shards:
        offset, skip = sharding._name_hash(s, "offset") % size, sharding._name_hash(s, "skip") % (size - 1) + 1
        orders.append([(offset + skip * k) % size for k in range(size)])
    owner = {}
    while len(owner) < size:
        for k, order in enumerate(orders):
            if len(owner) < size:
                owner[next(s for s in order if s not in owner)] = k
    return [owner[s] for s in range(size)]


@pytest.mark.parametrize("shards, size", [(1, 7), (5, 101), (7, 7)])
def test_turns_are_taken(shards, size):
    names = [f"s{i}" for i in range(shards)]
    assert sharding.lookup_table(names, size).tolist() == plain_table(names, size)


def test_even_and_steady():
    names = [f"s{i}" for i in range(20)]
    owner = sharding.lookup_table(names, 10007)
    counts = np.bincount(owner)
    assert counts.max() - counts.min() <= 1
    fewer = sharding.lookup_table(names[:-1], 10007)
    stayed = (owner == fewer)[owner != 19].mean()
    assert stayed > 0.8


@pytest.mark.parametrize("shards, size", [([], 7), (["a", "a"], 7), (["a"], 8)])
def test_bad_tables_are_errors(shards, size):
    with pytest.raises(ValueError):
        sharding.lookup_table(shards, size)


def test_every_row_has_its_shard(spark):
    rows = [(1, "x"), (2, "y"), (None, "z"), (1, "w")]
    frame = spark.createDataFrame(rows, "doc_id BIGINT, shard STRING")
    found = sharding.place_on_shards(frame, ["a", "b", "c"], size=101).collect()
    owner = sharding.lookup_table(["a", "b", "c"], 101)
    assert len(found) == 4 and all(r["shard"] == "abc"[owner[r["slot"]]] for r in found)
    assert len({r["slot"] for r in found if r["doc_id"] == 1}) == 1
    assert sharding.place_on_shards(frame.limit(0), ["a"], size=7).count() == 0

"""Texts as codes: words in order, in little memory."""

import random

import numpy as np
import pyarrow as pa

from tallyloom.llm import chunk_words as cw


# Outlives what is allocated in it.
POOL = pa.proxy_memory_pool(pa.default_memory_pool())


def test_coded_texts_in_bounded_memory():
    draw = random.Random(5)
    vocabulary = ["w%d" % draw.randrange(5000) for _ in range(5000)]
    texts = ["", "!a\n", " "] + [" ".join(draw.choices(vocabulary, k=700)) for _ in range(1500)] + ["last A"]
    data = "".join(texts).encode()
    offsets = np.cumsum([0] + [len(t) for t in texts])
    before = pa.default_memory_pool()
    pa.set_memory_pool(POOL)
    try:
        words, codes = cw.coded(np.frombuffer(data, np.uint8), offsets, cw.byte_table(" ", "!"))
    finally:
        pa.set_memory_pool(before)
    # All words side by side take about twice this.
    assert POOL.max_memory() < 3 * len(data), (POOL.max_memory(), len(data))
    plain = [w for t in texts for w in [*t.lower().replace("!", "\n").replace("\n", " \n ").split(" "), "\n"] if w]
    known = {}
    for w in plain:
        if w != "\n":
            known.setdefault(w, len(known) + 1)
    assert words.to_pylist() == list(known)
    assert codes.tolist() == [known.get(w, cw.BREAK) for w in plain]
    assert cw.unpacked(cw.packed(codes, -codes))[1].tolist() == (-codes).tolist()

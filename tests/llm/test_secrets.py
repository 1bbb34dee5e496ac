"""Pattern matches against the patterns as given, and the character model."""

import hashlib
import random
import re
import time

from tallyloom.llm import secret_scan as sc
from tallyloom.llm.registry import QUERIES

DOCS = "doc_id BIGINT, text STRING, spans STRING, n_chars BIGINT"
ASSIGN = re.compile(r"""(?ai:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""")


def plain_base(text):
    found = [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= 12]
    found += [(m.start(), 1, m.end()) for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 18]
    found += [(m.start(), 2, m.end()) for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 16]
    return [f"{('assign', 'access', 'hex')[k]}:{s}:{e}" for s, k, e in sorted(found)]


def corpus():
    draw = random.Random(2)
    words = ["token", "Password", "api_key", "APIKEY", "prose", "deadbeef", "é", "secret", "passwd", "the", "facade"]
    texts = []
    for _ in range(120):
        parts = []
        for _ in range(draw.randint(0, 30)):
            kind = draw.random()
            if kind < 0.5:
                parts.append(draw.choice(words))
            elif kind < 0.6:
                parts.append(draw.choice([" = ", ":", '"=\'', "= "]) + "".join(draw.choice("0123456789abcdef") for _ in range(draw.randint(8, 30))))
            elif kind < 0.7:
                parts.append("AKIA" + "".join(draw.choice("ABCXYZ019") for _ in range(draw.randint(10, 18))))
            else:
                parts.append("".join(draw.choice("thereaonis") for _ in range(draw.randint(2, 9))))
            parts.append(draw.choice([" ", "", "\n"]))
        texts.append("".join(parts))
    return texts


def test_spans_of_a_corpus(spark):
    texts = corpus() + ["a", "0123456789abcde", "f0123456789abcdef", "token = 0123456789", "ſecret=abcdefghijklmnop"]
    draw = random.Random(7)
    letters = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789"
    texts += ["plain words secret = " + "".join(draw.choice(letters) for _ in range(30)) for _ in range(300)]
    random_string = "qX7zK2vB9tR4mW1pL8sD3fG6h"
    texts.append("the reason is here " * 50 + random_string)
    rows = [(i, t, "s", 0) for i, t in enumerate(texts)] + [(None, None, "s", None), (3, texts[3], None, 0), (9000, "", "", 0)]
    frame = spark.createDataFrame(rows, DOCS)
    model = sc.fit_random_model(frame)
    found = sc.find_secrets(frame, model).collect()
    assert len(found) == len(rows)
    by_text = {}
    for r in found:
        by_text.setdefault(r["doc_id"], []).append(r["spans"])
    for doc_id, text, _, _ in rows:
        for spans in by_text[doc_id]:
            base = [f"{s['kind']}:{s['start']}:{s['end']}" for s in spans if s["kind"] != "random"]
            assert base == plain_base(text or "")
            taken = [(s["start"], s["end"]) for s in spans if s["kind"] != "random"]
            for s in spans:
                if s["kind"] == "random":
                    assert all(s["end"] <= a or b <= s["start"] for a, b in taken)
    last = by_text[len(texts) - 1][0]
    assert [(s["kind"], texts[-1][s["start"] : s["end"]]) for s in last] == [("random", random_string)]
    clean = sc.redact_documents(frame, model)
    assert clean.columns == frame.columns and clean.schema == frame.schema
    for r in clean.collect():
        if r["doc_id"] is not None and r["doc_id"] < len(texts):
            original = texts[r["doc_id"]]
            if by_text[r["doc_id"]][0]:
                assert "[secret]" in r["text"] and r["n_chars"] == len(r["text"])
                assert not plain_base(r["text"]) or not any(k.startswith("hex") for k in plain_base(r["text"]))
            else:
                assert r["text"] == original


def test_the_model_does_not_depend_on_how_rows_are_dealt(spark):
    rows = [(k, t, "", 0) for k, t in enumerate(["abcdefghijkl", "mnopqrstuvwx", "", "yz", "some words", None, "next ones"] * 3)]
    frame = spark.createDataFrame(rows, DOCS)
    together, apart = (sc.fit_random_model(frame.repartition(n)).ratio for n in (1, 30))
    assert (together == apart).all()


def test_nothing_to_learn_from(spark):
    frame = spark.createDataFrame([], DOCS)
    assert sc.find_secrets(frame, sc.fit_random_model(frame)).count() == 0


def test_registered_query(spark, tables):
    docs = dict(tuple(r) for r in spark.read.parquet(f"{tables}/documents.parquet").select("doc_id", "text").collect())
    for r in QUERIES["op9_secrets"](spark, tables).collect():
        base = plain_base(docs[r["doc_id"]] or "")
        assert r["base_sha256"] == hashlib.sha256(",".join(base).encode()).hexdigest()
        assert (r["n_assign"], r["n_access"], r["n_hex"]) == tuple(sum(b.startswith(k) for b in base) for k in ("assign", "access", "hex"))
        listed = r["spans"].split(",") if r["spans"] else []
        assert [s for s in listed if not s.startswith("random")] == base


class EveryRun:
    """A model that takes every run, so that only the rule on overlaps decides."""

    def passes(self, run):
        return True


def test_random_runs_overlap_no_pattern():
    for text in corpus():
        base = sc.base_spans(text)
        plain = [
            (m.start(), m.end())
            for m in sc._RUN.finditer(text)
            if all(m.end() <= s or e <= m.start() for s, e, _ in base)
        ]
        assert [(s, e) for s, e, kind in sc.all_spans(text, EveryRun()) if kind == "random"] == plain


def test_many_patterns_in_one_text():
    text = " ".join(f"{k:016x} Run{k}xyzXYZabcdefgh0123" for k in range(40_000))
    start = time.process_time()
    found = sc.all_spans(text, EveryRun())
    # Every run against every pattern took minutes here.
    assert time.process_time() - start < 10
    assert sum(kind == "hex" for _, _, kind in found) >= 40_000

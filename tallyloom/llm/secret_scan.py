"""Secrets in text: fixed patterns, and strings that look random to a character model.

The patterns (kinds ``assign``, ``access``, ``hex``) are applied as given. Their matches are also the
labelled samples of random strings; runs of identifier
characters too short to be reported are the samples of ordinary ones. A first-order Markov
model of characters is counted for each kind over all documents, and a run of
identifier characters outside the pattern matches is reported as ``random`` if its
log-likelihood ratio is high enough in all and per character.

A null text is empty. Offsets are code points, ends exclusive. Extra columns are ignored.
"""

from __future__ import annotations

import re
from bisect import bisect_left
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import accumulate

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyloom.llm.words import text_chunks

# The patterns and their least lengths.
KINDS = ("assign", "access", "hex", "random")
_KEYWORD = r"([Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]|[Tt][Oo][Kk][Ee][Nn]|[Aa][Pp][Ii]_?[Kk][Ee][Yy])"
_ASSIGN = re.compile(_KEYWORD + r"""["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""")
_ACCESS = re.compile(r"AKIA[A-Z0-9]+")
_HEX = re.compile(r"[0-9a-f]+")
ASSIGN_LEAST, ACCESS_LEAST, HEX_LEAST = 12, 18, 16
_WORDS = (b"password", b"passwd", b"secret", b"token", b"api_key", b"apikey", b"akia")

# A random-looking run needs so many characters, and so much evidence in all and for each.
RUN_LEAST, LLR_LEAST, LLR_EACH = 16, 16.0, 0.7
BACK_OFF = 5.0
_RUN = re.compile(r"[A-Za-z0-9+/_=-]{%d,}" % RUN_LEAST)

_ALPHABET = b"ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_=-"
SYMBOLS = len(_ALPHABET) + 1
_CODE = np.zeros(256, np.int64)
_CODE[np.frombuffer(_ALPHABET, np.uint8)] = np.arange(1, SYMBOLS)
_IS_HEX = np.zeros(256, bool)
_IS_HEX[np.frombuffer(b"0123456789abcdef", np.uint8)] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32

Span = tuple[int, int, str]


def base_spans(text: str) -> list[Span]:
    """``start, end, kind`` of the pattern matches, by start and then kind."""
    found = [
        (m.start(), m.end(), "assign") for m in _ASSIGN.finditer(text) if m.end(2) - m.start(2) >= ASSIGN_LEAST
    ]
    found += [(m.start(), m.end(), "access") for m in _ACCESS.finditer(text) if m.end() - m.start() >= ACCESS_LEAST]
    found += [(m.start(), m.end(), "hex") for m in _HEX.finditer(text) if m.end() - m.start() >= HEX_LEAST]
    return sorted(found, key=lambda s: (s[0], KINDS.index(s[2])))


def _runs(inside: np.ndarray, least: int) -> tuple[np.ndarray, np.ndarray]:
    """``starts, ends`` of the runs of true values of at least ``least``."""
    edges = np.flatnonzero(np.diff(np.concatenate([[0], inside.view(np.int8), [0]])))
    starts, ends = edges[::2], edges[1::2]
    long = ends - starts >= least
    return starts[long], ends[long]


def _base_candidates(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Numbers of the texts that can hold a pattern match: a word of the patterns, or a run of hex digits.

    A run may reach over the end of a text, so more may be named than match.
    """
    at = [_runs(_IS_HEX[data], HEX_LEAST)[0]]
    lowered = _LOWER[data].tobytes()
    for word in _WORDS:
        at.append(np.array([m.start() for m in re.finditer(word, lowered)], np.int64))
    starts = np.concatenate(at)
    # A run that crosses texts counts for each of them.
    begins, ends = _runs(_IS_HEX[data], HEX_LEAST)
    first = np.searchsorted(offsets, begins, "right") - 1
    last = np.searchsorted(offsets, ends - 1, "right") - 1
    crossing = [np.arange(a, b + 1) for a, b in zip(first, last) if b > a]
    owners = np.searchsorted(offsets, starts, "right") - 1
    return np.unique(np.concatenate([owners, *crossing]).astype(np.int64))


def _text(data: np.ndarray, offsets: np.ndarray, k: int) -> str:
    return data[offsets[k] : offsets[k + 1]].tobytes().decode("utf-8", "replace")


def _pairs(codes: np.ndarray) -> np.ndarray:
    """Pairs of neighbouring symbols inside runs, as numbers; a run starts from symbol 0."""
    before = np.concatenate([[0], codes[:-1]])
    return (before * SYMBOLS + codes)[codes > 0]


@dataclass(frozen=True)
class RandomModel:
    """Log-likelihood ratio of each pair of symbols: random strings against ordinary ones."""

    ratio: np.ndarray

    def score(self, run: bytes) -> float:
        codes = _CODE[np.frombuffer(run, np.uint8)]
        return float(self.ratio[_pairs(codes)].sum())

    def passes(self, run: bytes) -> bool:
        value = self.score(run)
        return value >= LLR_LEAST and value >= LLR_EACH * len(run)


def ratio_from_counts(random: np.ndarray, ordinary: np.ndarray) -> np.ndarray:
    """Log-ratio of two transition tables of counts.

    To the counts of each row, ``BACK_OFF`` draws from the frequencies of single symbols are added (half a
    count for each symbol), so symbols that are rare as such stay rare after an unseen one.
    """

    def log_probability(counts: np.ndarray) -> np.ndarray:
        table = counts.reshape(SYMBOLS, SYMBOLS).astype(np.float64)
        single = table.sum(axis=0) + 0.5
        single[0] = 0
        table = table + BACK_OFF * single / single.sum()
        return np.log(np.maximum(table, 1e-300) / table.sum(axis=1, keepdims=True)).ravel()

    return log_probability(random) - log_probability(ordinary)


def fit_random_model(docs: DataFrame) -> RandomModel:
    """Count both models over all documents; a task sends at most one row per pair and model."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        random = np.zeros(SYMBOLS * SYMBOLS, np.int64)
        ordinary = np.zeros(SYMBOLS * SYMBOLS, np.int64)
        for batch in batches:
            for _, data, offsets in text_chunks(batch.column(0)):
                # Texts stand apart, so no run or pair reaches over the end of one.
                codes = np.insert(_CODE[data], offsets[1:-1], 0)
                for start, end in zip(*_runs(codes > 0, RUN_LEAST)):
                    codes[start:end] = 0
                ordinary += np.bincount(_pairs(codes), minlength=len(ordinary))
                for k in _base_candidates(data, offsets).tolist():
                    text = _text(data, offsets, k)
                    for start, end, kind in base_spans(text):
                        value = text[start:end]
                        if kind == "assign":
                            value = _ASSIGN.fullmatch(value).group(2).replace(".", "")
                        codes = _CODE[np.frombuffer(value.encode(), np.uint8)]
                        random += np.bincount(_pairs(codes), minlength=len(random))
        for model, counts in ((1, random), (0, ordinary)):
            used = np.flatnonzero(counts)
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.full(len(used), model), pa.int32()), pa.array(used, pa.int32()), pa.array(counts[used])],
                names=["model", "pair", "n"],
            )

    rows = (
        docs.select(F.coalesce(F.col("text"), F.lit("")).alias("text"))
        .mapInArrow(count, "model INT, pair INT, n BIGINT")
        .groupBy("model", "pair")
        .agg(F.sum("n").alias("n"))
        .collect()
    )
    counts = np.zeros((2, SYMBOLS * SYMBOLS))
    for r in rows:
        counts[r["model"], r["pair"]] = r["n"]
    return RandomModel(ratio_from_counts(counts[1], counts[0]))


def all_spans(text: str, model: RandomModel) -> list[Span]:
    """Pattern matches and random-looking runs that overlap none of them, by start and then kind."""
    base = base_spans(text)
    ordered = sorted((s, e) for s, e, _ in base)
    starts = [s for s, _ in ordered]
    # The furthest end among the first spans by start: spans of different kinds may overlap.
    reach = [0, *accumulate((e for _, e in ordered), max)]
    more = []
    for m in _RUN.finditer(text):
        clear = reach[bisect_left(starts, m.end())] <= m.start()
        if clear and model.passes(m.group().encode()):
            more.append((m.start(), m.end(), "random"))
    return sorted(base + more, key=lambda s: (s[0], KINDS.index(s[2])))


def _candidates(data: np.ndarray, offsets: np.ndarray, model: RandomModel) -> np.ndarray:
    """Numbers of the texts that can hold any span."""
    codes = _CODE[data]
    starts, ends = _runs(codes > 0, RUN_LEAST)
    crossing = np.searchsorted(offsets, starts, "right") < np.searchsorted(offsets, ends - 1, "right")
    before = np.concatenate([[0], codes[:-1]])
    total = np.concatenate([[0.0], np.cumsum(model.ratio[before * SYMBOLS + codes] * (codes > 0))])
    score = total[ends] - total[starts]
    maybe = crossing | ((score > LLR_LEAST - 1e-3) & (score > LLR_EACH * (ends - starts) - 1e-3))
    first = np.searchsorted(offsets, starts[maybe], "right") - 1
    last = np.searchsorted(offsets, ends[maybe] - 1, "right") - 1
    named = [np.arange(a, b + 1) for a, b in zip(first, last)]
    return np.unique(np.concatenate([_base_candidates(data, offsets), *named]).astype(np.int64))


def scan_batch(column: pa.Array, model: RandomModel) -> dict[int, tuple[str, list[Span]]]:
    """``row → text, spans`` for the rows of a batch that have spans."""
    found = {}
    for first, data, offsets in text_chunks(column):
        for k in _candidates(data, offsets, model).tolist():
            text = _text(data, offsets, k)
            spans = all_spans(text, model)
            if spans:
                found[first + k] = (text, spans)
    return found


def find_secrets(docs: DataFrame, model: RandomModel) -> DataFrame:
    """``doc_id, spans`` with the list of ``start, end, kind`` for every document."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    span = pa.struct([("start", pa.int64()), ("end", pa.int64()), ("kind", pa.string())])

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = scan_batch(batch.column(1), shared.value)
            spans = [
                [dict(zip(("start", "end", "kind"), s)) for s in found[k][1]] if k in found else []
                for k in range(batch.num_rows)
            ]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(spans, pa.list_(span))], names=["doc_id", "spans"]
            )

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(
        scan, 'doc_id BIGINT, spans ARRAY<STRUCT<start: BIGINT, `end`: BIGINT, kind: STRING>>'
    )


def redact(text: str, spans: list[Span], mark: str = "[secret]") -> str:
    """The text with every secret replaced; of an assignment, only the value goes."""
    out, done = [], 0
    for start, end, kind in spans:
        if kind == "assign":
            start = start + _ASSIGN.fullmatch(text[start:end]).start(2)
        if start < done:
            done = max(done, end)
            continue
        out += [text[done:start], mark]
        done = end
    return "".join([*out, text[done:]])


def redact_documents(docs: DataFrame, model: RandomModel) -> DataFrame:
    """The documents with secrets masked; columns as given, ``n_chars`` counted anew where the text changed."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    columns = docs.columns
    text_at = columns.index("text")
    chars_at = columns.index("n_chars") if "n_chars" in columns else None

    def mask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = scan_batch(batch.column(text_at), shared.value)
            arrays = list(batch.columns)
            if found:
                texts = batch.column(text_at).to_pylist()
                for k, (text, spans) in found.items():
                    texts[k] = redact(text, spans)
                arrays[text_at] = pa.array(texts, batch.schema.field(text_at).type)
                if chars_at is not None:
                    counts = batch.column(chars_at).to_pylist()
                    for k in found:
                        counts[k] = len(texts[k])
                    arrays[chars_at] = pa.array(counts, batch.schema.field(chars_at).type)
            yield pa.RecordBatch.from_arrays(arrays, names=columns)

    return docs.mapInArrow(mask, docs.schema)

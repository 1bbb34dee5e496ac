"""Text quality by positive-unlabelled learning.

Known are some good texts and a mass of web text of either kind. A small network with one
hidden layer is fitted by minimising the non-negative unbiased risk: the loss on the
positives, weighted by the class prior, plus the loss of calling unlabelled text bad
less the part of it that stems from good text hidden there; that difference is kept from
falling below zero. Bad texts are never shown as such.

The class prior is estimated as the least ratio, over thresholds of a first positive-against-unlabelled
classifier, of the unlabelled to the positive rows above the threshold, both counted on rows
left out of that fit.

A text is described by the shares of kinds of characters and marks, repeated and distinct words, and lengths.

The prior counts all documents. Two first classifiers are fitted, each on a half of the drawn rows, and score the other
half of the documents. The network is fitted on at most ``POSITIVES`` and ``UNLABELLED`` distinct rows (least hashes of id and text) with
their number of copies; unlabelled ones are weighted by the exact number of documents in their range of scores, so beyond the
bound the risk is that of a weighted sample. Null and empty texts are
described by zeros. Extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyloom.llm.linear import Logistic, fit_logistic, sigmoid
from tallyloom.llm.toxicity import labelled_rows
from tallyloom.llm.words import split_words, text_chunks
from tallyloom.operators.lineage import stored

POSITIVES, UNLABELLED = 20_000, 40_000
POSITIVE_SALT, UNLABELLED_SALT = 11, 12
HIDDEN, ROUNDS, RATE, DECAY = 16, 1500, 0.01, 1e-4

_MARKS = np.frombuffer(b"!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~", np.uint8)
_KIND = np.full(256, len(_MARKS), np.int64)
_KIND[_MARKS] = np.arange(len(_MARKS))
_KIND[np.frombuffer(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", np.uint8)] = len(_MARKS) + 1
_KIND[np.frombuffer(b"0123456789", np.uint8)] = len(_MARKS) + 2
_KIND[np.frombuffer(b" \t\r", np.uint8)] = len(_MARKS) + 3
_KIND[10] = len(_MARKS) + 4
_KIND[128:] = len(_MARKS) + 5
KINDS = len(_MARKS) + 6
WIDTH = KINDS + 6


def describe_texts(column: pa.Array) -> np.ndarray:
    """One row of ``WIDTH`` numbers per text."""
    out = np.zeros((len(column), WIDTH), np.float32)
    for first, data, offsets in text_chunks(column):
        n = len(offsets) - 1
        sizes = np.diff(offsets)
        owner = np.repeat(np.arange(n), sizes)
        counts = np.bincount(owner * KINDS + _KIND[data], minlength=n * KINDS).reshape(n, KINDS)
        part = out[first : first + n]
        part[:, :KINDS] = np.sqrt(counts / np.maximum(sizes, 1)[:, None])
        words = split_words(data, offsets)
        number = np.maximum(words.counts, 1)
        for lag in (1, 2):
            same = (words.hashes[lag:] == words.hashes[:-lag]) & (words.owner[lag:] == words.owner[:-lag])
            part[:, KINDS + lag - 1] = np.bincount(words.owner[lag:][same], minlength=n) / number
        order = np.lexsort((words.hashes, words.owner))
        hashes, owners = words.hashes[order], words.owner[order]
        new = np.concatenate([[True], (hashes[1:] != hashes[:-1]) | (owners[1:] != owners[:-1])])[: len(order)]
        distinct = np.bincount(owners[new], minlength=n)
        part[:, KINDS + 2] = np.where(words.counts > 0, np.log(np.maximum(distinct, 1)) / np.log(number + 1), 0)
        part[:, KINDS + 3] = np.log1p(words.counts) / 10
        part[:, KINDS + 4] = np.bincount(words.owner, words.ends - words.starts, minlength=n) / number / 10
        part[:, KINDS + 5] = sizes > 0
    return out


@dataclass(frozen=True)
class QualityModel:
    """A network of one hidden layer on standardised columns."""

    mean: np.ndarray
    scale: np.ndarray
    inner: np.ndarray
    inner_bias: np.ndarray
    outer: np.ndarray
    outer_bias: float
    prior: float

    def predict(self, x: np.ndarray) -> np.ndarray:
        z = np.clip((x - self.mean) / self.scale, -6, 6)
        return sigmoid(np.tanh(z @ self.inner + self.inner_bias) @ self.outer + self.outer_bias)


def score_cuts(positive: np.ndarray, least: float = 0.05) -> np.ndarray:
    """Thresholds, ascending: quantiles of the positive scores."""
    return np.quantile(positive, np.linspace(0, 1 - least, 200))


def shares_above(cuts: np.ndarray, scores: np.ndarray, weights: np.ndarray) -> np.ndarray:
    """Share of the weights whose scores reach each threshold."""
    ranges = np.bincount(np.searchsorted(cuts, scores, "right"), weights, len(cuts) + 1)
    return ranges[::-1].cumsum()[::-1][1:] / ranges.sum()


def least_ratio(p: np.ndarray, u: np.ndarray, n_p: float, n_u: float, least: float = 0.05) -> float:
    """The least ratio of the shares ``u`` to ``p`` over thresholds, each with a margin of two standard errors."""
    margin = 2 * (np.sqrt(u * (1 - u) / n_u) + np.sqrt(p * (1 - p) / n_p))
    best = int(np.argmin(np.where(p >= least - 1e-9, (u + margin) / np.maximum(p, 1e-9), np.inf)))
    return float(np.clip(u[best] / max(p[best], 1e-9), 0.01, 0.99))


def estimate_prior(positive: np.ndarray, unlabelled: np.ndarray, least: float = 0.05) -> float:
    """Share of positives among unlabelled rows, from scores on rows not fitted.

    Thresholds that fewer than ``least`` of the positives pass say too little.
    """
    if not len(positive) or not len(unlabelled):
        return 0.5
    cuts = score_cuts(positive, least)
    p, u = (shares_above(cuts, x, np.ones(len(x))) for x in (positive, unlabelled))
    return least_ratio(p, u, len(positive), len(unlabelled), least)


def fit_network(
    positive: np.ndarray,
    unlabelled: np.ndarray,
    prior: float,
    rounds: int = ROUNDS,
    seed: int = 7,
    weights: tuple[np.ndarray, np.ndarray] | None = None,
) -> QualityModel:
    """Minimise the non-negative unbiased risk with adaptive gradient steps over all given rows, each with its weight."""
    both = np.concatenate([positive, unlabelled])
    wp, wu = weights or (np.ones(len(positive)), np.ones(len(unlabelled)))
    wp, wu = (wp / wp.sum()).astype(np.float32), (wu / wu.sum()).astype(np.float32)
    every = np.concatenate([wp * len(positive), wu * len(unlabelled)]) / len(both)
    mean = every @ both
    scale = np.sqrt(every @ (both - mean) ** 2)
    scale[scale < 1e-6] = 1.0
    xp, xu = (np.clip((x - mean) / scale, -6, 6) for x in (positive, unlabelled))
    draw = np.random.default_rng(seed)
    parts = [
        draw.normal(0, 1 / np.sqrt(xp.shape[1]), (xp.shape[1], HIDDEN)).astype(np.float32),
        np.zeros(HIDDEN, np.float32),
        draw.normal(0, 1 / np.sqrt(HIDDEN), HIDDEN).astype(np.float32),
        np.zeros(1, np.float32),
    ]
    first, second = [np.zeros_like(p) for p in parts], [np.zeros_like(p) for p in parts]

    def gradient(x: np.ndarray, hidden: np.ndarray, slope: np.ndarray) -> list[np.ndarray]:
        back = np.outer(slope, parts[2]) * (1 - hidden**2)
        return [x.T @ back, back.sum(axis=0), hidden.T @ slope, np.array([slope.sum()])]

    for step in range(1, rounds + 1):
        hp, hu = np.tanh(xp @ parts[0] + parts[1]), np.tanh(xu @ parts[0] + parts[1])
        fp, fu = hp @ parts[2] + parts[3], hu @ parts[2] + parts[3]
        sp, su = sigmoid(fp), sigmoid(fu)
        hidden_risk = wu @ np.logaddexp(0, fu) - prior * (wp @ np.logaddexp(0, fp))
        if hidden_risk >= 0:
            slope_p = (prior * (sp - 1) - prior * sp) * wp
            slope_u = su * wu
        else:
            # The part that cannot be negative has become so: step back on it alone.
            slope_p, slope_u = prior * sp * wp, -su * wu
        moves = [a + b for a, b in zip(gradient(xp, hp, slope_p), gradient(xu, hu, slope_u))]
        for k, move in enumerate(moves):
            move = move + DECAY * parts[k]
            first[k] = 0.9 * first[k] + 0.1 * move
            second[k] = 0.999 * second[k] + 0.001 * move**2
            rate = RATE * np.sqrt(1 - 0.999**step) / (1 - 0.9**step)
            parts[k] = (parts[k] - rate * first[k] / (np.sqrt(second[k]) + 1e-8)).astype(np.float32)
    return QualityModel(mean, scale, parts[0], parts[1], parts[2], float(parts[3][0]), prior)


def _drawn(rows: DataFrame, salt: int) -> DataFrame:
    """``drawn, half, text``: a hash of id and text, and one of two halves by it."""
    text = F.coalesce(F.col("text"), F.lit(""))
    drawn = F.xxhash64(F.col("doc_id").cast("long"), F.col("doc_id").isNull(), text, F.lit(salt))
    return rows.select(drawn.alias("drawn"), text.alias("text")).withColumn("half", F.pmod(F.xxhash64("drawn"), F.lit(2)).cast("int"))


def _described(rows: DataFrame, most: int, salt: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Descriptions, copies and halves of at most about ``most`` distinct rows, those with the least hashes; copies are exact."""

    def describe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = describe_texts(batch.column(2))
            listed = pa.FixedSizeListArray.from_arrays(pa.array(x.ravel()), WIDTH).cast(pa.list_(pa.float32()))
            yield pa.RecordBatch.from_arrays([*batch.columns[:2], listed], names=["drawn", "half", "x"])

    keyed = _drawn(rows, salt)
    copies = stored(keyed.groupBy("drawn").agg(F.count(F.lit(1)).alias("n")))
    # The bound is found on counts by the first bits of the hashes, so no rows meet in one task.
    bucket = F.shiftrightunsigned("drawn", 48)
    sizes = sorted((r["bucket"], r["count"]) for r in copies.groupBy(bucket.alias("bucket")).count().collect())
    fits = np.cumsum([n for _, n in sizes]) <= most
    last = sizes[max(1, int(fits.sum())) - 1][0] if sizes else -1
    taken = keyed.filter(bucket <= last).dropDuplicates(["drawn"]).select("drawn", "half", "text")
    described = taken.mapInArrow(describe, "drawn BIGINT, half INT, x ARRAY<FLOAT>")
    found = sorted(described.join(copies, "drawn").collect(), key=lambda r: r["drawn"])
    return (
        np.array([r["x"] for r in found], np.float32).reshape(-1, WIDTH),
        np.array([r["n"] for r in found], np.float64),
        np.array([r["half"] for r in found], np.int64),
    )


def _rough_scores(rough: list[Logistic], x: np.ndarray, half: np.ndarray) -> np.ndarray:
    """Scores of rows by the classifier that was fitted on the other half."""
    z = x.astype(np.float64)
    z = np.column_stack([z, z**2])
    return np.where(half == 0, rough[1].predict(z), rough[0].predict(z))


def _count_ranges(docs: DataFrame, rough: list[Logistic], cuts: np.ndarray) -> np.ndarray:
    """Documents between each two thresholds, all of them counted; a task sends one row."""
    shared = docs.sparkSession.sparkContext.broadcast((rough, cuts))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rough, cuts = shared.value
        counts = np.zeros(len(cuts) + 1, np.int64)
        for batch in batches:
            scores = _rough_scores(rough, describe_texts(batch.column(1)), batch.column(0).to_numpy())
            counts += np.bincount(np.searchsorted(cuts, scores, "right"), minlength=len(counts))
        used = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays([pa.array(used), pa.array(counts[used])], names=["range", "n"])

    rows = _drawn(docs, UNLABELLED_SALT).select("half", "text").mapInArrow(count, "range BIGINT, n BIGINT")
    counts = np.zeros(len(cuts) + 1)
    for r in rows.groupBy("range").agg(F.sum("n").alias("n")).collect():
        counts[r["range"]] = r["n"]
    return counts


def fit_quality(docs: DataFrame, labels: DataFrame) -> QualityModel:
    """Fit on the documents labelled good, and on all documents as unlabelled text.

    ``labels`` has ``doc_id, quality``; only rows with quality 1 are used.
    """
    good = labelled_rows(docs, labels, "quality").filter("y = 1")
    positive, copies_p, half_p = _described(good, POSITIVES, POSITIVE_SALT)
    if len(positive):
        unlabelled, copies_u, half_u = _described(docs, UNLABELLED, UNLABELLED_SALT)
    if not len(positive) or not len(unlabelled):
        zeros = np.zeros(WIDTH)
        return QualityModel(zeros, zeros + 1, np.zeros((WIDTH, 1)), np.zeros(1), np.zeros(1), 0.0, 0.5)
    rough = []
    for half in (0, 1):
        x = np.concatenate([positive[half_p == half], unlabelled[half_u == half]]).astype(np.float64)
        y = np.concatenate([np.ones((half_p == half).sum()), np.zeros((half_u == half).sum())])
        rough.append(fit_logistic(np.column_stack([x, x**2]), y))
    scores_p = _rough_scores(rough, positive, half_p)
    cuts = np.unique(score_cuts(scores_p))
    ranges = _count_ranges(docs, rough, cuts)
    above = ranges[::-1].cumsum()[::-1][1:] / ranges.sum()
    prior = least_ratio(shares_above(cuts, scores_p, copies_p), above, copies_p.sum(), ranges.sum())
    # Rows drawn stand for all documents in their range of scores.
    place = np.searchsorted(cuts, _rough_scores(rough, unlabelled, half_u), "right")
    drawn = np.bincount(place, copies_u, len(ranges))
    weights = copies_u * (ranges / np.maximum(drawn, 1))[place]
    return fit_network(positive, unlabelled, prior, weights=(copies_p, weights))


def score_quality(docs: DataFrame, model: QualityModel) -> DataFrame:
    """``doc_id, score`` for every document."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            values = shared.value.predict(describe_texts(batch.column(1))).astype(np.float64)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(values)], names=["doc_id", "score"])

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    return rows.mapInArrow(score, "doc_id BIGINT, score DOUBLE")

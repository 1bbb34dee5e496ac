"""Toxicity by compression distance with two zstandard dictionaries.

A text is cut into windows, its words. A window is written in a wide code (eight bytes for each
three neighbouring letters, so that what is not in a dictionary costs far more
than a match) and compressed twice: with a dictionary trained on toxic text and
with one trained on ordinary text. The difference of the two lengths says how
much better toxic text explains the window.

*Samples.* Document frequencies of windows are counted over all labelled rows. The toxic dictionary is
trained on the windows of toxic rows that are significantly more frequent there than in
ordinary rows (likelihood ratio), the ordinary one on the most frequent windows
of ordinary rows. At most ``toxic_windows`` and ``ordinary_windows`` of them, the best, are
used, since dictionaries have a fixed size.

*Threshold.* A text is described by its greatest differences and the number of windows above a
margin. A logistic curve over them, and a rising curve from its values to shares of toxic rows, are fitted on up to ``calibration_rows`` distinct labelled rows
(least hashes of id and text, each with its number of copies), each scored by dictionaries from the other half of the rows, so
that no row is judged by samples taken from itself.

Null and empty texts have no windows and get a low score. Rows without label, or with a
null label or id, are not learned from; of several labels for an id the greatest counts. Without rows of both
kinds, all scores are the share of toxic rows. Extra columns are ignored.
"""

from __future__ import annotations

import random
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyloom.llm.linear import Logistic, RisingCurve, fit_logistic, fit_rising_curve
from tallyloom.llm.words import mix, split_words, text_chunks
from tallyloom.operators.lineage import stored

TOXIC_WINDOWS, ORDINARY_WINDOWS = 20_000, 60_000
TOXIC_BYTES, ORDINARY_BYTES = 64 * 1024, 400_000
LEAST_EVIDENCE = 12.0
CALIBRATION_ROWS = 20_000
# Labels up to this number go to every task; more are joined by key.
BROADCAST_LABELS = 1_000_000
MARGIN = 8
# Windows whose difference a worker remembers.
REMEMBERED = 200_000

_U = np.uint64


def window_code(word: bytes) -> bytes:
    """The wide code of a window, with a blank on both sides."""
    letters = np.frombuffer(b" " + word + b" ", np.uint8).astype(_U)
    triples = letters[:-2] | letters[1:-1] << _U(8) | letters[2:] << _U(16)
    return mix((triples + _U(1)) * _U(0x9E3779B97F4A7C15)).tobytes()


def train_dictionary(windows: list[tuple[bytes, int]], size: int) -> bytes:
    """A dictionary from windows with their weight in samples; too few samples make up a plain one."""
    samples = [code for word, n in windows for code in [window_code(word)] * n]
    # The trainer takes its pieces from one stretch of the samples after another, so these must be alike.
    random.Random(size).shuffle(samples)
    if samples:
        samples *= max(1, 3000 // len(samples))
    try:
        return zstandard.train_dictionary(size, samples, k=64, d=8).as_bytes()
    except (zstandard.ZstdError, ValueError):
        return b"".join(dict.fromkeys(samples))[-size:] or b"\0" * 8


def _compressor(dictionary: bytes) -> zstandard.ZstdCompressor:
    parameters = zstandard.ZstdCompressionParameters.from_level(
        3, format=zstandard.FORMAT_ZSTD1_MAGICLESS, write_content_size=False, write_checksum=False, write_dict_id=False
    )
    data = zstandard.ZstdCompressionDict(dictionary)
    return zstandard.ZstdCompressor(compression_params=parameters, dict_data=data)


@dataclass
class WindowScorer:
    """Difference of the two compressed lengths of windows; compressors are made where they are used."""

    toxic: bytes
    ordinary: bytes
    _compressors: tuple = field(default=(), repr=False)
    _known: dict[int, int] = field(default_factory=dict, repr=False)

    def __getstate__(self) -> dict:
        return {"toxic": self.toxic, "ordinary": self.ordinary, "_compressors": (), "_known": {}}

    def difference(self, word: bytes) -> int:
        if not self._compressors:
            self._compressors = (_compressor(self.ordinary), _compressor(self.toxic))
        code = window_code(word)
        ordinary, toxic = (len(c.compress(code)) for c in self._compressors)
        return ordinary - toxic

    def features(self, column: pa.Array) -> np.ndarray:
        """Per text: the three greatest differences of distinct windows, the logarithms of the number above the margin and of all windows."""
        out = np.zeros((len(column), 5))
        for first, data, offsets in text_chunks(column):
            words = split_words(data, offsets)
            distinct, at, inverse = np.unique(words.hashes, return_index=True, return_inverse=True)
            values = np.zeros(len(distinct), np.int32)
            for k, (h, w) in enumerate(zip(distinct.tolist(), at.tolist())):
                v = self._known.get(h)
                if v is None:
                    v = self.difference(words.lowered[words.starts[w] : words.ends[w]].tobytes())
                    if len(self._known) >= REMEMBERED:
                        self._known.clear()
                    self._known[h] = v
                values[k] = v
            out[first : first + len(words.counts), 4] = np.log1p(words.counts)
            each = values[inverse]
            some = np.flatnonzero(each > 0)
            if len(some):
                keys = np.unique(np.stack([words.owner[some], -each[some], inverse[some]]), axis=1)
                owner, negative = keys[0], keys[1]
                rank = np.arange(len(owner)) - np.searchsorted(owner, owner)
                for r in range(3):
                    top = rank == r
                    out[first + owner[top], r] = -negative[top]
                np.add.at(out[:, 3], first + owner[-negative >= MARGIN], 1)
        out[:, 3] = np.log1p(out[:, 3])
        return out


@dataclass(frozen=True)
class ToxicityModel:
    scorer: WindowScorer
    curve: Logistic
    shares: RisingCurve

    def score(self, column: pa.Array) -> np.ndarray:
        return self.shares.predict(self.curve.predict(self.scorer.features(column)))


def labelled_rows(docs: DataFrame, labels: DataFrame, label: str) -> DataFrame:
    """``doc_id, y, text`` of the rows with a label."""
    known = (
        labels.filter(F.col(label).isNotNull() & F.col("doc_id").isNotNull())
        .groupBy(F.col("doc_id").cast("long").alias("doc_id"))
        .agg(F.max(F.col(label).cast("int")).alias("y"))
    )
    small = labels.count() <= BROADCAST_LABELS
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    return rows.join(F.broadcast(known) if small else known, "doc_id").select("doc_id", "y", "text")


def _frequencies(rows: DataFrame) -> DataFrame:
    """Documents that hold each window, by label and half: ``word, t0, t1, o0, o1``."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            kind = batch.column(0).to_numpy(zero_copy_only=False).astype(np.int64)
            for first, data, offsets in text_chunks(batch.column(1)):
                words = split_words(data, offsets)
                distinct, at, inverse = np.unique(words.hashes, return_index=True, return_inverse=True)
                pairs = np.unique(words.owner * len(distinct) + inverse)
                owner, word = pairs // max(len(distinct), 1), pairs % max(len(distinct), 1)
                n = np.zeros((4, len(distinct)), np.int64)
                np.add.at(n, (kind[first + owner], word), 1)
                texts = [words.lowered[words.starts[w] : words.ends[w]].tobytes() for w in at.tolist()]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(texts, pa.binary()), *map(pa.array, n)], names=["word", "o0", "o1", "t0", "t1"]
                )

    kind = F.col("y") * 2 + F.col("half")
    counted = rows.select(kind.alias("kind"), "text").mapInArrow(
        count, "word BINARY, o0 BIGINT, o1 BIGINT, t0 BIGINT, t1 BIGINT"
    )
    return counted.groupBy("word").agg(*[F.sum(c).alias(c) for c in ("o0", "o1", "t0", "t1")])


def _evidence(t: Column, n_toxic: int, o: Column, n_ordinary: int) -> Column:
    """Likelihood ratio of a window's frequencies in toxic and ordinary rows; negative if it is rarer in toxic ones."""
    share = (t + o) / float(n_toxic + n_ordinary)

    def term(seen: Column, expected: Column) -> Column:
        return F.when(seen > 0, seen * F.log(seen / expected)).otherwise(0.0)

    value = 2 * (
        term(t, share * n_toxic)
        + term(o, share * n_ordinary)
        + term(n_toxic - t, (1 - share) * n_toxic)
        + term(n_ordinary - o, (1 - share) * n_ordinary)
    )
    return F.when(t * n_ordinary > o * n_toxic, value).otherwise(-value)


def _train(
    counted: DataFrame, n: dict[str, int], halves: tuple[str, ...], toxic_windows: int, ordinary_windows: int
) -> WindowScorer:
    """Dictionaries from the rows of the given halves; what comes to the driver is bounded by the two numbers of windows."""
    toxic, ordinary = (sum((F.col(k + h) for h in halves), F.lit(0)) for k in "to")
    n_toxic, n_ordinary = (sum(n[k + h] for h in halves) for k in "to")
    rows = counted.select("word", toxic.alias("t"), ordinary.alias("o"))
    telling = (
        rows.filter("t >= 2")
        .withColumn("g", _evidence(F.col("t"), n_toxic, F.col("o"), n_ordinary))
        .filter(F.col("g") >= LEAST_EVIDENCE)
        .orderBy(F.desc("g"), "word")
        .limit(toxic_windows)
        .collect()
    )
    common = rows.filter("o > 0").orderBy(F.desc("o"), "word").limit(ordinary_windows).collect()
    total = max(1, sum(r["o"] for r in common))
    return WindowScorer(
        train_dictionary([(bytes(r["word"]), min(r["t"], 50)) for r in telling], TOXIC_BYTES),
        train_dictionary([(bytes(r["word"]), max(1, r["o"] * 200_000 // total)) for r in common], ORDINARY_BYTES),
    )


def calibration_sample(rows: DataFrame, most: int) -> DataFrame:
    """``y, half, text, copies`` of at most ``most`` distinct rows: those with the least hashes of id and text."""
    keyed = rows.withColumn("drawn", F.xxhash64("doc_id", "text", F.lit(1)))
    # The bound on the hash is found on hashes alone, so no texts meet in one task.
    hashes = keyed.select("drawn").distinct().orderBy("drawn").limit(most)
    last = hashes.agg(F.max("drawn")).first()[0]
    taken = keyed.filter(F.col("drawn") <= last) if last is not None else keyed.limit(0)
    listed = [F.first(c).alias(c) for c in ("y", "half", "text")]
    return taken.groupBy("drawn").agg(*listed, F.count(F.lit(1)).alias("copies")).drop("drawn")


def fit_toxicity(
    docs: DataFrame,
    labels: DataFrame,
    calibration_rows: int = CALIBRATION_ROWS,
    toxic_windows: int = TOXIC_WINDOWS,
    ordinary_windows: int = ORDINARY_WINDOWS,
) -> ToxicityModel:
    """Fit on all labelled rows of ``docs``; ``labels`` has ``doc_id, toxic``.

    The three numbers bound what comes to the driver, however often a row or an id is repeated.
    """
    half = F.pmod(F.xxhash64("doc_id"), F.lit(2)).cast("int")
    rows = labelled_rows(docs, labels, "toxic").withColumn("half", half)
    n = {k + h: 0 for k in "to" for h in "01"}
    for r in rows.groupBy("y", "half").count().collect():
        n[("t" if r["y"] else "o") + str(r["half"])] = r["count"]
    counted = stored(_frequencies(rows))
    scorers = [_train(counted, n, h, toxic_windows, ordinary_windows) for h in (("1",), ("0",), ("0", "1"))]
    shared = docs.sparkSession.sparkContext.broadcast(scorers[:2])

    def describe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            halves = batch.column(1).to_numpy(zero_copy_only=False)
            x = np.zeros((batch.num_rows, 5))
            for h in (0, 1):
                own = np.flatnonzero(halves == h)
                x[own] = shared.value[h].features(batch.column(2).take(pa.array(own)))
            listed = pa.array(x.tolist(), pa.list_(pa.float64()))
            yield pa.RecordBatch.from_arrays([batch.column(0), listed, batch.column(3)], names=["y", "x", "copies"])

    sample = calibration_sample(rows, calibration_rows).select("y", "half", "text", "copies")
    described = sample.mapInArrow(describe, "y INT, x ARRAY<DOUBLE>, copies BIGINT").collect()
    x = np.array([r["x"] for r in described], float).reshape(-1, 5)
    y = np.array([float(r["y"] > 0) for r in described])
    copies = np.array([float(r["copies"]) for r in described])
    curve = fit_logistic(x, y, copies=copies)
    return ToxicityModel(scorers[2], curve, fit_rising_curve(curve.predict(x), y, copies))


def score_texts(docs: DataFrame, model: ToxicityModel) -> DataFrame:
    """``doc_id, score`` for every document."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(shared.value.score(batch.column(1)))], names=["doc_id", "score"]
            )

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    return rows.mapInArrow(score, "doc_id BIGINT, score DOUBLE")


def drop_toxic(docs: DataFrame, model: ToxicityModel, threshold: float) -> DataFrame:
    """The documents that score below the threshold, columns as given."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    text_at = docs.columns.index("text")

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield batch.filter(pa.array(shared.value.score(batch.column(text_at)) < threshold))

    return docs.mapInArrow(keep, docs.schema)

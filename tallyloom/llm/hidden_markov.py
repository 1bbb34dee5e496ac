"""A hidden Markov language model, trained by Baum-Welch counts that tasks add up over all training texts.

A text is its words and one end. A state emits a class, a class emits a word. The most frequent words and the end are classes of
their own; other words share the class of their ending, within which a word has its share of the class's occurrences after absolute discounting,
and what is discounted goes to words not seen in training. So the tables of a model have a fixed size, states times classes, that is
sent to every task, while the counts of words, which grow with the corpus, are summed by Spark and reach
the texts by a join of chunk dictionaries (see ``chunk_words``). They cover all training texts.

Rounds: the first pass takes the documents in ``PARTS`` parts by their ids, a round of Baum-Welch for each; then come
``FULL_ROUNDS`` rounds over all training texts. Forward and backward recursions run over many texts
in step, scaled at each word. A very long text is cut into blocks, whose transfer matrices give the exact values at their borders,
so no probability is approximated by cutting, and memory does not grow with a text's length beyond its words.

Rows: a null text is empty and has one token, its end. A null ``doc_id`` is not held out. Repeated rows are scored alike and
count as often as they stand there; an empty table gives no rows; without training texts every word is unknown. Other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, replace

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyloom.llm.chunk_words import BREAK, byte_table, coded, one_row, packed, unpacked
from tallyloom.llm.words import text_chunks
from tallyloom.operators.lineage import discard, stored

# Shape of a model: states, words with a class of their own (of so many bytes at most, and at least so frequent that states can
# be told apart by them), classes of other words by their ending.
STATES = 16
HEAD_WORDS, HEAD_BYTES, HEAD_LEAST = 1 << 14, 64, 20
ENDINGS, ENDING_LENGTH = 1 << 12, 3

# Parts of the first pass, and rounds over all training texts after it.
PARTS, FULL_ROUNDS = 8, 1

# Taken from each count of a word that shares its class, and pseudo-counts of a state's classes and moves.
DISCOUNT, CLASS_WEIGHT, MOVE_WEIGHT = 0.75, 100.0, 1.0

# Bytes of text in a chunk; words of a text that go in step, and of its blocks if it has more; words in work at once, of those
# held to choose texts of like lengths from.
CHUNK_BYTES = 1 << 24
LONG_TEXT, BLOCK, GROUP, HELD = 1 << 14, 1 << 11, 1 << 19, 1 << 22

# Fixed value: signs between words.
BETWEEN = " \t\n\x0b\x0c\r"

END_CLASS = 0


@dataclass(frozen=True)
class Chain:
    """Start, moves (from, to) and emissions (class, state) of a hidden Markov model."""

    start: np.ndarray
    moves: np.ndarray
    emits: np.ndarray

    def single(self) -> Chain:
        """In single precision, enough for expected counts and twice as fast."""
        return Chain(*(a.astype(np.float32) for a in (self.start, self.moves, self.emits)))


@dataclass(frozen=True)
class Counts:
    """Expected counts of a chain's events, with the natural log likelihood they come from."""

    start: np.ndarray
    moves: np.ndarray
    emits: np.ndarray
    likelihood: float = 0.0

    @staticmethod
    def none(states: int, classes: int) -> Counts:
        return Counts(np.zeros(states), np.zeros((states, states)), np.zeros((classes, states)))

    def scaled(self, factor: float) -> Counts:
        return Counts(self.start * factor, self.moves * factor, self.emits * factor, self.likelihood)


@dataclass(frozen=True)
class Vocabulary:
    """What training texts say on words: each chunk's words as ``chunk, at, c, class``, and small tables by class."""

    words: DataFrame
    tokens: int
    distinct: int
    texts: int
    class_counts: np.ndarray
    class_words: np.ndarray


# --- texts to chunks ----------------------------------------------------------


def _chunks(docs: DataFrame, held_out: Column) -> DataFrame:
    """Texts as coded chunks, with the counts of words in training texts."""
    table = byte_table(BETWEEN, "")
    id_type = docs.schema["doc_id"].dataType.simpleString()
    schema = f"chunk LONG, docs ARRAY<STRUCT<doc_id: {id_type}, held_out: BOOLEAN, part: INT>>, words ARRAY<STRING>, counts ARRAY<LONG>, codes BINARY"

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId() << 33
        for batch in batches:
            about = pa.StructArray.from_arrays(batch.columns[:3], names=["doc_id", "held_out", "part"])
            for first, data, offsets in text_chunks(batch.column(3), CHUNK_BYTES):
                words, codes = coded(data, offsets, table)
                here = about.slice(first, len(offsets) - 1)
                trains = ~here.field("held_out").to_numpy(zero_copy_only=False)
                ends = np.flatnonzero(codes == BREAK) + 1
                trained = codes[np.repeat(trains, np.diff(ends, prepend=0))]
                counts = np.bincount(trained, minlength=len(words) + 1)[1:]
                del trained
                yield one_row(chunk=number, docs=here, words=words, counts=counts, codes=packed(codes))
                number += 1

    held = F.coalesce(held_out, F.lit(False))
    part = F.coalesce(F.crc32(F.col("doc_id").cast("string")), F.lit(0)).cast("long")
    # The remainder by seven may already decide what is held out, so parts go by the quotient.
    part = (F.call_function("div", part, F.lit(7).cast("long")) % PARTS).cast("int")
    return docs.select("doc_id", held.alias("held_out"), part.alias("part"), "text").mapInArrow(cut, schema)


def count_words(chunks: DataFrame) -> Vocabulary:
    """Counts of all words of training texts, and their classes.

    Rows of the dictionaries meet once by word: a word has one row for each chunk it is in, and all get its count.
    """
    spark = chunks.sparkSession
    texts = chunks.select(F.size(F.filter("docs", lambda d: ~d["held_out"])).alias("n")).agg(F.sum("n")).first()[0] or 0
    rows = chunks.select("chunk", F.posexplode(F.arrays_zip("words", "counts")).alias("at", "w"))
    alike = Window.partitionBy("word")
    ending = F.crc32(F.substring("word", -ENDING_LENGTH, ENDING_LENGTH).cast("binary")) % ENDINGS + (1 + HEAD_WORDS)
    words = stored(
        rows.select("chunk", "at", F.col("w.words").alias("word"), F.col("w.counts").alias("n"))
        .select("chunk", "at", "word", F.sum("n").over(alike).alias("c"), (F.col("chunk") == F.min("chunk").over(alike)).alias("once"))
        .withColumn("ending", ending.cast("int"))
    )
    each = words.filter("once AND c > 0")
    frequent = each.filter((F.octet_length("word") <= HEAD_BYTES) & (F.col("c") >= HEAD_LEAST))
    head = frequent.orderBy(F.desc("c"), "word").limit(HEAD_WORDS).select("word", "c", "ending").collect()
    class_counts, class_words = np.zeros((2, 1 + HEAD_WORDS + ENDINGS))
    # One row per ending, without the words that have a class of their own.
    for r in each.groupBy("ending").agg(F.sum("c").alias("c"), F.count(F.lit(1)).alias("n")).collect():
        class_counts[r["ending"]], class_words[r["ending"]] = r["c"], r["n"]
    class_counts[END_CLASS] = texts
    for i, r in enumerate(head, start=1):
        class_counts[i], class_words[i] = r["c"], 1
        class_counts[r["ending"]] -= r["c"]
        class_words[r["ending"]] -= 1
    # A bounded number of short words.
    own = F.broadcast(spark.createDataFrame([(r["word"], i) for i, r in enumerate(head, start=1)], "word STRING, own INT"))
    classed = words.join(own, "word", "left").select("chunk", "at", "c", F.coalesce("own", "ending").alias("class"))
    return Vocabulary(classed, int(class_counts.sum()), int(class_words.sum()) + (texts > 0), texts, class_counts, class_words)


def _gathered(words: DataFrame) -> DataFrame:
    """``chunk, found``: counts and classes of each chunk's words in their order, packed.

    Sorted rows go by one batch at a time, so no task has the rows of its chunks as objects.
    """

    def gather(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, parts = None, []

        def row() -> pa.RecordBatch:
            return one_row(chunk=held, found=packed(*map(np.concatenate, zip(*parts))))

        for batch in batches:
            chunk, c, klass = (column.to_numpy() for column in batch.columns)
            firsts = np.flatnonzero(np.diff(chunk, prepend=chunk[:1] - 1)).tolist()
            for first, last in zip(firsts, [*firsts[1:], len(chunk)]):
                if held is not None and held != chunk[first]:
                    yield row()
                    parts = []
                held = int(chunk[first])
                parts.append((c[first:last].copy(), klass[first:last].copy()))
        if held is not None:
            yield row()

    rows = words.repartition("chunk").sortWithinPartitions("chunk", "at").select("chunk", "c", "class")
    return rows.mapInArrow(gather, "chunk LONG, found BINARY")


def encode(chunks: DataFrame, known: Vocabulary) -> DataFrame:
    """Chunks as sequences of classes, with what each text's words say without the chain: ``docs, classes``."""
    context = chunks.sparkSession.sparkContext
    shared = context.broadcast((known.class_counts, known.class_words))
    tokens, distinct, texts = known.tokens, known.distinct, known.texts
    id_type = chunks.schema["docs"].dataType.elementType["doc_id"].dataType.simpleString()
    fields = f"doc_id: {id_type}, held_out: BOOLEAN, part: INT, n_tokens: LONG, n_known: LONG, base: DOUBLE, within: DOUBLE"

    def recode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        class_counts, class_words = shared.value
        for batch in batches:
            for i in range(batch.num_rows):
                docs = batch.column("docs")[i].values
                codes = unpacked(batch.column("codes")[i].as_py())[0]
                found = batch.column("found")[i].as_py()
                # Counts and classes by code; the first stands for the end of a text.
                count, number = (np.append(first, v) for first, v in zip((texts, END_CLASS), unpacked(found) if found else ([], [])))
                count, number = count.astype(np.int64), number.astype(np.int64)
                total = class_counts[number] + 1
                within = np.log10(np.where(count > 0, count - DISCOUNT, DISCOUNT * class_words[number] + 1) / total, where=number > HEAD_WORDS, out=np.zeros(len(number)))
                base = np.log10((count + 1) / (tokens + distinct + 1))
                firsts = np.concatenate([[0], np.flatnonzero(codes == BREAK)[:-1] + 1])
                sums = [np.add.reduceat(values[codes], firsts) for values in ((count > 0).astype(np.int64), base, within)]
                names = ["n_tokens", "n_known", "base", "within"]
                columns = [pa.array(v) for v in (np.diff(np.append(firsts, len(codes))), *sums)]
                plain = [docs.field(n) for n in ("doc_id", "held_out", "part")]
                rows = pa.StructArray.from_arrays(plain + columns, names=["doc_id", "held_out", "part", *names])
                yield one_row(docs=rows, classes=packed(number[codes]))

    encoded = stored(chunks.drop("words", "counts").join(_gathered(known.words), "chunk", "left").mapInArrow(recode, f"docs ARRAY<STRUCT<{fields}>>, classes BINARY"))
    shared.destroy()
    return encoded


# --- recursions ---------------------------------------------------------------


@dataclass
class _Items:
    """Stretches of words that go in step, the longest first: where they start, their lengths, and the state before them."""

    starts: np.ndarray
    lengths: np.ndarray
    before: np.ndarray

    def active(self) -> np.ndarray:
        """Number of stretches that have a word at each step."""
        steps = np.arange(self.lengths[0] if len(self.lengths) else 0)
        return np.searchsorted(-self.lengths, -steps, "left")


def _forward(chain: Chain, classes: np.ndarray, items: _Items, alpha: np.ndarray | None = None, scale: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """State distribution after each stretch, and its natural log likelihood; kept per word if arrays are given."""
    state, likelihood, ones = items.before.copy(), np.zeros(len(items.starts)), np.ones(len(chain.start), chain.emits.dtype)
    for t, m in enumerate(items.active().tolist()):
        at = items.starts[:m] + t
        here = chain.emits[classes[at]]
        here *= state[:m]
        total = here @ ones
        here /= total[:, None]
        likelihood[:m] += np.log(total, dtype=np.float64)
        if alpha is not None:
            alpha[at], scale[at] = here, total
        state[:m] = here @ chain.moves
    return state, likelihood


def _backward(chain: Chain, classes: np.ndarray, items: _Items, after: np.ndarray, ends: np.ndarray, alpha: np.ndarray, scale: np.ndarray) -> np.ndarray:
    """Turn ``alpha`` into the distribution given the whole text, and add up the moves; none follows a text's end."""
    moves, later = np.zeros(chain.moves.shape), after.copy()
    active = np.append(items.active(), 0)
    for t in range(len(active) - 2, -1, -1):
        m, longer = active[t], active[t + 1]
        at = items.starts[:m] + t
        here, seen = alpha[at], later[:m] @ chain.moves.T
        moves += here[:longer].T @ later[:longer]
        # Stretches that end here; a move follows only where the text goes on.
        goes_on = longer + np.flatnonzero(~ends[longer:m])
        if len(goes_on):
            moves += here[goes_on].T @ later[goes_on]
        here *= seen
        alpha[at] = here
        seen *= chain.emits[classes[at]]
        seen /= scale[at][:, None]
        later[:m] = seen
    return moves * chain.moves


def _borders(chain: Chain, classes: np.ndarray, first: int, length: int) -> tuple[_Items, np.ndarray, float]:
    """A long text's blocks with the exact state before each, what follows each, and the text's log likelihood."""
    states = len(chain.start)
    starts = np.arange(first, first + length, BLOCK)
    lengths = np.minimum(BLOCK, first + length - starts)
    # Only the last block can be shorter, so the order is by length already.
    each = _Items(np.repeat(starts, states), np.repeat(lengths, states), np.tile(np.eye(states), (len(starts), 1)))
    out, logs = _forward(chain, classes, each)
    out, logs = out.reshape(-1, states, states), logs.reshape(-1, states)
    top = logs.max(axis=1)
    transfer = out * np.exp(logs - top[:, None])[:, :, None]
    before, total = [chain.start], 0.0
    for block, log in zip(transfer, top):
        state = before[-1] @ block
        total += log + np.log(state.sum())
        before.append(state / state.sum())
    after = [np.ones(states)]
    for block in transfer[:0:-1]:
        value = block @ after[-1]
        after.append(value / value.max())
    after = np.array(after[::-1])
    after /= np.einsum("ij,ij->i", np.array(before[1:]), after)[:, None]
    return _Items(starts, lengths, np.array(before[:-1])), after, float(total)


def text_likelihoods(chain: Chain, classes: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Natural log likelihood of each text that lies in ``classes``."""
    firsts = np.cumsum(lengths) - lengths
    out = np.zeros(len(lengths))
    whole = np.flatnonzero(lengths <= LONG_TEXT)
    whole = whole[np.argsort(-lengths[whole], kind="stable")]
    items = _Items(firsts[whole], lengths[whole], np.tile(chain.start, (len(whole), 1)))
    _, out[whole] = _forward(chain, classes, items)
    for i in np.flatnonzero(lengths > LONG_TEXT):
        _, _, out[i] = _borders(chain, classes, int(firsts[i]), int(lengths[i]))
    return out


def expected_counts(chain: Chain, classes: np.ndarray, lengths: np.ndarray) -> Counts:
    """Baum-Welch counts of the texts that lie in ``classes``, in the precision of the chain."""
    states, n_classes, kind = len(chain.start), len(chain.emits), chain.emits.dtype
    firsts = np.cumsum(lengths) - lengths
    starts, sizes, before, after, ends, opens = [], [], [], [], [], []
    likelihood = 0.0
    whole = np.flatnonzero(lengths <= LONG_TEXT)
    starts.append(firsts[whole])
    sizes.append(lengths[whole])
    before.append(np.tile(chain.start, (len(whole), 1)))
    after.append(np.ones((len(whole), states), kind))
    ends.append(np.ones(len(whole), bool))
    opens.append(np.ones(len(whole), bool))
    for i in np.flatnonzero(lengths > LONG_TEXT):
        items, later, log = _borders(chain, classes, int(firsts[i]), int(lengths[i]))
        likelihood += log
        n = np.arange(len(items.starts))
        for held, values in ((starts, items.starts), (sizes, items.lengths), (before, items.before), (after, later), (ends, n == n[-1]), (opens, n == 0)):
            held.append(values)
    starts, sizes, before, after, ends, opens = map(np.concatenate, (starts, sizes, before, after, ends, opens))
    in_blocks = np.arange(len(starts)) >= len(whole)
    order = np.argsort(-sizes, kind="stable")
    group = np.cumsum(sizes[order]) // GROUP
    sums = Counts.none(states, n_classes)
    for one in np.unique(group):
        chosen = order[group == one]
        items = _Items(starts[chosen], sizes[chosen], before[chosen].astype(kind))
        # Words of the group, one stretch after the other.
        own = np.cumsum(items.lengths) - items.lengths
        words = classes[np.repeat(items.starts - own, items.lengths) + np.arange(items.lengths.sum())]
        items.starts = own
        alpha, scale = np.empty((len(words), states), kind), np.empty(len(words), kind)
        _, logs = _forward(chain, words, items, alpha, scale)
        likelihood += logs[~in_blocks[chosen]].sum()
        sums.moves[:] += _backward(chain, words, items, after[chosen].astype(kind), ends[chosen], alpha, scale)
        sums.start[:] += alpha[own[opens[chosen]]].sum(axis=0)
        for s, weights in enumerate(np.ascontiguousarray(alpha.T)):
            sums.emits[:, s] += np.bincount(words, weights, n_classes)
    return replace(sums, likelihood=float(likelihood))


# --- fit and score ------------------------------------------------------------


def _texts(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.StructArray, np.ndarray, np.ndarray]]:
    """Texts of some chunks at a time, with their lengths and their classes: enough to find many of like lengths."""
    docs, sequences = [], []
    for batch in batches:
        for i in range(batch.num_rows):
            docs.append(batch.column("docs")[i].values)
            sequences.append(unpacked(batch.column("classes")[i].as_py())[0].astype(np.int32))
            if sum(map(len, sequences)) >= HELD:
                yield _together(docs, sequences)
                docs, sequences = [], []
    if docs:
        yield _together(docs, sequences)


def _together(docs: list[pa.StructArray], sequences: list[np.ndarray]) -> tuple[pa.StructArray, np.ndarray, np.ndarray]:
    joined = pa.concat_arrays(docs)
    return joined, joined.field("n_tokens").to_numpy(), np.concatenate(sequences)


def corpus_counts(encoded: DataFrame, chain: Chain, part: int | None = None) -> Counts:
    """Baum-Welch counts over all training texts, or those of a part.

    A task hands on one row for each class it met and one for each state; rows of a class are added up by Spark, and the driver
    gets one row per class.
    """
    states, classes = len(chain.start), len(chain.emits)
    shared = encoded.sparkSession.sparkContext.broadcast(chain.single())

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums, likelihood = Counts.none(states, classes), 0.0
        for docs, lengths, sequence in _texts(batches):
            chosen = ~docs.field("held_out").to_numpy(zero_copy_only=False)
            if part is not None:
                chosen &= docs.field("part").to_numpy() == part
            if not chosen.any():
                continue
            found = expected_counts(shared.value, sequence[np.repeat(chosen, lengths)], lengths[chosen])
            for name in ("start", "moves", "emits"):
                getattr(sums, name)[:] += getattr(found, name)
            likelihood += found.likelihood
        used = np.flatnonzero(sums.emits.any(axis=1))
        values = np.vstack([sums.emits[used], sums.moves, sums.start, np.full(states, likelihood)])
        slots = np.concatenate([used, classes + np.arange(states + 2)])
        flat = pa.array(values.ravel().astype(np.float32))
        offsets = pa.array(np.arange(0, values.size + 1, states), pa.int32())
        yield pa.RecordBatch.from_arrays([pa.array(slots, pa.int32()), pa.ListArray.from_arrays(offsets, flat)], names=["slot", "v"])

    summed = encoded.mapInArrow(add, "slot INT, v ARRAY<FLOAT>").groupBy("slot").agg(*[F.sum(F.col("v")[s].cast("double")).alias(f"s{s}") for s in range(states)])
    table = summed.toArrow()
    shared.destroy()
    whole = np.zeros((classes + states + 2, states))
    whole[table["slot"].to_numpy()] = np.column_stack([table[f"s{s}"].to_numpy() for s in range(states)])
    return Counts(whole[classes + states], whole[classes : classes + states], whole[:classes], float(whole[-1, 0]))


def chain_of(counts: Counts, class_counts: np.ndarray) -> Chain:
    """The most likely chain for expected counts, with pseudo-counts; classes lean on their share in all texts."""
    share = (class_counts + 1) / (class_counts + 1).sum()
    emits = counts.emits + CLASS_WEIGHT * share[:, None]
    start, moves = counts.start + MOVE_WEIGHT, counts.moves + MOVE_WEIGHT
    return Chain(start / start.sum(), moves / moves.sum(axis=1, keepdims=True), emits / emits.sum(axis=0))


def first_chain(class_counts: np.ndarray, states: int, seed: int = 17) -> Chain:
    """A chain that tells states apart at random and tends to stay where it is."""
    draw = np.random.default_rng(seed)
    emits = (class_counts + 1)[:, None] * np.exp(draw.normal(0.0, 1.0, (len(class_counts), states)))
    moves = np.full((states, states), 0.5 / states) + np.eye(states) * 0.5
    return Chain(np.full(states, 1 / states), moves, emits / emits.sum(axis=0))


def fit_chain(encoded: DataFrame, known: Vocabulary, states: int = STATES, parts: int = PARTS, full_rounds: int = FULL_ROUNDS) -> tuple[Chain, list[float]]:
    """Train a chain; the list has the log likelihood of all training texts before each full round."""
    chain, likelihoods = first_chain(known.class_counts, states), []
    for part in range(parts if known.texts else 0):
        found = corpus_counts(encoded, chain, part)
        size = found.emits.sum()
        if size:
            chain = chain_of(found.scaled(known.tokens / size), known.class_counts)
    for _ in range(full_rounds if known.texts else 0):
        counts = corpus_counts(encoded, chain)
        likelihoods.append(counts.likelihood)
        chain = chain_of(counts, known.class_counts)
    return chain, likelihoods


def score_encoded(encoded: DataFrame, chain: Chain, known: Vocabulary) -> DataFrame:
    """Every text with its exact log10 probability under the chain, and under single words (``base_score``)."""
    shared = encoded.sparkSession.sparkContext.broadcast(chain)
    id_type = encoded.schema["docs"].dataType.elementType["doc_id"].dataType.simpleString()
    tokens = known.tokens

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for docs, lengths, sequence in _texts(batches):
            likelihood = text_likelihoods(shared.value, sequence, lengths) / np.log(10)
            columns = {name: docs.field(name) for name in ("doc_id", "held_out", "n_tokens", "n_known")}
            columns["train_tokens"] = pa.array(np.full(len(docs), tokens, np.int64))
            columns["base_score"] = docs.field("base")
            columns["score"] = pa.array(likelihood + docs.field("within").to_numpy())
            yield pa.RecordBatch.from_pydict(columns)

    return encoded.mapInArrow(
        score, f"doc_id {id_type}, held_out BOOLEAN, n_tokens LONG, n_known LONG, train_tokens LONG, base_score DOUBLE, score DOUBLE"
    )


def score_corpus(docs: DataFrame, held_out: Column, states: int = STATES) -> DataFrame:
    """Train on the texts that are not held out, and score all."""
    chunks = stored(_chunks(docs, held_out))
    known = count_words(chunks)
    encoded = encode(chunks, known)
    discard(chunks)
    chain, _ = fit_chain(encoded, known, states)
    return score_encoded(encoded, chain, known)

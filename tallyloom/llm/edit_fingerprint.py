"""Document fingerprints by a randomised edit embedding.

A walk reads a text character by character. At step ``j`` it notes the current
character and then moves on or stays, as a shared random bit for ``j`` and the character
says. Texts a few edits apart soon walk in step again, so their edit distance
becomes the Hamming distance of the notes. The walk goes on to the end of the text, about
two steps for each character.

The fingerprint samples the notes: up to ``SAMPLES`` steps at fixed places between
each power of two and the next, each reduced to a random bit of its character.
It reads ``n:hex``, with the number of sampled steps up to the end of the text and their bits. The
likeness of two fingerprints is the share of equal bits, weighted by the steps that a sample
stands for and scaled so that unrelated texts are near 0 and equal ones at 1.

Bands of sampled bits bring similar texts together; the likeness of the whole
fingerprints decides. Every two texts that share a band end up compared or in one class. Fingerprints are
cut by length into slabs of bounded size, and a task finds the shared bands of two slabs by itself, so what is sent are
fingerprints and not their bands; slabs whose lengths alone keep them apart never meet. Members of a large bucket are held against
centres first, then those of different classes against each other, many pairs at a time on packed bits. Where slabs would be sent more often than there
are bands, fingerprints are dealt out by band instead. A fingerprint of fewer than ``LEAST_STEPS`` samples (some seven characters) says
too little and is like its equals only.

A null text is empty. Empty texts are like each other (1) and unlike all others (0).
Rows with one ``doc_id`` go by their text; null ids come first. Extra columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator, Sequence
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tallyloom.llm.components import components
from tallyloom.llm.words import mix
from tallyloom.operators.lineage import stored

SAMPLES = 128
# Characters of texts that walk together; a longer text walks alone.
TOGETHER = 20_000_000
BANDS, BITS = 32, 20
# Levels of a text, the last that it fills, whose samples make its bands.
LEVELS = 3
LEAST_STEPS = 15
# Members of a bucket that are compared as a block, and bytes of a task's blocks.
BLOCK, UNIT_BYTES = 1024, 8 << 20
# Members of a bucket beyond which it is held against its centre first, and pairs that are compared at once.
STAR, TOGETHER_PAIRS = 64, 1 << 17
# Slabs that a corpus is cut into, but for the least and the most bytes of one, and bytes of a row besides its samples.
SLABS, LEAST_SLAB, MOST_SLAB, ROW_BYTES = 16, 1 << 19, 16 << 20, 64
# Pairs that chance alone may bring together in a slab; short texts have narrow bands.
SLAB_PAIRS = 100_000_000

_U = np.uint64
_PERIOD = 4096


def _random(shape: tuple[int, ...], salt: int) -> np.ndarray:
    numbers = np.arange(int(np.prod(shape)), dtype=np.uint64) + _U(salt << 40)
    return mix(numbers * _U(0x9E3779B97F4A7C15)).reshape(shape)


@lru_cache(maxsize=1)
def _moves() -> np.ndarray:
    """Whether the walk moves on, by step (repeating) and character class; never from class 0, the end."""
    bits = (_random((_PERIOD, 256), 1) >> _U(63)).astype(np.int32)
    bits[:, 0] = 0
    return bits


@lru_cache(maxsize=64)
def _level(level: int) -> np.ndarray:
    """Sampled steps from ``2**level`` to the next power of two, ascending."""
    size = 1 << level
    if size <= SAMPLES:
        return np.arange(size, 2 * size)
    cell = size // SAMPLES
    return size + np.arange(SAMPLES) * cell + (_random((SAMPLES,), 1000 + level) % _U(cell)).astype(np.int64)


@lru_cache(maxsize=64)
def _level_bits(level: int) -> np.ndarray:
    """The random bit of each character class for each sample of a level."""
    return (_random((len(_level(level)), 256), 2000 + level) >> _U(63)).astype(np.uint8)


def _weights(n: int) -> np.ndarray:
    """Steps that each of the first ``n`` samples stands for."""
    out, level = [np.zeros(0)], 0
    while sum(map(len, out)) < n:
        out.append(np.full(len(_level(level)), (1 << level) / len(_level(level))))
        level += 1
    return np.concatenate(out)[:n]


def _classes(text: str) -> np.ndarray:
    """Characters as one of 255 classes, and class 0 at the end."""
    points = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64)
    out = np.zeros(len(points) + 1, np.uint8)
    out[:-1] = mix(points + _U(7)) % _U(255) + _U(1)
    return out


def walk(texts: Sequence[str]) -> tuple[np.ndarray, np.ndarray]:
    """``n, bits``: sampled steps before the end of each text, and the bits of the samples (0 after the end)."""
    coded = [_classes(t) for t in texts]
    flat = np.concatenate(coded) if coded else np.zeros(0, np.uint8)
    sizes = np.array([len(c) for c in coded], np.int64)
    n = np.zeros(len(texts), np.int64)
    columns: list[np.ndarray] = []
    active = np.flatnonzero(sizes > 1)
    place = (np.cumsum(sizes) - sizes)[active].astype(np.int32 if len(flat) < 2**31 else np.int64)
    moves, step, level = _moves(), 1, 0
    while len(active):
        at, bits = _level(level), _level_bits(level)
        noted = np.zeros((len(texts), len(at)), np.uint8)
        last = 1 << (level + 1)
        wanted = dict(zip(at.tolist(), range(len(at))))
        while step < last and len(active):
            now = np.empty(len(active), np.uint8)
            move = np.empty(len(active), np.int32)
            for step in range(step, min(last, (step | 511) + 1)):
                flat.take(place, out=now, mode="clip")
                s = wanted.get(step)
                if s is not None:
                    noted[active, s] = np.where(now > 0, bits[s].take(now), 0)
                    n[active] += now > 0
                moves[step % _PERIOD].take(now, out=move, mode="clip")
                place += move
            step += 1
            going = flat[place] > 0
            active, place = active[going], place[going]
        columns.append(noted)
        level += 1
    return n, np.concatenate(columns, axis=1) if columns else np.zeros((len(texts), 0), np.uint8)


def fingerprint_text(n: int, bits: np.ndarray) -> str:
    return f"{n}:{np.packbits(bits[:n]).tobytes().hex()}"


def parse_fingerprint(text: str) -> np.ndarray:
    """Bits of a fingerprint as written."""
    n, _, digits = text.partition(":")
    return np.unpackbits(np.frombuffer(bytes.fromhex(digits), np.uint8))[: int(n)]


def likeness(a: np.ndarray, b: np.ndarray) -> float:
    """Likeness of two fingerprints' bits, 0 to 1."""
    both, most = min(len(a), len(b)), max(len(a), len(b))
    if not most:
        return 1.0
    weights = _weights(most)
    equal = np.where(a[:both] == b[:both], 1.0, -1.0)
    return float(min(1.0, max(0.0, (weights[:both] * equal).sum() / weights.sum())))


def fingerprints(texts: Sequence[str], together: int = TOGETHER) -> list[np.ndarray]:
    """Bits of the texts' fingerprints; long and short texts walk in groups of bounded size."""
    out: list[np.ndarray] = [np.zeros(0, np.uint8)] * len(texts)
    group: list[int] = []

    def finish() -> None:
        n, bits = walk([texts[k] for k in group])
        for row, k in enumerate(group):
            out[k] = bits[row, : n[row]].copy()
        group.clear()

    total = 0
    for k, text in enumerate(texts):
        if group and total + len(text) > together:
            finish()
            total = 0
        group.append(k)
        total += len(text)
    if group:
        finish()
    return out


def edited(text: str, following: str) -> str:
    """The text with its last quarter replaced by the beginning of the one that follows."""
    quarter = len(text) // 4
    return text[: len(text) - quarter] + following[:quarter]


_RESULT = (
    "doc_id BIGINT, n_chars BIGINT, edited_sha256 STRING, fingerprint STRING, "
    "edited_fingerprint STRING, near_edited DOUBLE, near_next DOUBLE"
)
_STATE = _RESULT + ", kind INT, part INT, text STRING"
_RESULT_SCHEMA = pa.schema(
    [("doc_id", pa.int64()), ("n_chars", pa.int64())]
    + [(c, pa.string()) for c in ("edited_sha256", "fingerprint", "edited_fingerprint")]
    + [("near_edited", pa.float64()), ("near_next", pa.float64())]
)
_STATE_SCHEMA = pa.schema([*_RESULT_SCHEMA, ("kind", pa.int32()), ("part", pa.int32()), ("text", pa.string())])


def _judged(ids: list, texts: list[str], marks: list[np.ndarray], next_texts: list[str], next_marks: list[np.ndarray]) -> list[dict]:
    """Result rows of texts, given the text and fingerprint that follow each."""
    changed = [edited(t, f) for t, f in zip(texts, next_texts)]
    changed_marks = fingerprints(changed)
    rows = []
    for doc_id, text, mark, new, new_mark, after in zip(ids, texts, marks, changed, changed_marks, next_marks):
        rows.append(
            {
                "doc_id": doc_id,
                "n_chars": len(text),
                "edited_sha256": hashlib.sha256(new.encode("utf-8", "surrogatepass")).hexdigest(),
                "fingerprint": fingerprint_text(len(mark), mark),
                "edited_fingerprint": fingerprint_text(len(new_mark), new_mark),
                "near_edited": likeness(mark, new_mark),
                "near_next": likeness(mark, after),
            }
        )
    return rows


def compare_with_next(docs: DataFrame) -> DataFrame:
    """Fingerprints of all documents and of their edited texts, with the likeness of neighbours by ``doc_id``.

    Rows are dealt out by ranges of ``doc_id``; a task reads its range in order. Only the
    first and last row of each range go on to a join with the next range (the first follows the last).
    """
    text = F.coalesce(F.col("text"), F.lit(""))
    ordered = (
        docs.select(F.col("doc_id").cast("long").alias("doc_id"), text.alias("text"))
        .withColumn("tie", F.xxhash64("text"))
        .repartitionByRange("doc_id", "tie")
        .sortWithinPartitions("doc_id", "tie", "text")
        .select("doc_id", "text")
    )

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, held = TaskContext.get().partitionId(), None
        for batch in batches:
            if not batch.num_rows:
                continue
            ids, texts = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            marks = fingerprints(texts)
            rows = []
            if held is None:
                first = {"doc_id": ids[0], "fingerprint": fingerprint_text(len(marks[0]), marks[0])}
                rows.append(first | {"kind": 1, "part": part, "text": texts[0]})
            else:
                ids, texts, marks = [held[0], *ids], [held[1], *texts], [held[2], *marks]
            held = (ids[-1], texts[-1], marks[-1])
            rows += [r | {"kind": 0} for r in _judged(ids[:-1], texts[:-1], marks[:-1], texts[1:], marks[1:])]
            yield pa.RecordBatch.from_pylist(rows, schema=_STATE_SCHEMA)
        if held is not None:
            last = {"doc_id": held[0], "fingerprint": fingerprint_text(len(held[2]), held[2])}
            yield pa.RecordBatch.from_pylist([last | {"kind": 2, "part": part, "text": held[1]}], schema=_STATE_SCHEMA)

    def join_ranges(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, texts, marks, next_texts, next_marks = (c.to_pylist() for c in batch.columns)
            marks, next_marks = ([parse_fingerprint(m) for m in x] for x in (marks, next_marks))
            yield pa.RecordBatch.from_pylist(_judged(ids, texts, marks, next_texts, next_marks), schema=_RESULT_SCHEMA)

    state = stored(ordered.mapInArrow(compare, _STATE))
    # One number per range: bounded by the number of tasks.
    parts = sorted(r["part"] for r in state.filter("kind = 1").select("part").collect())
    following = docs.sparkSession.createDataFrame(
        list(zip(parts, parts[1:] + parts[:1])), "part INT, next_part INT"
    )
    heads = state.filter("kind = 1").select(
        F.col("part").alias("next_part"), F.col("text").alias("next_text"), F.col("fingerprint").alias("next_mark")
    )
    tails = state.filter("kind = 2").select("part", "doc_id", "text", "fingerprint")
    ends = (
        tails.join(following, "part")
        .join(heads, "next_part")
        .select("doc_id", "text", "fingerprint", "next_text", "next_mark")
        .mapInArrow(join_ranges, _RESULT)
    )
    return state.filter("kind = 0").select(*_RESULT_SCHEMA.names).unionByName(ends)


@lru_cache(maxsize=1)
def _level_ends() -> np.ndarray:
    return np.cumsum([len(_level(level)) for level in range(48)])


def filled_levels(n: np.ndarray) -> np.ndarray:
    """Levels that fingerprints of ``n`` samples fill."""
    return np.searchsorted(_level_ends(), n, side="right")


@lru_cache(maxsize=256)
def _picks(level: int, bands: int, used: int) -> np.ndarray:
    """Samples of a level that each band takes."""
    return np.argsort(_random((bands, len(_level(level))), 3000 + level), axis=1)[:, :used]


def band_numbers(bits: np.ndarray, bands: int = BANDS, width: int = BITS) -> list[int]:
    """One number per band of up to ``width`` bits, drawn from the samples of the last levels that the text fills.

    A band belongs to one level, so that texts of somewhat different length share the bands of all but their last level. Small
    levels have narrower bands. Earlier levels are left out, since a common opening says little about two texts.
    """
    firsts = [0]
    while firsts[-1] + len(_level(len(firsts) - 1)) <= len(bits):
        firsts.append(firsts[-1] + len(_level(len(firsts) - 1)))
    out: list[int] = []
    if len(bits) < LEAST_STEPS:
        return out
    for level in range(max(3, len(firsts) - 1 - LEVELS), len(firsts) - 1):
        size = len(_level(level))
        used = min(width, size * 5 // 8)
        picks = _picks(level, bands, used)
        values = (bits[firsts[level] + picks].astype(np.uint64) << np.arange(used, dtype=np.uint64)).sum(axis=1, dtype=np.uint64)
        keys = mix(values + _U(level << 48) + (np.arange(bands, dtype=np.uint64) << _U(40)))
        out += keys.view(np.int64).tolist()
    # A text that fills no level from the fourth on has its first samples as its only band.
    return out or mix((bits[:LEAST_STEPS].astype(np.uint64) << np.arange(LEAST_STEPS, dtype=np.uint64)).sum(keepdims=True)).view(np.int64).tolist()


def pack_samples(bits: np.ndarray) -> bytes:
    """A fingerprint's bits behind one zero bit, so that the samples of a level fill whole words of 64 bits from the eighth on."""
    return np.packbits(np.concatenate([np.zeros(1, np.uint8), bits])).tobytes()


class Samples:
    """Packed fingerprints side by side, to compare many pairs of them at once.

    Weights are whole numbers, so likenesses are those of ``likeness`` to the last bit.
    """

    def __init__(self, n: np.ndarray, packed: pa.Array) -> None:
        """Fingerprints of ``n`` samples as written by ``pack_samples``, none of them empty."""
        sizes = (np.asarray(n, np.int64) + 8) // 8
        most = int(n.max()) if len(n) else 1
        words = max(4, -(-(most + 1) // 64))
        data = np.zeros((len(n), words * 8), np.uint8)
        offsets = np.frombuffer(packed.buffers()[1], np.int32)[packed.offset : packed.offset + len(n) + 1]
        at = np.arange(words * 8)
        data[at < sizes[:, None]] = np.frombuffer(packed.buffers()[2], np.uint8)[offsets[0] : offsets[-1]]
        # Bits before the end, eight at a time.
        used = (0xFF00 >> np.clip(n[:, None] + 1 - 8 * at, 0, 8) & 0xFF).astype(np.uint8)
        self.n, self.data, self.used = np.asarray(n, np.int64), data.view(np.uint64), used.view(np.uint64)
        # The first four words have the levels up to the seventh, then each level has two.
        self.weights = 2.0 ** np.maximum(0, np.arange(words) // 2 - 1)
        self.reach = np.concatenate([[0.0], np.cumsum(_weights(most))])

    def likeness(self, a: np.ndarray, b: np.ndarray, least: float = 0.0) -> np.ndarray:
        """Likeness of the pairs of rows ``a, b``; 0 where lengths alone keep it below ``least``."""
        out = np.zeros(len(a))
        shorter = np.where(self.n[a] <= self.n[b], a, b)
        ends, all_of = self.reach[self.n[shorter]], self.reach[np.maximum(self.n[a], self.n[b])]
        possible = np.flatnonzero(ends / all_of >= least)
        for first in range(0, len(possible), TOGETHER_PAIRS):
            k = possible[first : first + TOGETHER_PAIRS]
            differ = np.bitwise_count((self.data[a[k]] ^ self.data[b[k]]) & self.used[shorter[k]]) @ self.weights
            out[k] = np.clip((ends[k] - 2 * differ) / all_of[k], 0.0, 1.0)
        return out


def likeness_table(left: list[np.ndarray], right: list[np.ndarray]) -> np.ndarray:
    """``likeness`` of every left with every right fingerprint, none of them empty."""
    marks = left + right
    samples = Samples(np.array([len(m) for m in marks]), pa.array([pack_samples(m) for m in marks], pa.binary()))
    a, b = np.divmod(np.arange(len(left) * len(right)), len(right))
    return samples.likeness(a, len(left) + b).reshape(len(left), len(right))


def mark_texts(docs: DataFrame) -> DataFrame:
    """``doc_id, fingerprint`` of every row of ``docs``; a null text is empty."""

    def mark(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            marks = [fingerprint_text(len(m), m) for m in fingerprints(batch.column(1).to_pylist())]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(marks, pa.string())], names=["doc_id", "fingerprint"])

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    return rows.mapInArrow(mark, "doc_id BIGINT, fingerprint STRING")


def _alone(marked: DataFrame) -> DataFrame:
    """Distinct fingerprints ``node, fingerprint, first_doc, docs``, each named by its digest."""
    node = F.unhex(F.md5("fingerprint")).alias("node")
    ids = marked.select(F.col("doc_id").cast("long").alias("doc_id"), "fingerprint")
    summed = ids.groupBy("fingerprint").agg(F.min("doc_id").alias("first_doc"), F.count(F.lit(1)).alias("docs"))
    return stored(summed.select(node, "fingerprint", "first_doc", "docs"))


def _checked(pairs: DataFrame, placed: DataFrame, threshold: float) -> DataFrame:
    """Those of the pairs ``a, b`` of nodes that are alike, with their likeness."""

    def check(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n = np.concatenate([batch.column(k).to_numpy() for k in (2, 4)])
            rows = np.arange(batch.num_rows)
            samples = Samples(n, pa.concat_arrays([batch.column(3), batch.column(5)]))
            values = samples.likeness(rows, batch.num_rows + rows, threshold)
            found = pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(values)], names=["a", "b", "likeness"])
            yield found.filter(pa.array(values >= threshold))

    left = placed.select(F.col("node").alias("a"), F.col("n").alias("n_a"), F.col("samples").alias("x"))
    right = placed.select(F.col("node").alias("b"), F.col("n").alias("n_b"), F.col("samples").alias("y"))
    joined = pairs.join(right, "b").join(left, "a").select("a", "b", "n_a", "x", "n_b", "y")
    return joined.mapInArrow(check, "a BINARY, b BINARY, likeness DOUBLE")


def _dealt(labelled: DataFrame) -> DataFrame:
    """Members of buckets of several classes, once for each pair of blocks to compare: ``band, node, root, block, x, y``.

    ``labelled`` is ``band, node, root``. Blocks are cut in order of the classes, and no two blocks of one class
    are compared, so a large class goes only to the blocks that hold others.
    """
    order = Window.partitionBy("band").orderBy("root", "node")
    several = labelled.groupBy("band").agg(F.min("root").alias("one"), F.max("root").alias("other")).filter("one <> other").select("band")
    members = stored(
        labelled.join(several, "band").withColumn("block", F.floor((F.row_number().over(order) - 1) / BLOCK).cast("int"))
    )
    ends = members.groupBy("band", "block").agg(F.min("root").alias("lo"), F.max("root").alias("hi"))
    blocks = ends.groupBy("band").agg(F.sort_array(F.collect_list(F.struct("block", "lo", "hi"))).alias("blocks"))
    own = F.element_at("blocks", F.col("block") + 1)
    partners = F.filter("blocks", lambda p: (p["lo"] != p["hi"]) | (own["lo"] != own["hi"]) | (p["lo"] != own["lo"]))
    return members.join(blocks, "band").select(
        "band", "node", "root", "block", F.explode(F.transform(partners, lambda p: p["block"])).alias("partner")
    ).select("band", "node", "root", "block", F.least("block", "partner").alias("x"), F.greatest("block", "partner").alias("y"))


def _pairs_of(first: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """All pairs of rows of some groups that lie one after the other."""
    at = np.repeat(first - (np.cumsum(size) - size), size) + np.arange(size.sum())
    n = np.repeat(first + size, size) - 1 - at
    a = np.repeat(at, n)
    return a, a + 1 + np.arange(len(a)) - np.repeat(np.cumsum(n) - n, n)


def _forest(a: np.ndarray, b: np.ndarray) -> list[int]:
    """Numbers of links ``a, b`` that join all that these links join, without rings."""
    top: dict[int, int] = {}

    def root(k: int) -> int:
        while (up := top.get(k, k)) != k:
            top[k] = top.get(up, up)
            k = up
        return k

    kept = []
    for k, (x, y) in enumerate(zip(a.tolist(), b.tolist())):
        x, y = root(x), root(y)
        if x != y:
            top[x] = y
            kept.append(k)
    return kept


def _across(labelled: DataFrame, placed: DataFrame, threshold: float) -> DataFrame:
    """Links between members of different classes of one bucket, for ``band, node, root`` of all members.

    Only samples are sent, which grow with the logarithm of the text. A task's links are without rings.
    """
    dealt = stored(_dealt(labelled))
    each = placed.agg(F.coalesce(F.avg(F.octet_length("samples")), F.lit(0.0))).first()[0] + 64
    unit = F.pmod(F.xxhash64("band", "x", "y"), F.lit(max(1, int(dealt.count() * each / UNIT_BYTES))))

    def compare(table: pa.Table) -> pa.Table:
        table = table.sort_by([("band", "ascending"), ("x", "ascending"), ("y", "ascending"), ("block", "ascending")]).combine_chunks()
        band, x, y, block = (table[c].to_numpy() for c in ("band", "x", "y", "block"))
        nodes = table["node"].combine_chunks().dictionary_encode()
        node = nodes.indices.to_numpy()
        root = table["root"].combine_chunks().dictionary_encode().indices.to_numpy()
        _, one = np.unique(node, return_index=True)
        samples = Samples(table["n"].to_numpy()[one], table["samples"].combine_chunks().take(pa.array(one)))
        cuts = np.flatnonzero((band[1:] != band[:-1]) | (x[1:] != x[:-1]) | (y[1:] != y[:-1])) + 1
        first = np.concatenate([[0], cuts])
        size = np.diff(np.append(first, len(band)))
        # Groups together, as many as make up so many pairs.
        batch = np.cumsum(size * (size - 1) // 2) // (4 * TOGETHER_PAIRS)
        found_a, found_b, found = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)], [np.zeros(0)]
        for some in np.split(np.arange(len(first)), np.flatnonzero(np.diff(batch)) + 1):
            a, b = _pairs_of(first[some], size[some])
            # Members of one block meet where the block is compared with itself.
            wanted = (root[a] != root[b]) & ((block[a] != block[b]) | (x[a] == y[a]))
            a, b = node[a[wanted]].astype(np.int64), node[b[wanted]].astype(np.int64)
            values = samples.likeness(a, b, threshold)
            alike = np.flatnonzero(values >= threshold)
            kept = alike[_forest(a[alike], b[alike])]
            for held, v in ((found_a, a), (found_b, b), (found, values)):
                held.append(v[kept])
        a, b, values = map(np.concatenate, (found_a, found_b, found))
        kept = _forest(a, b)
        a, b = (nodes.dictionary.take(pa.array(v[kept])) for v in (a, b))
        return pa.table({"a": a, "b": b, "likeness": pa.array(values[kept])})

    sent = dealt.join(placed.select("node", "n", "samples"), "node").withColumn("unit", unit)
    compared = sent.groupBy("unit").applyInArrow(compare, "a BINARY, b BINARY, likeness DOUBLE")
    return compared.groupBy(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).agg(F.max("likeness").alias("likeness"))


def _links_by_band(alone: DataFrame, threshold: float, bands: int) -> DataFrame:
    """``_links`` by dealing out every fingerprint once for each of its bands."""

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            marks = [parse_fingerprint(m) for m in batch.column(1).to_pylist()]
            listed = pa.array([band_numbers(m, bands) for m in marks], pa.list_(pa.int64()))
            n, samples = pa.array([len(m) for m in marks], pa.int64()), pa.array([pack_samples(m) for m in marks], pa.binary())
            yield pa.RecordBatch.from_arrays([batch.column(0), n, samples, listed], names=["node", "n", "samples", "bands"])

    kinds = "node BINARY, n BIGINT, samples BINARY, bands ARRAY<BIGINT>"
    marked = stored(alone.select("node", "fingerprint").mapInArrow(place, kinds))
    placed = marked.select("node", F.explode("bands").alias("band"))
    buckets = placed.groupBy("band").agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
    members = stored(placed.join(buckets, "band"))
    # Without its centre a large bucket of one class would be compared pair by pair.
    large = members.filter(F.col("n") > STAR)
    met = large.groupBy("node").agg(F.sum("n").alias("met"))
    centres = (
        large.select("band", "node").join(met, "node").groupBy("band").agg(F.max(F.struct("met", "node"))["node"].alias("centre"))
    )
    stars = large.join(centres, "band").filter("node <> centre")
    stars = stars.select(F.least("centre", "node").alias("a"), F.greatest("centre", "node").alias("b")).distinct()
    links = stored(_checked(stars, marked, threshold))
    classes = components(links)
    labelled = members.join(classes, "node", "left").select("band", "node", F.coalesce("root", "node").alias("root"))
    more = _across(labelled, marked, threshold)
    return links.unionByName(more.join(links, ["a", "b"], "left_anti"))


class Slabs:
    """Fingerprints cut by their numbers of samples into slabs of bounded size, and the pairs of slabs that may hold similar ones.

    Slabs lie in order of length. Two fingerprints are alike only if the shorter one stands for enough steps of the longer
    one, so slab ``x`` meets those from itself to ``last[x]``, each in a unit of work of its own.
    """

    def __init__(self, n: np.ndarray, count: np.ndarray, threshold: float, bands: int) -> None:
        """For ``count`` fingerprints of ``n`` samples, ``n`` ascending from ``LEAST_STEPS`` on."""
        first = np.maximum(3, filled_levels(n) - LEVELS)
        chance = bands * 2.0 ** -np.minimum(BITS, np.minimum(SAMPLES, 1 << first) * 5 // 8)
        weight = count * np.maximum(n // 8 + ROW_BYTES, (MOST_SLAB * np.sqrt(chance / SLAB_PAIRS)).astype(np.int64))
        most = min(MOST_SLAB, max(LEAST_SLAB, int(weight.sum()) // SLABS))
        # Many of one length are dealt out by their digests.
        self.n, self.pieces = n, np.maximum(1, -(-weight // most))
        self.base = np.zeros(len(n), np.int64)
        lows: list[int] = []
        highs: list[int] = []
        rest = 0
        for k, (size, w, pieces) in enumerate(zip(n.tolist(), weight.tolist(), self.pieces.tolist())):
            if pieces > 1 or w > rest:
                self.base[k] = len(lows)
                lows += [size] * pieces
                highs += [size] * pieces
                rest = most - w if pieces == 1 else 0
            else:
                self.base[k] = len(lows) - 1
                highs[-1] = size
                rest -= w
        reach = np.concatenate([[0.0], np.cumsum(_weights(highs[-1] if highs else 0))])
        filled = filled_levels(np.array([lows, highs], np.int64))
        self.last, y = np.zeros(len(lows), np.int64), 0
        for x, high in enumerate(highs):
            y = max(x, y)
            while (
                y + 1 < len(lows)
                and reach[min(high, lows[y + 1])] / reach[lows[y + 1]] >= threshold
                and max(3, filled[0, y + 1] - LEVELS) < filled[1, x]
            ):
                y += 1
            self.last[x] = y
        slabs = np.arange(len(lows))
        self.first = np.searchsorted(self.last, slabs)
        self.unit = np.cumsum(self.last + 1 - slabs) - (self.last + 1 - slabs)
        self.units = int((self.last + 1 - slabs).sum())
        # Rows sent, if those of one length are dealt out evenly.
        met = np.concatenate([[0], np.cumsum(self.last - self.first + 1)])
        self.sent = int((count * (met[self.base + self.pieces] - met[self.base]) / self.pieces).sum())

    def dealt(self, n: np.ndarray, digest: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """``row, unit, later``: each fingerprint once for each of its units, and whether it is of the later slab there."""
        k = np.searchsorted(self.n, n)
        slab = self.base[k] + (digest % self.pieces[k].astype(np.uint64)).astype(np.int64)
        size = self.last[slab] + 1 - self.first[slab]
        row = np.repeat(np.arange(len(n)), size)
        own = slab[row]
        other = self.first[own] + np.arange(len(row)) - np.repeat(np.cumsum(size) - size, size)
        x = np.minimum(own, other)
        return row, self.unit[x] + np.maximum(own, other) - x, other < own


def _tops(top: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """Names of the classes of some rows, where ``top`` leads from each row towards that of its class."""
    at = top[rows]
    while not np.array_equal(at, up := top[at]):
        at = up
    return at


class _Found:
    """Links found so far in a unit, without rings, and the classes that they make."""

    def __init__(self, samples: Samples, threshold: float) -> None:
        self.samples, self.threshold = samples, threshold
        self.top = np.arange(len(samples.n))
        self.links: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []

    def compare(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Hold the pairs against each other and join the alike ones; tells which are alike."""
        values = self.samples.likeness(a, b, self.threshold)
        alike = values >= self.threshold
        k = np.flatnonzero(alike)
        x, y = _tops(self.top, a[k]), _tops(self.top, b[k])
        kept = _forest(x, y)
        for up, low in zip(x[kept].tolist(), y[kept].tolist()):
            while (above := int(self.top[up])) != up:
                up = above
            while (above := int(self.top[low])) != low:
                low = above
            self.top[low] = up
        k = k[kept]
        self.links.append((a[k], b[k], values[k]))
        return alike

    def gather(self, rows: np.ndarray) -> None:
        """Join members of a large bucket by centres, as long as a centre joins many: the first of the largest class that had none."""
        while True:
            names, first, count = np.unique(_tops(self.top, rows), return_index=True, return_counts=True)
            if len(names) < 2:
                return
            centre = rows[first[count.argmax()]]
            others = rows[_tops(self.top, rows) != names[count.argmax()]]
            alike = self.compare(np.full(len(others), centre), others)
            rows = others[_tops(self.top, others) != _tops(self.top, centre[None])]
            if 8 * alike.sum() < len(others):
                return


def _band_values(samples: Samples, rows: np.ndarray, level: int, bands: int) -> np.ndarray:
    """For each band of a level, the number that the rows' picked samples spell, as ``band_numbers`` has it."""
    size = len(_level(level))
    used = min(BITS, size * 5 // 8)
    picks = _picks(level, bands, used)
    # Whole numbers below 2**20 are exact.
    places = np.zeros((size, bands), np.float32)
    places[picks.T, np.arange(bands)] = 2.0 ** np.arange(used)[:, None]
    start = (size if size < SAMPLES else SAMPLES * (level - 6)) // 8
    data = samples.data.view(np.uint8)[:, start : start + size // 8]
    out = np.empty((bands, len(rows)), np.uint32)
    for first in range(0, len(rows), 1 << 14):
        part = np.unpackbits(data[rows[first : first + (1 << 14)]], axis=1).astype(np.float32)
        out[:, first : first + (1 << 14)] = (part @ places).T
    return out


def _mixed(values: np.ndarray, rows: np.ndarray, top: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Rows of the buckets of several classes, in order of bucket and class, and the ends of each row's class and bucket among them."""
    names = _tops(top, rows).astype(np.uint64)
    order = np.sort(values.astype(np.uint64) << _U(44) | names << _U(22) | np.arange(len(rows), dtype=np.uint64))
    bucket, group = order >> _U(44), order >> _U(22)
    cuts = np.flatnonzero(bucket[1:] != bucket[:-1]) + 1
    first, last = np.concatenate([[0], cuts]), np.append(cuts, len(order)) - 1
    several = group[first] != group[last]
    size = (last + 1 - first)[several]
    at = np.repeat(first[several] - (np.cumsum(size) - size), size) + np.arange(size.sum())
    group = group[at]
    cuts = np.append(np.flatnonzero(group[1:] != group[:-1]) + 1, len(at))
    group_end = np.repeat(cuts, np.diff(cuts, prepend=0)) if len(at) else cuts[:0]
    return rows[(order[at] & _U((1 << 22) - 1)).astype(np.int64)], group_end, np.repeat(np.cumsum(size), size)


def unit_links(samples: Samples, later: np.ndarray, threshold: float, bands: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Links ``a, b, likeness`` without rings that join all rows which share a band and are alike.

    Where some rows are ``later``, these are held against the others only; what else is found on the way is kept.
    """
    found, two = _Found(samples, threshold), bool(later.any())
    filled = filled_levels(samples.n)
    for level in range(max(3, int(filled.min()) - LEVELS), int(filled.max())):
        rows = np.flatnonzero((filled > level) & (np.maximum(3, filled - LEVELS) <= level))
        if len(rows) < 2:
            continue
        for values in _band_values(samples, rows, level, bands):
            found.top = _tops(found.top, np.arange(len(found.top)))
            members, group_end, end = _mixed(values, rows, found.top)
            buckets = np.flatnonzero(np.diff(end, prepend=0))
            large = buckets[end[buckets] - buckets > STAR]
            if len(large):
                for k in large:
                    found.gather(members[k : end[k]])
                members, group_end, end = _mixed(values, rows, found.top)
            partners = end - group_end
            batch = np.cumsum(partners) // (4 * TOGETHER_PAIRS)
            for some in np.split(np.arange(len(members)), np.flatnonzero(np.diff(batch)) + 1):
                n = partners[some]
                a = np.repeat(some, n)
                b = np.repeat(group_end[some] - (np.cumsum(n) - n), n) + np.arange(len(a))
                a, b = members[a], members[b]
                if two:
                    across = later[a] != later[b]
                    a, b = a[across], b[across]
                if len(a):
                    apart = _tops(found.top, a) != _tops(found.top, b)
                    found.compare(a[apart], b[apart])
    none = np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0)
    a, b, values = map(np.concatenate, zip(none, *found.links))
    return a, b, values


def _links(alone: DataFrame, threshold: float, bands: int) -> DataFrame:
    """Links ``a, b, likeness`` that join all fingerprints which share a band and are alike.

    Fingerprints are dealt out in slabs, unless those would be sent more often than there are bands.
    """
    size = F.substring_index("fingerprint", ":", 1).cast("long").alias("n")
    # One row for each number of samples, which grows with the logarithm of the longest text.
    sizes = alone.groupBy(size).agg(F.count(F.lit(1)).alias("rows")).filter(F.col("n") >= LEAST_STEPS).orderBy("n").collect()
    n, count = (np.array([r[c] for r in sizes], np.int64) for c in ("n", "rows"))
    slabs = Slabs(n, count, threshold, bands)
    if slabs.sent > LEVELS * bands * count.sum():
        return _links_by_band(alone, threshold, bands)

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            marks = [parse_fingerprint(m) for m in batch.column(1).to_pylist()]
            n, samples = np.array([len(m) for m in marks], np.int64), pa.array([pack_samples(m) for m in marks], pa.binary())
            digest = np.array([int.from_bytes(d[:8], "little") for d in batch.column(0).to_pylist()], np.uint64)
            row, unit, later = slabs.dealt(n, digest)
            for first in range(0, len(row), 1 << 16):
                k = pa.array(row[first : first + (1 << 16)])
                columns = [pa.array(v[first : first + (1 << 16)]) for v in (unit, later)]
                columns += [v.take(k) for v in (batch.column(0), pa.array(n), samples)]
                yield pa.RecordBatch.from_arrays(columns, names=["unit", "later", "node", "n", "samples"])

    def compare(table: pa.Table) -> pa.Table:
        table = table.sort_by("node").combine_chunks()
        node, packed = (table[c].combine_chunks() for c in ("node", "samples"))
        a, b, values = unit_links(Samples(table["n"].to_numpy(), packed), table["later"].to_numpy(), threshold, bands)
        return pa.table({"a": node.take(pa.array(a)), "b": node.take(pa.array(b)), "likeness": pa.array(values)})

    # A null fingerprint goes on, to fail.
    known = alone.select("node", "fingerprint").filter(~F.coalesce(size < LEAST_STEPS, F.lit(False)))
    dealt = known.mapInArrow(deal, "unit BIGINT, later BOOLEAN, node BINARY, n BIGINT, samples BINARY")
    compared = dealt.groupBy("unit").applyInArrow(compare, "a BINARY, b BINARY, likeness DOUBLE")
    return compared.groupBy(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).agg(F.max("likeness").alias("likeness"))


def similar_texts(marked: DataFrame, threshold: float = 0.7, bands: int = BANDS) -> DataFrame:
    """Links ``a, b, likeness`` between similar fingerprints, for a frame ``doc_id, fingerprint``.

    Equal fingerprints stand as one, named by their least id. The links join every two fingerprints that are
    alike and share a band, directly or through others; not every pair within a class is listed. See ``similar_classes`` for members.
    """
    alone = _alone(marked)
    named = alone.select("node", "first_doc")
    links = _links(alone, threshold, bands)
    links = links.join(named.toDF("a", "id_a"), "a").join(named.toDF("b", "id_b"), "b")
    return links.select(F.least("id_a", "id_b").alias("a"), F.greatest("id_a", "id_b").alias("b"), "likeness")


def similar_classes(marked: DataFrame, threshold: float = 0.7, bands: int = BANDS) -> DataFrame:
    """One row per row of ``marked`` (``doc_id, fingerprint``): ``doc_id, root, class_id, class_size``.

    ``root`` names the class, the least digest of its fingerprints; ``class_id`` is its least ``doc_id`` (null for null ids only),
    ``class_size`` its number of documents. Copies are never expanded into pairs.
    """
    alone = _alone(marked)
    classes = components(_links(alone, threshold, bands))
    rooted = alone.select("node", "first_doc", "docs").join(classes, "node", "left").withColumn("root", F.coalesce("root", "node"))
    summed = rooted.groupBy("root").agg(F.min("first_doc").alias("class_id"), F.sum("docs").alias("class_size"))
    named = rooted.select("node", "root").join(summed, "root")
    rows = marked.select(F.col("doc_id").cast("long").alias("doc_id"), F.unhex(F.md5("fingerprint")).alias("node"))
    return rows.join(named, "node").select("doc_id", "root", "class_id", "class_size")

"""Near-duplicate classes by DartMinHash signatures, banding and exact verification.

A document is a weighted set: its shingles of ``SHINGLE`` words (fewer words, but not
none: one shingle) with their number of occurrences. Two texts are linked if
their weighted Jaccard similarity is ``THRESHOLD`` or more; classes are connected
components of links, and equal texts are always in one class.

*Signature.* The plane of weight and rank above each element holds a fixed random
scatter of darts, one per unit of area, derived by hashing from the element and the
cell of the plane. A document sees the darts that lie below its weight of the element,
up to a rank at which it sees about ``k (ln k + 3)`` of them in all; each dart
carries one of ``k`` coordinates, and the least rank per coordinate is the signature. A document
with an empty coordinate looks further up. The work for a document
follows the larger of its length and ``k ln k``, whatever the weights.

*Links.* Signatures are cut into bands. In every bucket, each text is compared with one centre (a star, not all
pairs): the text that meets most others in all its buckets, which is the likely original of a
group of edited copies. Where a bucket still holds several classes, its texts are dealt into blocks of
bounded size and blocks are compared pair by pair inside tasks, which return links only; so no
pair that shares a bucket and is similar is lost. All comparisons count shingles of the whole texts.

Null and empty texts are classes of their own. A null ``doc_id`` never names a class that has
another one. Repeated rows each get their row. Extra columns are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyloom.llm.components import components
from tallyloom.llm.words import Words, mix, powers, split_words, text_chunks
from tallyloom.operators.lineage import settled, stored

SHINGLE, THRESHOLD = 5, 0.8
# A pair at the threshold shares no band with a probability of 5e-6.
BANDS, ROWS = 40, 6

# Texts, and bytes of text, in a block of a bucket with several classes.
BLOCK_TEXTS, BLOCK_BYTES = 512, 4 * 1024 * 1024
# Bytes of text that a task compares at once, and distinct cells of a step of a comparison.
UNIT_BYTES, COLUMNS = 8 * 1024 * 1024, 8192

# Strips of elements whose darts are thrown together.
STRIPS = 1 << 17

_U = np.uint64
_STEP, _STRIP, _CELL = _U(0x9E3779B97F4A7C15), _U(0xC2B2AE3D27D4EB4F), _U(0x165667B19E3779F9)


def _repeat_count(counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """``index, running number`` for each of ``counts`` copies of every index."""
    index = np.repeat(np.arange(len(counts)), counts)
    first = np.concatenate([[0], np.cumsum(counts)[:-1]]) if len(counts) else counts
    return index, np.arange(len(index)) - first[index]


def dart_signatures(owner: np.ndarray, tokens: np.ndarray, weights: np.ndarray, n: int, k: int) -> np.ndarray:
    """Least rank per coordinate (``n`` x ``k``) for the weighted elements of ``n`` sets; inf for empty sets."""
    out = np.full((n, k), np.inf)
    if not len(owner):
        return out
    element, cell = _repeat_count(np.ceil(weights).astype(np.int64))
    cells = mix(tokens[element] + cell.astype(np.uint64) * _CELL)
    part = np.minimum(weights[element] - cell, 1.0)
    owner = owner[element]
    total = np.bincount(owner, weights=part, minlength=n)
    reach = np.zeros(n)
    reach[total > 0] = k * (math.log(k) + 3) / total[total > 0]
    open_ = total > 0
    while open_.any():
        chosen = np.flatnonzero(open_[owner])
        # Short texts have as many darts as long ones, so memory is bounded by strips, not by bytes of text.
        strips = np.ceil(reach[owner[chosen]]).astype(np.int64)
        run = np.cumsum(strips) // STRIPS
        for some in np.split(np.arange(len(chosen)), np.flatnonzero(np.diff(run)) + 1):
            _throw(out, owner, cells, part, reach, chosen[some], strips[some])
        open_ = open_ & np.isinf(out).any(axis=1)
        reach[open_] *= 2
    return out


def _throw(out: np.ndarray, owner: np.ndarray, cells: np.ndarray, part: np.ndarray, reach: np.ndarray, chosen: np.ndarray, strips: np.ndarray) -> None:
    """Lower ``out`` to the ranks of the darts that hit the chosen elements, each in its number of ``strips``."""
    at, strip = _repeat_count(strips)
    at = chosen[at]
    seed = mix(cells[at] + strip.astype(np.uint64) * _STRIP)
    who, share = owner[at], part[at]
    base = strip.astype(np.float64)
    top = np.minimum(reach[who] - base, 1.0)
    gone = np.zeros(len(at))
    flat, k = out.reshape(-1), out.shape[1]
    while len(seed):
        seed = mix(seed + _STEP)
        gone = gone - np.log(((seed >> _U(11)).astype(np.float64) + 0.5) * 2.0**-53)
        keep = np.flatnonzero(gone <= top)
        seed, gone, top, who, share, base = (x[keep] for x in (seed, gone, top, who, share, base))
        spot = mix(seed ^ _CELL)
        coordinate = ((spot >> _U(32)) * _U(k) >> _U(32)).astype(np.int64)
        inside = (spot & _U(0xFFFFFFFF)).astype(np.float64) * 2.0**-32 < share
        np.minimum.at(flat, (who * k + coordinate)[inside], (base + gone)[inside])


def weighted_shingles(words: Words, size: int = SHINGLE) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``owner, token, weight`` of the distinct shingles of each text; the weight counts occurrences."""
    at, tokens = words.shingles(size)
    owner = words.owner[at]
    for short in range(1, size):
        texts = np.flatnonzero(words.counts == short)
        if len(texts):
            at, hashes = words.shingles(short)
            there = np.isin(words.owner[at], texts)
            owner = np.concatenate([owner, words.owner[at][there]])
            tokens = np.concatenate([tokens, hashes[there]])
    if not len(owner):
        return owner, tokens, np.zeros(0)
    order = np.lexsort((tokens, owner))
    owner, tokens = owner[order], tokens[order]
    first = np.flatnonzero(np.concatenate([[True], (owner[1:] != owner[:-1]) | (tokens[1:] != tokens[:-1])]))
    return owner[first], tokens[first], np.diff(np.append(first, len(owner))).astype(np.float64)


def band_hashes(signatures: np.ndarray, bands: int, rows: int) -> np.ndarray:
    """One 64-bit number per band and set."""
    parts = mix(signatures.view(np.uint64)).reshape(len(signatures), bands, rows)
    return mix((parts * powers(0xD1342543DE82EF95, rows)).sum(axis=2, dtype=np.uint64) + np.arange(bands, dtype=np.uint64))


def signed_texts(docs: DataFrame, bands: int = BANDS, rows: int = ROWS, shingle: int = SHINGLE) -> DataFrame:
    """``doc_id, node, empty, size, bands`` per document; ``node`` stands for the text, texts without words have no bands."""

    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            listed: list = [[]] * batch.num_rows
            for first, data, offsets in text_chunks(batch.column(4)):
                words = split_words(data, offsets)
                n = len(words.counts)
                owner, tokens, weights = weighted_shingles(words, shingle)
                signatures = dart_signatures(owner, tokens, weights, n, bands * rows)
                hashes = band_hashes(signatures, bands, rows).view(np.int64)
                for k in np.flatnonzero(words.counts).tolist():
                    listed[first + k] = hashes[k]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:4], pa.array(listed, pa.list_(pa.int64()))],
                names=["doc_id", "node", "empty", "size", "bands"],
            )

    return _keyed(docs).mapInArrow(sign, "doc_id BIGINT, node BINARY, empty BOOLEAN, size INT, bands ARRAY<BIGINT>")


def _keyed(docs: DataFrame) -> DataFrame:
    text = F.coalesce(F.col("text"), F.lit(""))
    return docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.unhex(F.md5(text)).alias("node"),
        (text == "").alias("empty"),
        F.octet_length(text).alias("size"),
        text.alias("text"),
    )


def similarity(a: tuple[np.ndarray, np.ndarray], b: tuple[np.ndarray, np.ndarray]) -> float:
    """Weighted Jaccard similarity of two ``tokens, weights`` sets with sorted tokens."""
    both = np.concatenate([a[0], b[0]])
    common, ia, ib = np.intersect1d(a[0], b[0], assume_unique=True, return_indices=True)
    least = np.minimum(a[1][ia], b[1][ib]).sum()
    return float(least / (a[1].sum() + b[1].sum() - least)) if len(both) else 0.0


def _text_set(text: str, shingle: int) -> tuple[np.ndarray, np.ndarray]:
    data = np.frombuffer(text.encode(), np.uint8)
    _, tokens, weights = weighted_shingles(split_words(data, np.array([0, len(data)])), shingle)
    return tokens, weights


def _verified(pairs: DataFrame, texts: DataFrame, threshold: float, shingle: int) -> DataFrame:
    """The pairs ``a, b`` of nodes whose texts are similar enough."""

    def check(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, known = None, None
        for batch in batches:
            keep = np.zeros(batch.num_rows, bool)
            left, right = batch.column(2), batch.column(3)
            for k, a in enumerate(batch.column(0).to_pylist()):
                if a != last:
                    last, known = a, _text_set(left[k].as_py(), shingle)
                keep[k] = similarity(known, _text_set(right[k].as_py(), shingle)) >= threshold
            yield batch.select(["a", "b"]).filter(pa.array(keep))

    left = texts.select(F.col("node").alias("a"), F.col("text").alias("text_a"))
    right = texts.select(F.col("node").alias("b"), F.col("text").alias("text_b"))
    joined = pairs.join(right, "b").join(left, "a").select("a", "b", "text_a", "text_b")
    return joined.mapInArrow(check, "a BINARY, b BINARY")


def _needed_texts(docs: DataFrame, nodes: DataFrame, pairs: DataFrame) -> DataFrame:
    """``node, text`` for the nodes in the pairs, each fetched from the document that stands for it."""
    wanted = pairs.select(F.col("a").alias("node")).unionByName(pairs.select(F.col("b").alias("node"))).distinct()
    wanted = wanted.join(nodes.select("node", F.col("first_doc").alias("wanted_doc")), "node")
    keyed = _keyed(docs)
    same = keyed["doc_id"].eqNullSafe(wanted["wanted_doc"]) & (keyed["node"] == wanted["node"])
    found = keyed.join(wanted, same).select(keyed["node"], keyed["text"])
    return stored(found.dropDuplicates(["node"]))


def near_duplicate_links(
    docs: DataFrame, nodes: DataFrame, threshold: float = THRESHOLD, shingle: int = SHINGLE
) -> DataFrame:
    """Enough verified links ``a, b`` between the nodes to join all similar texts that share a bucket."""
    placed = nodes.select("node", F.explode("bands").alias("band"))
    buckets = placed.groupBy("band").agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
    members = stored(placed.join(buckets, "band"))

    met = members.groupBy("node").agg(F.sum("n").alias("met"))
    centres = members.select("band", "node").join(met, "node").groupBy("band").agg(
        F.max(F.struct("met", "node"))["node"].alias("centre")
    )
    stars = members.join(centres, "band").filter("node <> centre")
    stars = settled(stars.select(F.col("centre").alias("a"), F.col("node").alias("b")).distinct())
    links = settled(_verified(stars, _needed_texts(docs, nodes, stars), threshold, shingle))

    classes = components(links)
    labelled = members.join(classes, "node", "left").select("band", "node", F.coalesce("root", "node").alias("root"))
    sized = nodes.select("node", "size")
    mixed = (
        labelled.join(sized, "node")
        .groupBy("band")
        .agg(
            F.min("root").alias("one"),
            F.max("root").alias("other"),
            F.count(F.lit(1)).alias("n"),
            F.sum("size").alias("bytes"),
        )
        .filter("one <> other")
        .select("band", F.greatest(F.ceil(F.col("n") / BLOCK_TEXTS), F.ceil(F.col("bytes") / BLOCK_BYTES)).alias("blocks"))
    )
    several = stored(labelled.join(mixed, "band"))
    wanted = several.select(F.col("node").alias("a"), F.col("node").alias("b")).distinct()
    more = _links_across(several, _needed_texts(docs, nodes, wanted), threshold, shingle)
    return links.unionByName(more)


def _cells(text: str, shingle: int) -> np.ndarray:
    """A text's weighted set as plain numbers: one for each occurrence of each shingle."""
    tokens, weights = _text_set(text, shingle)
    element, cell = _repeat_count(weights.astype(np.int64))
    return mix(tokens[element] + cell.astype(np.uint64) * _CELL)


def similar_across(
    left: list[np.ndarray], right: list[np.ndarray], differ: np.ndarray, threshold: float
) -> list[tuple[int, int]]:
    """Numbers of the pairs of a left and a right set of cells that are similar enough, among those that ``differ`` admits."""
    sizes = [np.array([len(x) for x in side]) for side in (left, right)]
    owners = [np.repeat(np.arange(len(side)), n) for side, n in zip((left, right), sizes)]
    cells, place = np.unique(np.concatenate([*left, *right]), return_inverse=True)
    places = [place[: sizes[0].sum()], place[sizes[0].sum() :]]
    common = np.zeros((len(left), len(right)), np.float32)
    for first in range(0, len(cells), COLUMNS):
        tables = []
        for owner, at, side in zip(owners, places, (left, right)):
            here = (at >= first) & (at < first + COLUMNS)
            table = np.zeros((len(side), min(COLUMNS, len(cells) - first)), np.float32)
            table[owner[here], at[here] - first] = 1
            tables.append(table)
        common += tables[0] @ tables[1].T
    total = sizes[0][:, None] + sizes[1][None, :] - common
    x, y = np.nonzero(differ & (common >= threshold * total) & (total > 0))
    return list(zip(x.tolist(), y.tolist()))


def _links_across(several: DataFrame, texts: DataFrame, threshold: float, shingle: int) -> DataFrame:
    """Links between texts of different classes that share a bucket: ``band, node, root, blocks`` of all its members.

    A member is sent to as many pairs of blocks as its bucket has blocks; a task gets whole pairs of blocks of bounded size.
    """
    block = F.pmod(F.xxhash64("node", "band"), F.col("blocks"))
    dealt = (
        several.withColumn("block", block)
        .withColumn("partner", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)))
        .select("band", "node", "root", "block", F.least("block", "partner").alias("x"), F.greatest("block", "partner").alias("y"))
        .join(texts, "node")
    )
    total = dealt.agg(F.coalesce(F.sum(F.octet_length("text") + 64), F.lit(0))).first()[0]
    unit = F.pmod(F.xxhash64("band", "x", "y"), F.lit(max(1, -(-total // UNIT_BYTES))))

    def compare(table: pa.Table) -> pa.Table:
        table = table.sort_by([("band", "ascending"), ("x", "ascending"), ("y", "ascending"), ("node", "ascending")])
        band, x, y, block = (table[c].to_numpy() for c in ("band", "x", "y", "block"))
        nodes, roots, text = (table[c].combine_chunks() for c in ("node", "root", "text"))
        known: dict[bytes, np.ndarray] = {}
        found: set[tuple[bytes, bytes]] = set()
        cuts = np.flatnonzero((band[1:] != band[:-1]) | (x[1:] != x[:-1]) | (y[1:] != y[:-1])) + 1
        for first, last in zip([0, *cuts.tolist()], [*cuts.tolist(), len(band)]):
            here = np.arange(first, last)
            sides = [here[block[here] == x[first]], here[block[here] == y[first]]]
            names = [[nodes[k].as_py() for k in side.tolist()] for side in sides]
            classes = [np.array([roots[k].as_py() for k in side.tolist()], object) for side in sides]
            differ = classes[0][:, None] != classes[1][None, :]
            if not differ.any():
                continue
            for name, k in zip(names[0] + names[1], np.concatenate(sides).tolist()):
                if name not in known:
                    known[name] = _cells(text[k].as_py(), shingle)
            sets = [[known[n] for n in side] for side in names]
            for i, j in similar_across(*sets, differ, threshold):
                found.add((min(names[0][i], names[1][j]), max(names[0][i], names[1][j])))
        columns = list(zip(*sorted(found))) or [[], []]
        return pa.table({"a": pa.array(columns[0], pa.binary()), "b": pa.array(columns[1], pa.binary())})

    return dealt.withColumn("unit", unit).groupBy("unit").applyInArrow(compare, "a BINARY, b BINARY").distinct()


def near_duplicate_classes(docs: DataFrame, threshold: float = THRESHOLD, shingle: int = SHINGLE) -> DataFrame:
    """One row per document: ``doc_id, node, root, class_id, class_size``.

    ``root`` identifies the class: the least digest of its texts, null for an empty text, which is a class of its own.
    ``class_id`` is the least ``doc_id`` of the class, ``class_size`` its number of documents. Classes
    of null ids only have no ``class_id``, and classes share it where different texts share an id.
    """
    signed = stored(signed_texts(docs, shingle=shingle))
    nodes = stored(
        signed.filter("not empty")
        .groupBy("node")
        .agg(F.min("doc_id").alias("first_doc"), F.count(F.lit(1)).alias("docs"), F.first("size").alias("size"), F.first("bands").alias("bands"))
    )
    classes = settled(components(near_duplicate_links(docs, nodes, threshold, shingle)))
    rooted = nodes.select("node", "first_doc", "docs").join(classes, "node", "left")
    rooted = rooted.withColumn("root", F.coalesce("root", "node"))
    summed = rooted.groupBy("root").agg(F.min("first_doc").alias("class_id"), F.sum("docs").alias("class_size"))
    named = rooted.select("node", "root").join(summed, "root").select("node", "root", "class_id", "class_size")
    joined = signed.select("doc_id", "node", "empty").join(named, "node", "left")
    return joined.select(
        "doc_id",
        "node",
        "root",
        F.when(F.col("empty"), F.col("doc_id")).otherwise(F.col("class_id")).alias("class_id"),
        F.when(F.col("empty"), F.lit(1).cast("long")).otherwise(F.col("class_size")).alias("class_size"),
    )


def keep_one_of_each(docs: DataFrame, classes: DataFrame) -> DataFrame:
    """The documents that stand for their class, columns as given.

    The document with the least ``doc_id`` stays; of several rows with that id, the one whose
    text has the least digest. Null and empty texts stay. Classes are told apart by ``root``, since ids may be null or repeated.
    """
    best = classes.filter("root is not null").groupBy("root").agg(
        F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "node")).alias("best")
    )
    chosen = best.select("best.doc_id", "best.node")
    text = F.coalesce(F.col("text"), F.lit(""))
    keyed = docs.withColumn("__node", F.unhex(F.md5(text)))
    same = keyed["doc_id"].eqNullSafe(chosen["doc_id"]) & (keyed["__node"] == chosen["node"])
    kept = keyed.filter(text != "").join(chosen, same, "left_semi").dropDuplicates(["doc_id", "__node"])
    return kept.select(docs.columns).unionByName(docs.filter(text == ""))

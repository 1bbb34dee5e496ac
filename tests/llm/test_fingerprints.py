"""The walk against a plain version, neighbours by id, and bands."""

import hashlib
import random
from pathlib import Path

import numpy as np

from tallyloom.llm import edit_fingerprint as ef
from tallyloom.llm.registry import QUERIES
from tallyloom.operators.lineage import STORED, ensure_checkpoint_dir

DOCS = "doc_id BIGINT, text STRING, kind INT, part STRING"


def plain_walk(text):
    classes, place, step, bits = ef._classes(text), 0, 1, []
    moves, level = ef._moves(), 0
    while True:
        steps = ef._level(level).tolist()
        for step in range(1 << level, 2 << level):
            now = classes[place]
            if now == 0:
                return bits
            if step in steps:
                bits.append(int(ef._level_bits(level)[steps.index(step)][now]))
            place += moves[step % ef._PERIOD][now]
        level += 1


def test_walks_against_a_plain_version():
    draw = random.Random(5)
    texts = ["", "a", "éñ", "ab" * 700] + ["".join(draw.choice("abc é\n") for _ in range(draw.randint(1, 900))) for _ in range(30)]
    for together in (10**9, 500):
        assert [b.tolist() for b in ef.fingerprints(texts, together)] == [plain_walk(t) for t in texts]


def test_likeness_follows_edits():
    draw = random.Random(6)
    text = "".join(draw.choice("abcdefghij ") for _ in range(3000))
    other = "".join(draw.choice("abcdefghij ") for _ in range(3000))
    few = list(text)
    for _ in range(5):
        few.insert(draw.randrange(len(few)), "z")
    a, b, c = ef.fingerprints([text, "".join(few), other])
    assert ef.likeness(a, a) == 1 and ef.likeness(a, b) > 0.8 and ef.likeness(a, c) < 0.2
    assert ef.likeness(a, b) == ef.likeness(b, a)
    assert ef.likeness(np.zeros(0), np.zeros(0)) == 1 and ef.likeness(a, np.zeros(0)) == 0
    assert ef.parse_fingerprint(ef.fingerprint_text(len(a), a)).tolist() == a.tolist()


def check(rows, docs):
    ordered = sorted(docs, key=lambda d: (d[0] is not None, d[0]))
    by_id = {r["doc_id"]: r for r in rows}
    assert len(rows) == len(docs)
    for (doc_id, text), (next_id, following) in zip(ordered, ordered[1:] + ordered[:1]):
        text, following = text or "", following or ""
        quarter = len(text) // 4
        new = text[: len(text) - quarter] + following[:quarter]
        r = by_id[doc_id]
        assert r["n_chars"] == len(text) and r["edited_sha256"] == hashlib.sha256(new.encode()).hexdigest()
        marks = [ef.parse_fingerprint(m) for m in (r["fingerprint"], r["edited_fingerprint"], by_id[next_id]["fingerprint"])]
        assert abs(r["near_edited"] - ef.likeness(*marks[:2])) < 1e-12
        assert abs(r["near_next"] - ef.likeness(marks[0], marks[2])) < 1e-12
        assert 0 <= r["near_edited"] <= 1


def test_neighbours_over_many_ranges(spark):
    draw = random.Random(9)
    docs = [(i * 3, "".join(draw.choice("abcé ") for _ in range(draw.randint(0, 200)))) for i in range(90)]
    docs += [(None, "no id, but a text"), (1000, None), (1001, ""), (1002, docs[0][1])]
    draw.shuffle(docs)
    frame = spark.createDataFrame([(i, t, 1, "p") for i, t in docs], DOCS)
    check(ef.compare_with_next(frame).collect(), docs)
    alone = ef.compare_with_next(frame.filter("doc_id = 0")).collect()
    assert len(alone) == 1 and alone[0]["near_next"] == 1
    assert ef.compare_with_next(frame.limit(0)).count() == 0
    twice = ef.compare_with_next(spark.createDataFrame([(1, "abcd", 1, ""), (1, "abcd", 1, "")], DOCS)).collect()
    assert len(twice) == 2 and all(r["near_next"] == 1 for r in twice)


def test_registered_query(spark, tables):
    docs = [tuple(r) for r in spark.read.parquet(f"{tables}/documents.parquet").select("doc_id", "text").collect()]
    check(QUERIES["op10_fingerprints"](spark, tables).collect(), docs)


def test_bands_find_edited_texts(spark):
    draw = random.Random(3)
    base = ["".join(draw.choice("abcdefgh ") for _ in range(1500)) for _ in range(20)]
    near = [t[:400] + "x" + t[400:1100] + t[1102:] for t in base]
    marks = [ef.fingerprint_text(len(b), b) for b in ef.fingerprints(base + near + base[:2])]
    pairs = ef.similar_texts(spark.createDataFrame(list(enumerate(marks)), "doc_id BIGINT, fingerprint STRING")).collect()
    found = {(r["a"], r["b"]) for r in pairs}
    assert len(found & {(i, i + 20) for i in range(20)}) >= 19 and len(found) <= 22


def families(draw):
    """Texts with shared openings and edits, many of them short."""
    letters = "abcdefgh "
    openings = ["".join(draw.choice(letters) for _ in range(60)) for _ in range(3)]
    texts = ["", "a", "ab"]
    for k in range(60):
        size = draw.choice([10, 25, 60, 200, 700])
        base = (draw.choice(openings) if k % 3 else "") + "".join(draw.choice(letters) for _ in range(size))
        texts.append(base)
        for _ in range(draw.randint(0, 3)):
            at = draw.randrange(len(base) * 3 // 4, len(base))
            texts.append(base[:at] + draw.choice(letters) + base[at + draw.randint(0, 2) :])
    return texts


def roots(n, links):
    root = list(range(n))

    def top(k):
        while root[k] != k:
            k = root[k]
        return k

    for a, b in links:
        root[max(top(a), top(b))] = min(top(a), top(b))
    return [top(k) for k in range(n)]


def test_classes_against_all_pairs(spark, monkeypatch):
    texts = families(random.Random(12))
    texts += texts[5:25] * 2
    marks = ef.fingerprints(texts)
    ids = [k if k % 9 else None for k in range(len(texts))]
    written = [(i, ef.fingerprint_text(len(m), m), "x") for i, m in zip(ids, marks)]
    alike = {
        (a, b) for a in range(len(marks)) for b in range(a + 1, len(marks)) if ef.likeness(marks[a], marks[b]) >= 0.7
    }
    frame = spark.createDataFrame(written, "doc_id BIGINT, fingerprint STRING, node STRING")
    expected = roots(len(marks), alike)
    size = {r: expected.count(r) for r in expected}
    plain = None
    for block in (ef.BLOCK, 4):
        monkeypatch.setattr(ef, "BLOCK", block)
        found = {(r["doc_id"], r["class_id"], r["class_size"]) for r in ef.similar_classes(frame).collect()}
        plain = plain or found
        assert found == plain
    by_id = {i: (c, n) for i, c, n in found if i is not None}
    links = [(a, b) for a, b in alike if ids[a] is not None and ids[b] is not None]
    kept = sum(by_id[a] == by_id[b] for a, b in links)
    assert kept >= 0.9 * len(links), (kept, len(links))
    # No class joins what the pairs do not join.
    for a, b in zip(range(len(ids)), range(1, len(ids))):
        if ids[a] is not None and ids[b] is not None and by_id[a][0] is not None and by_id[a][0] == by_id[b][0]:
            assert expected[a] == expected[b]
    assert all(n <= size[expected[i]] for i, (_, n) in by_id.items())
    assert ef.similar_classes(frame.limit(0)).count() == 0


def test_likeness_table():
    draw = random.Random(2)
    marks = [m for m in ef.fingerprints(["".join(draw.choice("abc") for _ in range(draw.randint(1, 300))) for _ in range(12)])]
    table = ef.likeness_table(marks[:5], marks[5:])
    for i in range(5):
        for j in range(7):
            assert abs(table[i, j] - ef.likeness(marks[i], marks[5 + j])) < 1e-12


def test_registered_classes_against_all_pairs(spark, tables):
    docs = spark.read.parquet(f"{tables}/documents.parquet").select("doc_id", "text").collect()
    rows = QUERIES["fingerprint_classes"](spark, tables).collect()
    assert len(rows) == len(docs)
    classes = {r["doc_id"]: r["class_id"] for r in rows}
    marks = [(r["doc_id"], m) for r, m in zip(docs, ef.fingerprints([r["text"] or "" for r in docs])) if len(m)]
    table = ef.likeness_table([m for _, m in marks], [m for _, m in marks])
    pairs = [(a, b) for a, b in np.argwhere(table >= 0.7).tolist() if a < b]
    expected = roots(len(marks), pairs)
    assert sum(classes[marks[a][0]] == classes[marks[b][0]] for a, b in pairs) >= 0.9 * len(pairs)
    # A class holds only what links join.
    first = {}
    for (doc_id, _), root in zip(marks, expected):
        assert first.setdefault(classes[doc_id], root) == root


def test_samples_are_compared_as_likeness_says():
    draw = random.Random(7)
    marks = ef.fingerprints(["".join(draw.choice("ab") for _ in range(draw.choice([9, 40, 63, 64, 65, 300, 5000]))) for _ in range(24)])
    samples = ef.Samples(np.array([len(m) for m in marks]), ef.pa.array([ef.pack_samples(m) for m in marks], ef.pa.binary()))
    a, b = ef._pairs_of(np.array([0, 5, 6]), np.array([5, 1, 18]))
    assert sorted(zip(a.tolist(), b.tolist())) == sorted(
        (i, j) for lo, hi in ((0, 5), (5, 6), (6, 24)) for i in range(lo, hi) for j in range(i + 1, hi)
    )
    plain = [ef.likeness(marks[i], marks[j]) for i, j in zip(a, b)]
    assert samples.likeness(a, b).tolist() == plain
    assert (samples.likeness(a, b, 0.7) >= 0.7).tolist() == [v >= 0.7 for v in plain]


def test_blocks_of_one_class_are_not_compared(spark, monkeypatch):
    monkeypatch.setattr(ef, "BLOCK", 4)
    nodes = [b"%03d" % k for k in range(40)]
    rows = [(1, n, nodes[0]) for n in nodes] + [(1, b"900", b"900")] + [(2, n, nodes[0]) for n in nodes]
    rows += [(3, b"%03d" % k, b"%03d" % k) for k in range(9)]
    dealt = ef._dealt(spark.createDataFrame(rows, "band BIGINT, node BINARY, root BINARY")).collect()
    sent = {band: [(r["x"], r["y"], r["node"]) for r in dealt if r["band"] == band] for band in (1, 2, 3)}
    # The stranger's block meets the ten others, which do not meet each other; a bucket of one class stays away.
    assert {(x, y) for x, y, _ in sent[1]} == {(k, 10) for k in range(10)} and len(sent[1]) == 40 + 10
    assert not sent[2]
    assert {(x, y) for x, y, _ in sent[3]} == {(0, 0), (0, 1), (1, 1), (0, 2), (1, 2)}


def many_short(draw, count):
    return ["".join(draw.choice("abcdefgh ") for _ in range(draw.randint(30, 50))) for _ in range(count)]


def test_units_of_slabs_against_all_pairs(monkeypatch):
    draw = random.Random(21)
    texts = families(draw)[::2] + many_short(draw, 30)
    texts += [texts[20][: len(texts[20]) - k] for k in range(20)] + ["".join(draw.choice("ab") for _ in range(9)) for _ in range(30)]
    marks = list({ef.fingerprint_text(len(m), m): m for m in ef.fingerprints(texts) if len(m) >= ef.LEAST_STEPS}.values())
    n = np.array([len(m) for m in marks])
    banded = [set(ef.band_numbers(m)) for m in marks]
    alike = {
        (a, b): ef.likeness(marks[a], marks[b]) for a in range(len(marks)) for b in range(a + 1, len(marks)) if banded[a] & banded[b]
    }
    digest = np.array([draw.getrandbits(64) for _ in marks], np.uint64)
    for slab, star, pairs, threshold in ((1 << 20, 2, 1 << 17, 0.7), (3000, 64, 64, 0.7), (800, 2, 1 << 17, 0.3)):
        for name, value in (("LEAST_SLAB", slab), ("MOST_SLAB", slab), ("STAR", star), ("TOGETHER_PAIRS", pairs)):
            monkeypatch.setattr(ef, name, value)
        slabs = ef.Slabs(*np.unique(n, return_counts=True), threshold, ef.BANDS)
        row, unit, later = slabs.dealt(n, digest)
        links = []
        for k in range(slabs.units):
            rows, second = row[unit == k], later[unit == k]
            if not len(rows):
                continue
            samples = ef.Samples(n[rows], ef.pa.array([ef.pack_samples(marks[i]) for i in rows], ef.pa.binary()))
            a, b, values = ef.unit_links(samples, second, threshold, ef.BANDS)
            for x, y, v in zip(rows[a].tolist(), rows[b].tolist(), values.tolist()):
                assert alike[min(x, y), max(x, y)] == v >= threshold
                links.append((x, y))
        assert roots(len(marks), links) == roots(len(marks), [p for p, v in alike.items() if v >= threshold])
        assert (slab == 1 << 20) == (slabs.units == 1)


def test_every_two_slabs_that_may_hold_similar_texts_meet_once():
    draw = random.Random(4)
    n = np.array(sorted(draw.sample(range(15, 1500), 400)))
    count = np.array([draw.choice([1, 40, 30_000]) for _ in n])
    slabs = ef.Slabs(n, count, 0.7, ef.BANDS)
    rows = np.repeat(np.arange(len(n)), 3)
    digest = np.array([draw.getrandbits(64) for _ in rows], np.uint64)
    row, unit, _ = slabs.dealt(n[rows], digest)
    units = [set() for _ in rows]
    for r, u in zip(row.tolist(), unit.tolist()):
        assert u not in units[r] and 0 <= u < slabs.units
        units[r].add(u)
    reach = np.concatenate([[0.0], np.cumsum(ef._weights(int(n.max())))])
    home = {}
    for a in range(0, len(rows), 7):
        for b in range(a, len(rows), 11):
            both = units[a] & units[b]
            if reach[n[rows[a]]] / reach[n[rows[b]]] >= 0.7:
                assert both
            # More than one unit in common only in the same slab.
            assert len(both) <= 1 or home.setdefault(frozenset(units[a]), units[b]) == units[b]
    assert ef.Slabs(n[:0], n[:0], 0.7, ef.BANDS).sent == 0


def classes_of(frame):
    rows = ef.similar_classes(frame).collect()
    return sorted((bytes(r["root"]), str(r["doc_id"]), str(r["class_id"]), r["class_size"]) for r in rows)


def test_slabs_and_bands_make_the_same_classes(spark, monkeypatch):
    draw = random.Random(31)
    texts = families(draw) + many_short(draw, 60)
    texts += texts[3:20]
    marks = [(k if k % 7 else None, ef.fingerprint_text(len(m), m)) for k, m in enumerate(ef.fingerprints(texts))]
    frame = spark.createDataFrame(marks, "doc_id BIGINT, fingerprint STRING")
    found = [classes_of(frame)]
    monkeypatch.setattr(ef, "MOST_SLAB", 4000)
    found.append(classes_of(frame))
    monkeypatch.setattr(ef, "_links", ef._links_by_band)
    found.append(classes_of(frame))
    assert found[0] == found[1] == found[2] and len({r[0] for r in found[0]}) < len(marks) - 30


def test_slabs_that_would_be_sent_too_often_give_way_to_bands(spark, monkeypatch):
    marks = [(k, ef.fingerprint_text(len(m), m)) for k, m in enumerate(ef.fingerprints(many_short(random.Random(8), 40)))]
    frame = spark.createDataFrame(marks, "doc_id BIGINT, fingerprint STRING")
    called = []
    monkeypatch.setattr(ef, "_links_by_band", lambda *a, f=ef._links_by_band: called.append(1) or f(*a))
    plain = classes_of(frame)
    assert not called
    monkeypatch.setattr(ef, "MOST_SLAB", 100)
    monkeypatch.setattr(ef.Slabs, "sent", property(lambda self: 10**6, lambda self, value: None), raising=False)
    assert classes_of(frame) == plain and called


def test_tables_on_disk_do_not_grow_with_shared_bands(spark):
    marks = [(k, ef.fingerprint_text(len(m), m)) for k, m in enumerate(ef.fingerprints(many_short(random.Random(13), 2000)))]
    folder = Path(ensure_checkpoint_dir(spark).removeprefix("file:"))
    before = set(folder.glob(f"{STORED}*"))
    ef.similar_classes(spark.createDataFrame(marks, "doc_id BIGINT, fingerprint STRING")).collect()
    written = sum(f.stat().st_size for d in set(folder.glob(f"{STORED}*")) - before for f in d.rglob("*.parquet"))
    # Fingerprints with digests and counts; some 80 bands of each were written beside them once.
    assert 0 < written < 8 * sum(len(m) for _, m in marks), written

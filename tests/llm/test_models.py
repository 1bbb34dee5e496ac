"""Toxicity and quality: held-out accuracy and edge cases."""

import random

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tallyloom.llm import linear, quality, toxicity

DOCS = "doc_id BIGINT, text STRING, y STRING, half STRING"


def corpus(n=600):
    draw = random.Random(4)
    prose = [f"{a}{b}" for a in ("the", "er", "on", "wh", "ing") for b in ("an", "re", "ti", "st", "ou", "ly", "nd")]
    bad = ["zorkface", "grubmuck", "vilnodrek", "zorkings", "grubmuckish"]
    rows, labels = [], []
    for i in range(n):
        toxic, good = i % 5 == 0, i % 4 != 1
        words = [draw.choice(prose) for _ in range(draw.randint(20, 60))]
        if toxic:
            for _ in range(3):
                words.insert(draw.randrange(len(words)), draw.choice(bad))
        if not good:
            words = [w + draw.choice(["!!", "$$$", "%%"]) for w in words] if i % 8 == 1 else [w for w in words for _ in range(4)]
        rows.append((i, " ".join(words), "y", "h"))
        labels.append((i, int(good), int(toxic)))
    return rows, labels


@pytest.fixture(scope="module")
def frames(spark):
    rows, labels = corpus()
    rows += [(9000, None, "y", "h"), (9001, "", None, "h"), (None, "the on", "y", "h"), (3, rows[3][1], "y", "h")]
    labels += [(3, 1, 0), (None, 1, 1), (77, None, None)]
    return spark.createDataFrame(rows, DOCS), spark.createDataFrame(labels, "doc_id BIGINT, quality INT, toxic INT")


def accuracy(scores, truth, threshold):
    pairs = [(r["score"] >= threshold, truth[r["doc_id"]]) for r in scores if r["doc_id"] in truth and r["doc_id"] % 3 == 0]
    return np.mean([p == bool(t) for p, t in pairs])


def test_toxic_texts_are_told_apart(frames):
    docs, labels = frames
    model = toxicity.fit_toxicity(docs, labels.filter("doc_id % 3 <> 0"))
    scores = toxicity.score_texts(docs, model).collect()
    assert len(scores) == docs.count() and all(0 <= r["score"] <= 1 for r in scores)
    truth = {r["doc_id"]: r["toxic"] for r in labels.filter("doc_id is not null and toxic is not null").collect()}
    assert accuracy(scores, truth, 0.5) > 0.95
    assert all(r["score"] < 0.5 for r in scores if r["doc_id"] in (9000, 9001))
    kept = toxicity.drop_toxic(docs, model, 0.5)
    assert kept.columns == docs.columns
    assert kept.count() == sum(r["score"] < 0.5 for r in scores)


def test_labels_of_one_kind_or_none(frames):
    docs, labels = frames
    for some in (labels.filter("toxic = 0"), labels.limit(0)):
        scores = toxicity.score_texts(docs, toxicity.fit_toxicity(docs, some)).select("score").distinct().collect()
        assert len(scores) == 1 and 0 < scores[0]["score"] < 1
    assert toxicity.score_texts(docs.limit(0), toxicity.fit_toxicity(docs.limit(0), labels)).count() == 0
    model = quality.fit_quality(docs, labels.limit(0))
    assert {r["score"] for r in quality.score_quality(docs, model).collect()} == {0.5}


def test_good_texts_are_told_apart(frames):
    docs, labels = frames
    model = quality.fit_quality(docs, labels.filter("doc_id % 3 <> 0 and doc_id % 2 = 0 or doc_id is null"))
    scores = quality.score_quality(docs, model).collect()
    assert len(scores) == docs.count() and all(0 <= r["score"] <= 1 for r in scores)
    truth = {r["doc_id"]: r["quality"] for r in labels.filter("doc_id is not null and quality is not null").collect()}
    assert accuracy(scores, truth, 0.3) > 0.9


def test_prior_is_near_the_share_of_positives():
    draw = np.random.default_rng(3)
    for share in (0.3, 0.7):
        positive = draw.normal(2, 1, 8000)
        unlabelled = np.where(draw.random(8000) < share, draw.normal(2, 1, 8000), draw.normal(-2, 1, 8000))
        assert abs(quality.estimate_prior(positive, unlabelled) - share) < 0.06


def test_prior_counts_all_documents_whatever_their_ids(spark, monkeypatch):
    rows, labels = corpus(900)
    # A third of the rows shares the null id; all of these are bad.
    rows += [(None, r[1].replace(" ", "!! $$ ") + f" {k}", "y", "h") for k, r in enumerate(rows[:450])]
    docs = spark.createDataFrame(rows, DOCS)
    known = spark.createDataFrame(labels, "doc_id BIGINT, quality INT, toxic INT")
    whole = quality.fit_quality(docs, known)
    monkeypatch.setattr(quality, "UNLABELLED", 400)
    part = quality.fit_quality(docs, known)
    assert abs(whole.prior - 0.5) < 0.12 and abs(part.prior - 0.5) < 0.12


def test_copies_count_by_weight(spark):
    frame = spark.createDataFrame([(5, "same words", "y", "h")] * 40 + [(k, f"w{k}", "y", "h") for k in range(3)], DOCS)
    x, copies, _ = quality._described(frame, 100, 1)
    assert len(x) == 4 and sorted(copies.tolist()) == [1, 1, 1, 40]


def test_risk_never_goes_below_zero_for_long():
    draw = np.random.default_rng(5)
    good, bad = draw.normal(1, 1, (400, 4)), draw.normal(-1, 1, (400, 4))
    model = quality.fit_network(good[:200].astype(np.float32), np.vstack([good[200:], bad[:200]]).astype(np.float32), 0.5, rounds=400)
    assert (model.predict(good[200:]) > 0.5).mean() > 0.85 and (model.predict(bad[200:]) < 0.5).mean() > 0.85


def test_descriptions_do_not_depend_on_the_batch():
    texts = ["a b b c", None, "", "X!! Y!!\n" * 9, "é" * 50]
    whole = quality.describe_texts(pa.array(texts))
    for k, t in enumerate(texts):
        np.testing.assert_allclose(quality.describe_texts(pa.array([t], pa.string()))[0], whole[k], rtol=1e-6)
    assert not whole[1].any() and not whole[2].any()


def test_logistic_curve():
    draw = np.random.default_rng(1)
    x = draw.normal(size=(4000, 2))
    y = (draw.random(4000) < 1 / (1 + np.exp(-(2 * x[:, 0] - x[:, 1] + 0.5)))).astype(float)
    fitted = linear.fit_logistic(x, y)
    np.testing.assert_allclose(fitted.weights / fitted.scale, [2, -1], atol=0.2)


def test_registered_queries(spark, tables):
    from tallyloom.llm.registry import QUERIES

    for name, folds, rest, threshold in (("op2_toxicity", 3, 1, 0.7), ("op5_quality", 5, 0, 0.3)):
        found = QUERIES[name](spark, tables)
        assert found.columns == ["doc_id", "held_out", "score", "predicted"]
        wrong = found.filter(
            (F.col("held_out") != (F.crc32(F.col("doc_id").cast("string")) % folds == rest))
            | (F.col("predicted") != (F.col("score") >= threshold).cast("int"))
        )
        assert found.count() == spark.read.parquet(f"{tables}/documents.parquet").count() and wrong.count() == 0


def test_calibration_is_bounded_by_distinct_rows(spark):
    # One id holds most rows; a bound by a hash of the id alone would take all of them.
    many = [(7, 1, f"text {i}", 0) for i in range(3000)] + [(7, 1, "same", 0)] * 500 + [(8, 0, "same", 1)]
    rows = spark.createDataFrame(many, "doc_id BIGINT, y INT, text STRING, half INT").repartition(5)
    found = toxicity.calibration_sample(rows, 40).collect()
    assert len(found) == 40 and len({(r["y"], r["text"]) for r in found}) == 40
    whole = toxicity.calibration_sample(rows, 10_000).collect()
    assert len(whole) == 3002 and sum(r["copies"] for r in whole) == len(many)
    assert {r["copies"] for r in whole if r["y"] and r["text"] == "same"} == {500}
    assert toxicity.calibration_sample(rows.limit(0), 40).collect() == []


def test_copies_in_a_logistic_curve_equal_repeated_rows():
    draw = np.random.default_rng(3)
    x, copies = draw.normal(size=(60, 2)), draw.integers(1, 6, 60)
    y = (x[:, 0] + draw.normal(size=60) > 0).astype(float)
    weighted = linear.fit_logistic(x, y, copies=copies.astype(float))
    repeated = linear.fit_logistic(np.repeat(x, copies, axis=0), np.repeat(y, copies))
    np.testing.assert_allclose(weighted.predict(x), repeated.predict(x), rtol=1e-9)


def test_features_against_plain_compression():
    import zstandard

    draw = random.Random(8)
    words = ["zorkface", "grubmuck", "the", "other", "ring", "lyre", "ende", "wander"]
    toxic = toxicity.train_dictionary([(w.encode(), 3) for w in words[:2]], 4096)
    ordinary = toxicity.train_dictionary([(w.encode(), 3) for w in words[2:]], 4096)
    scorer = toxicity.WindowScorer(toxic, ordinary)

    def length(word, dictionary):
        data = zstandard.ZstdCompressionDict(dictionary)
        plain = zstandard.ZstdCompressor(dict_data=data, write_content_size=False, write_dict_id=False)
        # Four bytes of magic number are what the compact frame leaves out.
        return len(plain.compress(toxicity.window_code(word.encode()))) - 4

    texts = [" ".join(draw.choice(words) for _ in range(draw.randint(0, 9))) for _ in range(40)] + ["", "unknownword"]
    for text, row in zip(texts, scorer.features(pa.array(texts))):
        found = text.split()
        each = {w: length(w, ordinary) - length(w, toxic) for w in found}
        top = sorted((v for v in each.values() if v > 0), reverse=True)[:3]
        above = sum(each[w] >= toxicity.MARGIN for w in set(found))
        expected = [*top, *[0] * (3 - len(top)), np.log1p(above), np.log1p(len(found))]
        np.testing.assert_allclose(row, expected)


def test_rising_curve():
    draw = np.random.default_rng(6)
    p = draw.random(3000)
    y = (draw.random(3000) < p**3).astype(float)
    curve = linear.fit_rising_curve(p, y)
    at = np.linspace(0.05, 0.95, 19)
    assert np.abs(curve.predict(at) - at**3).max() < 0.1
    assert (np.diff(curve.predict(np.linspace(0, 1, 500))) > 0).all() and (np.diff(curve.shares) > 0).all()
    copies = draw.integers(1, 4, 3000)
    repeated = linear.fit_rising_curve(np.repeat(p, copies), np.repeat(y, copies))
    np.testing.assert_allclose(linear.fit_rising_curve(p, y, copies.astype(float)).predict(at), repeated.predict(at))
    for some in (np.zeros(3), np.ones(3), np.zeros(0)):
        np.testing.assert_array_equal(linear.fit_rising_curve(some, some).predict(at), at)
    # Falling shares are one pool.
    assert len(linear.fit_rising_curve(np.array([0.1, 0.9]), np.array([1.0, 0.0])).places) == 1

"""The pipeline stage by stage: what each keeps, and that every stage judges its own input."""

import public_tokenizers
import pyarrow as pa
from tokenizers import Tokenizer

import corpus_pipeline
from __spark_entry__ import queries
from tallyloom.llm import toxicity
from tests.llm.test_decontamination import brute_force
from tests.llm.test_near_duplicates import plain_classes
from tests.llm.test_packing import check_rows
from tests.llm.test_secrets import plain_base


def test_stages_one_after_the_other(spark, tables, tmp_path):
    docs = spark.read.parquet(f"{tables}/documents.parquet")
    columns = docs.columns
    items = [tuple(r) for r in spark.read.parquet(f"{tables}/benchmark.parquet").select("item_id", "text").collect()]
    held = {}
    for name, stage in corpus_pipeline.STAGES:
        out = str(tmp_path / name)
        stage(spark, docs, tables).write.parquet(out)
        before, docs = docs, spark.read.parquet(out)
        held[name] = docs
        rows, left = ({r["doc_id"]: r["text"] for r in f.collect()} if "text" in f.columns else {} for f in (before, docs))
        if name != "packing":
            assert docs.columns == columns
        if name == "toxicity":
            model = toxicity.fit_toxicity(before, spark.read.parquet(f"{tables}/labels.parquet"))
            scores = {r["doc_id"]: r["score"] for r in toxicity.score_texts(before, model).collect()}
            assert set(left) == {d for d, s in scores.items() if s < corpus_pipeline.TOXIC_LEAST} and 0 < len(left) < len(rows)
        elif name == "near_duplicates":
            listed = sorted(rows.items())
            classes = plain_classes(listed)
            assert set(left) == {c for c, _ in classes} | {d for d, t in listed if not t} and len(left) < len(rows)
        elif name == "decontamination":
            assert set(left) == {d for d, t in rows.items() if not brute_force(t, items)[3]} and len(left) < len(rows)
        elif name == "secrets":
            assert set(left) == set(rows)
            changed = {d for d in rows if rows[d] != left[d]}
            assert {d for d, t in rows.items() if plain_base(t or "")} <= changed
            assert all("[secret]" in left[d] for d in changed)
        elif name == "packing":
            tokenizer = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
            texts = [(r["doc_id"], r["text"]) for r in before.collect()]
            used, least = check_rows(docs.collect(), texts, tokenizer)
            assert used <= 1.02 * least + 1
    whole = queries()["pipeline"](spark, tables)
    own = ("doc_id", "piece", "start", "length", "ids_crc32")
    assert sorted(whole.select(*own).collect()) == sorted(held["packing"].select(*own).collect())


def test_rows_that_are_odd(spark, tables, tmp_path):
    schema = "doc_id BIGINT, text STRING, lang STRING, source STRING, n_chars BIGINT"
    rows = [(1, "plain words here", "en", "s", 16), (1, "plain words here", "en", "s", 16), (2, None, None, None, None)]
    rows += [(None, "", "en", "s", 0), (3, "token = 0123456789abcdef0", "en", "s", 25)]
    for k, given in enumerate((rows, [])):
        docs = spark.createDataFrame(given, schema)
        for name, stage in corpus_pipeline.STAGES:
            out = str(tmp_path / f"{k}-{name}")
            stage(spark, docs, tables).write.parquet(out)
            docs = spark.read.parquet(out)
        assert docs.select("doc_id").distinct().count() == (4 if given else 0)


def test_batches_are_bounded_by_bytes(spark, tables):
    """Long texts go to the workers a few at a time, however many rows a batch may have; a bound that is set stays."""
    names = [f"spark.sql.execution.arrow.{n}" for n in ("maxBytesPerBatch", "maxBytesPerOutputBatch")]
    before = {n: spark.conf.getAll.get(n) for n in names}

    def sizes(batches):
        for batch in batches:
            yield pa.RecordBatch.from_pydict({"n": [batch.nbytes]})

    try:
        for n in names:
            spark.conf.unset(n)
        docs = spark.range(0, 60, 1, 1).selectExpr("id AS doc_id", "repeat('long text ', 100000) AS text", "'en' AS lang", "'s' AS source", "1000000L AS n_chars")
        corpus_pipeline.mask_secrets(spark, docs.limit(0), tables)
        found = [r["n"] for r in docs.mapInArrow(sizes, "n LONG").collect()]
        assert len(found) > 10 and max(found) <= 2 * corpus_pipeline.BATCH_BYTES
        spark.conf.set(names[0], 1000)
        corpus_pipeline.bound_batches(spark)
        assert spark.conf.get(names[0]).rstrip("b") == "1000"
    finally:
        for n, value in before.items():
            spark.conf.unset(n) if value is None else spark.conf.set(n, value)


def test_a_large_batch_after_a_small_one(spark, tables):
    """Ten thousand short texts fill a batch of their own; a text longer than the bound on batches comes in the next."""
    name = "spark.sql.execution.arrow.maxBytesPer"
    before = {n: spark.conf.getAll.get(n) for n in (f"{name}Batch", f"{name}OutputBatch")}
    long = corpus_pipeline.BATCH_BYTES // 10 + 1000
    text = f"IF(id % 10001 = 10000, concat('token = 0123456789abcdef0 ', repeat('long text ', {long})), 'short text')"
    docs = spark.range(0, 30003, 1, 1).selectExpr("id AS doc_id", f"{text} AS text", "'en' AS lang", "'s' AS source", "10L AS n_chars")
    try:
        for n in before:
            spark.conf.unset(n)
        masked = corpus_pipeline.mask_secrets(spark, docs, tables).selectExpr("doc_id", "length(text) AS n", "left(text, 20) AS head").collect()
        assert [r["doc_id"] for r in masked] == list(range(30003))
        assert {(r["n"], r["head"]) for r in masked if r["doc_id"] % 10001 == 10000} == {(17 + 10 * long, "token = [secret] lon")}
        assert {(r["n"], r["head"]) for r in masked if r["doc_id"] % 10001 < 10000} == {(10, "short text")}
    finally:
        for n, value in before.items():
            spark.conf.unset(n) if value is None else spark.conf.set(n, value)

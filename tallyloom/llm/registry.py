"""Registered queries of the subpackage: thin readings of the operators, one for each contract."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyloom.llm import collocations, decontamination, edit_fingerprint, hidden_markov, near_duplicates, packing, page_text, quality, repeated_text, secret_scan, sharding, spelling_variants, toxicity
from tallyloom.llm.oracles import ORACLES
from tallyloom.operators.lineage import stored
from tallyloom.sources import read_table

SHARDS = [f"shard-{i:03d}" for i in range(64)]

__all__ = ["ORACLES", "QUERIES"]


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return read_table(spark, f"{sf_dir}/{name}.parquet")


def op1_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = decontamination.decontaminate(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))
    return judged.select(
        "doc_id",
        "n_words",
        "n_hit",
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
        "contaminated",
    )


def _fold(folds: int) -> F.Column:
    """Remainder of the CRC-32 of the id as text."""
    return F.crc32(F.col("doc_id").cast("string")) % folds


def op2_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = _table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels")
    model = toxicity.fit_toxicity(docs, labels.filter(_fold(3) != 1))
    return toxicity.score_texts(docs, model).select(
        "doc_id",
        F.coalesce(_fold(3) == 1, F.lit(False)).alias("held_out"),
        "score",
        (F.col("score") >= 0.7).cast("int").alias("predicted"),
    )


def op3_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.place_on_shards(_table(spark, sf_dir, "documents"), SHARDS)


def op4_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    classes = near_duplicates.near_duplicate_classes(_table(spark, sf_dir, "documents"))
    return classes.select("doc_id", "class_id", "class_size")


def op5_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = _table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels")
    model = quality.fit_quality(docs, labels.filter(_fold(5) != 0))
    return quality.score_quality(docs, model).select(
        "doc_id",
        F.coalesce(_fold(5) == 0, F.lit(False)).alias("held_out"),
        "score",
        (F.col("score") >= 0.3).cast("int").alias("predicted"),
    )


def op6_repeated_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    return repeated_text.remove_repeats(docs, repeated_text.repeated_spans(docs))


def op7_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(
        _table(spark, sf_dir, "documents"),
        public_tokenizers.path("byte_bpe_50k.json"),
        public_tokenizers.path("byte_bpe_50k.tiktoken"),
        public_tokenizers.PATTERN,
    )


def op8_page_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = _table(spark, sf_dir, "pages")
    return page_text.extract_pages(pages, page_text.fit_page_weights(pages))


def op9_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    found = secret_scan.find_secrets(docs, secret_scan.fit_random_model(docs))
    base = F.filter("spans", lambda s: s["kind"] != "random")

    def count(kind: str) -> F.Column:
        return F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long")

    def joined(spans: F.Column) -> F.Column:
        return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")

    return found.select(
        "doc_id",
        count("assign").alias("n_assign"),
        count("access").alias("n_access"),
        count("hex").alias("n_hex"),
        F.sha2(joined(base), 256).alias("base_sha256"),
        joined(F.col("spans")).alias("spans"),
    )


def op10_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return edit_fingerprint.compare_with_next(_table(spark, sf_dir, "documents"))


def fingerprint_classes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The second half of operator 10, banding and verification, apart from the contract of its query."""
    marked = stored(edit_fingerprint.mark_texts(_table(spark, sf_dir, "documents")))
    return edit_fingerprint.similar_classes(marked).select("doc_id", "class_id", "class_size")


def op11_language_model(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hidden_markov.score_corpus(_table(spark, sf_dir, "documents"), _fold(7) == 2)


def op12_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling_variants.spelling_variants(_table(spark, sf_dir, "documents"))


def op13_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = collocations.collocations(_table(spark, sf_dir, "documents"))
    return collocations.best_collocations(found).select("lang", "rank", "phrase", "a", "l", "r", "n", "score")


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    query.__name__: query
    for query in (
        op1_decontamination,
        op2_toxicity,
        op3_sharding,
        op4_near_duplicates,
        op5_quality,
        op6_repeated_text,
        op7_packing,
        op8_page_text,
        op9_secrets,
        op10_fingerprints,
        fingerprint_classes,
        op11_language_model,
        op12_spelling_variants,
        op13_collocations,
    )
}

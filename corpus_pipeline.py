"""The corpus pipeline: five stages over ``documents``, each an operator of ``tallyloom.llm``.

Every stage takes ``(spark, docs, sf_dir)``, judges all rows it is given and returns a frame; the frame is written
as Parquet and read again as the next stage's ``docs``. All stages but the last return the columns of
``documents``. A null text counts as empty; empty texts and repeated rows are kept or merged as each operator says.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from tallyloom.llm import decontamination, near_duplicates, packing, secret_scan, toxicity
from tallyloom.operators.lineage import stored
from tallyloom.sources import read_table

# A document goes if it is at least so likely to be toxic.
TOXIC_LEAST = 0.7

# Most bytes of texts that go to a Python worker at once; a longer row goes alone.
BATCH_BYTES = 4 << 20


def bound_batches(spark: SparkSession) -> None:
    """Bound the Arrow batches that go to the session's workers by bytes, unless the session sets such a bound itself.

    The default of 64 MB for each batch and task lies outside the heap and once more in the worker. A stage's frame is evaluated
    after the stage has returned, so the bound stays. There is none on what comes back (``maxBytesPerOutputBatch``): the operators
    make their batches from bounded ones, Spark would read such a batch whole before it cuts it, and Spark 4.1 fails if a batch over
    that bound follows one below it.
    """
    name = "spark.sql.execution.arrow.maxBytesPerBatch"
    if name not in spark.conf.getAll:
        spark.conf.set(name, BATCH_BYTES)


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that score as toxic go; the model learns from the labels of the documents given."""
    bound_batches(spark)
    model = toxicity.fit_toxicity(docs, read_table(spark, f"{sf_dir}/labels.parquet"))
    return toxicity.drop_toxic(docs, model, TOXIC_LEAST)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near duplicates stays, the one with the least id."""
    bound_batches(spark)
    return near_duplicates.keep_one_of_each(docs, near_duplicates.near_duplicate_classes(docs))


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents contaminated by the benchmark go."""
    bound_batches(spark)
    judged = decontamination.decontaminate(docs, read_table(spark, f"{sf_dir}/benchmark.parquet"))
    return decontamination.keep_clean(docs, judged)


def mask_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents stay; secrets in their texts are masked."""
    bound_batches(spark)
    return secret_scan.redact_documents(docs, secret_scan.fit_random_model(docs))


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of all documents with their place in a training sequence."""
    bound_batches(spark)
    return packing.pack_documents(
        docs,
        public_tokenizers.path("byte_bpe_50k.json"),
        public_tokenizers.path("byte_bpe_50k.tiktoken"),
        public_tokenizers.PATTERN,
    )


STAGES = [
    ("toxicity", drop_toxic),
    ("near_duplicates", drop_near_duplicates),
    ("decontamination", drop_contaminated),
    ("secrets", mask_secrets),
    ("packing", pack_sequences),
]

# SQL cannot express the stages; tests hold the run against a plain version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the table of documents."""
    docs = read_table(spark, f"{sf_dir}/documents.parquet")
    for _, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)

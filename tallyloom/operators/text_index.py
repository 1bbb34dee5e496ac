"""Inverted index over a text collection.

The long table ``word, doc, tf`` is the index at any size. Rendered postings
are cut into lines by blocks of documents, so that a word found in a large share of
all documents never has to fit into one row or one task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyloom.functions import fixed_text, half_up_ratio, words
from tallyloom.operators.lineage import stored

DOCUMENTS_PER_LINE = 100_000


def word_rows(docs: DataFrame, doc: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per word occurrence: ``word, doc``."""
    return docs.select(
        F.explode(words(text)).alias("word"), F.col(doc).alias("doc")
    ).filter(F.col("word") != "")


def word_occurrences(docs: DataFrame, doc: str = "doc_id", text: str = "text") -> DataFrame:
    """Number of word occurrences on every row: ``doc, words``; counted in place."""
    found = F.size(F.filter(words(text), lambda w: w != ""))
    return docs.select(F.col(doc).alias("doc"), F.when(F.col(text).isNull(), 0).otherwise(found).cast("long").alias("words"))


def term_document_counts(
    docs: DataFrame, doc: str = "doc_id", text: str = "text"
) -> DataFrame:
    """Occurrences of each word in each document: ``word, doc, tf``.

    A document may span many rows (one per line). Counting starts before the
    shuffle, and the pair as key spreads a frequent word over all tasks.
    """
    return word_rows(docs, doc, text).groupBy("word", "doc").agg(
        F.count(F.lit(1)).alias("tf")
    )


def whole_document_counts(
    docs: DataFrame, doc: str = "doc_id", text: str = "text"
) -> DataFrame:
    """``word, doc, tf`` without a shuffle, where every row is a whole document.

    The words of a row are sorted, and the length of each run is its count. The
    caller vouches that no document has a second row; otherwise use
    ``term_document_counts``.
    """
    tokens = F.col("tokens")
    # The null-safe tests keep the optimizer from splitting each text twice.
    starts = F.filter(
        F.sequence(F.lit(0), F.size(tokens) - 1),
        lambda i: (i == 0) | (F.get(tokens, i) != F.get(tokens, i - 1)),
    )
    runs = (
        docs.select(F.col(doc).alias("doc"), F.sort_array(words(text)).alias("tokens"))
        .select("doc", "tokens", starts.alias("starts"))
        .select("doc", "tokens", "starts", F.posexplode_outer("starts").alias("run", "start"))
    )
    end = F.coalesce(F.get("starts", F.col("run") + 1), F.size(tokens))
    return runs.select(
        F.get(tokens, F.col("start")).alias("word"),
        "doc",
        (end - F.col("start")).cast("long").alias("tf"),
    ).filter(F.coalesce("word", F.lit("")) != "")


def term_average_frequency(counts: DataFrame) -> DataFrame:
    """Mean occurrences of a word over the documents that contain it.

    ``word, total, documents, average``; the average has two decimals.
    """
    totals = counts.groupBy("word").agg(
        F.sum("tf").alias("total"), F.count(F.lit(1)).alias("documents")
    )
    return totals.withColumn(
        "average", half_up_ratio(F.col("total"), F.col("documents"), 2)
    )


def inverted_index_postings(
    counts: DataFrame, block: Column | None = None, documents_per_line: int = DOCUMENTS_PER_LINE
) -> DataFrame:
    """Postings per word: ``word, line_no, documents, average, postings``.

    ``postings`` reads ``doc:n; doc:n`` in document order. Every word is cut by blocks of
    documents, ``block``, so a line never holds more postings than a block has documents, however
    frequent the word. By default ``doc`` is a number, and a block is a range of
    ``documents_per_line`` of them; the lines of a word, taken by ``line_no``, are then in document order. ``documents``
    and ``average`` always describe the whole word.

    The lines are written once to the shared folder; the totals of the words are read from
    their narrow columns.
    """
    if block is None:
        block = F.floor(F.col("doc") / documents_per_line).cast("long")
    # Text is made after the shuffle, which then carries each document id once.
    listed = F.transform(
        F.sort_array(F.collect_list(F.struct("doc", "tf"))),
        lambda p: F.concat(p["doc"].cast("string"), F.lit(":"), p["tf"].cast("string")),
    )
    lines = stored(
        counts.withColumn("line_no", block)
        .groupBy("word", "line_no")
        .agg(
            F.sum("tf").alias("line_total"),
            F.count(F.lit(1)).alias("line_documents"),
            F.array_join(listed, "; ").alias("postings"),
        )
    )
    total, found = F.sum("line_total"), F.sum("line_documents")
    words_found = lines.groupBy("word").agg(
        found.alias("documents"), half_up_ratio(total, found, 2).alias("average")
    )
    return lines.join(words_found, "word").select("word", "line_no", "documents", "average", "postings")


def document_blocks(doc: str = "doc", blocks: int = 1) -> Column:
    """Block number for documents named by text: a hash into as many blocks as the caller wants, the same for every word."""
    return F.pmod(F.xxhash64(doc), F.lit(blocks))


def repeated_documents(docs: DataFrame, doc: str = "doc_id") -> DataFrame:
    """Ids found on more than one row, with their number of rows: empty where ``whole_document_counts`` may be used."""
    return docs.groupBy(doc).agg(F.count(F.lit(1)).alias("rows")).filter("rows > 1")


def index_lines(postings: DataFrame) -> DataFrame:
    """Postings as key and value text: ``word, value`` with ``average, doc:n; …``."""
    return postings.select(
        "word",
        F.concat(fixed_text(F.col("average"), 2), F.lit(", "), "postings").alias("value"),
    )


def averages_from_lines(key_values: DataFrame) -> DataFrame:
    """Recover ``word, average`` from written index lines.

    The average is the text before the first comma. A word split over several
    lines carries the same average on each and comes back once.
    """
    return (
        key_values.select(
            F.col("key").alias("word"),
            F.substring_index("value", ",", 1).cast("double").alias("average"),
        )
        .groupBy("word")
        .agg(F.max("average").alias("average"))
    )


def words_by_frequency(averages: DataFrame, descending: bool = False) -> DataFrame:
    """Words in total order of their average; equal averages go by word.

    The word is part of the sort key, so the many words that share an average
    still spread over all range partitions.
    """
    average = F.col("average").desc() if descending else F.col("average").asc()
    return averages.select("word", "average").orderBy(average, F.col("word").asc())


def frequency_lines(ordered: DataFrame) -> DataFrame:
    """Ordered words with their average as text of two decimals, order kept."""
    return ordered.select("word", fixed_text(F.col("average"), 2).alias("average"))

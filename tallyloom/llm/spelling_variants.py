"""Spelling variants, found over a reduced alphabet.

Letters are hashed to a few symbols. Two words that differ by one edit have reduced words that are equal or differ
by one edit, so the full one-edit neighbourhood of every reduced word, joined with the reduced vocabulary, meets
all pairs of near words; pairs that are near in reduced form only are told apart on the words themselves. A
neighbourhood over a few symbols is small: its size does not depend on the alphabet. An unordered pair is met once,
from the longer of two reduced words or from the one with the lesser symbol, and the neighbourhood by insertion is thus that by deletion
of the other word.

The number of symbols follows the vocabulary, so that reduced words stay rare enough; pairs found are the same for any
number.

Rows: a null text has no words; a null ``doc_id`` counts as the empty text before the colon of the planted edit. Repeated rows
count as often as they stand there, an empty table gives no rows, other columns are not read. A word of any length is
handled whole; its neighbourhood grows with its length squared, in bytes.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from zlib import crc32

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyloom.operators.lineage import discard, stored

# Least code points and occurrences of a word, and the ratio of occurrences that makes a near word its form.
LEAST_LENGTH, LEAST_COUNT, FORM_RATIO = 5, 3, 2

# An occurrence loses a letter if this divides its checksum.
EDIT_EACH = 97

# The letters of a word, after A-Z have become a-z.
LETTERS = "".join(map(chr, [*range(0x61, 0x7B), *range(0xC0, 0x100)]))
_RUN = re.compile("[A-Za-zÀ-ÿ]+")
_LOWER = bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))

# Symbols of the reduced alphabet; the least and the most there may be.
SYMBOLS = "abcdefghijklmnop"
LEAST_SYMBOLS = 4

# Distinct words a task counts before it hands their counts on.
HELD_WORDS = 200_000


def run_counts(docs: DataFrame, edit_each: int = EDIT_EACH) -> DataFrame:
    """``word, n``: runs of letters, some of them edited as the checksum of id and run says, in partial counts."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: Counter = Counter()
        for batch in batches:
            for doc, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                if not text.is_valid:
                    continue
                lowered = text.as_buffer().to_pybytes().translate(_LOWER).decode()
                start = crc32(f"{doc}:".encode())
                for run, n in Counter(_RUN.findall(lowered)).items():
                    check = crc32(run.encode(), start)
                    if check % edit_each == 0:
                        at = check % len(run)
                        run = run[:at] + run[at + 1 :]
                    held[run] += n
                if len(held) > HELD_WORDS:
                    yield pa.RecordBatch.from_pydict({"word": list(held), "n": list(held.values())})
                    held.clear()
        yield pa.RecordBatch.from_arrays([pa.array(held, pa.string()), pa.array(held.values(), pa.int64())], names=["word", "n"])

    return docs.select(F.coalesce(F.col("doc_id").cast("string"), F.lit("")), "text").mapInArrow(count, "word STRING, n LONG")


def vocabulary(docs: DataFrame, edit_each: int = EDIT_EACH) -> DataFrame:
    """``word, n`` of all words that are long and frequent enough."""
    counted = run_counts(docs, edit_each).filter(F.char_length("word") >= LEAST_LENGTH)
    return counted.groupBy("word").agg(F.sum("n").alias("n")).filter(F.col("n") >= LEAST_COUNT)


def symbols_for(words: int) -> int:
    """Symbols with which six letters have about as many reduced forms as there are words."""
    return next((s for s in range(LEAST_SYMBOLS, len(SYMBOLS)) if s**6 >= words), len(SYMBOLS))


def reduced(word: Column, symbols: int) -> Column:
    """The word over the reduced alphabet; every letter has a symbol by a hash of its code point."""
    images = "".join(SYMBOLS[(ord(c) * 2654435761 >> 16) % symbols] for c in LETTERS)
    return F.translate(word, LETTERS, images)


def neighbourhood(word: Column, symbols: int) -> Column:
    """The reduced word, what is left after one deletion, and what one greater symbol in place of another gives."""
    places = F.sequence(F.lit(1), F.char_length(word))
    signs = F.array(*[F.lit(s) for s in SYMBOLS[:symbols]])

    def without(i: Column) -> Column:
        return F.concat(F.substring(word, F.lit(1), i - 1), F.substring(word, i + 1, F.char_length(word)))

    def replaced(i: Column) -> Column:
        greater = F.filter(signs, lambda s: s > F.substring(word, i, F.lit(1)))
        return F.transform(
            greater, lambda s: F.concat(F.substring(word, F.lit(1), i - 1), s, F.substring(word, i + 1, F.char_length(word)))
        )

    shorter = F.array_distinct(F.transform(places, without))
    return F.concat(F.array(word), shorter, F.flatten(F.transform(places, replaced)))


def near_pairs(words: DataFrame, symbols: int) -> DataFrame:
    """Unordered pairs of words that differ by exactly one edit: ``word, n, other, other_n``, each pair once."""
    forms = words.withColumn("form", reduced(F.col("word"), symbols))
    distinct = forms.select("form").distinct()
    meetings = distinct.select("form", F.explode(neighbourhood(F.col("form"), symbols)).alias("near")).join(
        distinct.select(F.col("form").alias("near")), "near"
    )
    others = forms.select(F.col("word").alias("other"), F.col("n").alias("other_n"), F.col("form").alias("near"))
    same = F.col("form") == F.col("near")
    return (
        meetings.join(forms, "form")
        .join(others, "near")
        .filter(~same | (F.col("word") < F.col("other")))
        .filter(F.levenshtein("word", "other", 1) == 1)
        .select("word", "n", "other", "other_n")
    )


def follow(forms: DataFrame) -> DataFrame:
    """``word, root`` for every word that has a form: the last word that forms lead to.

    Ways are doubled in each round. A form has at least twice its word's count, so rounds grow with the logarithm of the
    logarithm of the largest count.
    """
    ways = stored(forms.select("word", F.col("form").alias("root")))
    while True:
        ahead = ways.select(F.col("word").alias("root"), F.col("root").alias("next"))
        before, ways = ways, stored(ways.join(ahead, "root", "left").select("word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved")))
        discard(before)
        if ways.filter("moved").isEmpty():
            return ways.select("word", "root")
        ways = ways.select("word", "root")


def spelling_variants(docs: DataFrame, edit_each: int = EDIT_EACH, symbols: int | None = None) -> DataFrame:
    """Every word with its form and root: ``word, form, root, n, n_near, form_n``.

    The form is the near word that occurs most often (ties: the first in code-point order), if it occurs at least
    ``FORM_RATIO`` times as often as the word. ``form`` and ``form_n`` are null without one; ``root`` is then the word.
    """
    words = stored(vocabulary(docs, edit_each))
    pairs = near_pairs(words, symbols or symbols_for(words.count()))
    sides = pairs.select(
        F.inline(
            F.array(
                F.struct("word", F.struct((-F.col("other_n")).alias("n"), F.col("other").alias("word")).alias("best")),
                F.struct(F.col("other").alias("word"), F.struct((-F.col("n")).alias("n"), F.col("word").alias("word")).alias("best")),
            )
        )
    )
    found = stored(
        words.join(sides.groupBy("word").agg(F.count(F.lit(1)).alias("n_near"), F.min("best").alias("best")), "word", "left")
        .withColumn("form_n", F.when(-F.col("best.n") >= FORM_RATIO * F.col("n"), -F.col("best.n")))
        .select("word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"), "form_n",
                F.when(F.col("form_n").isNotNull(), F.col("best.word")).alias("form"))
    )
    discard(words)
    return found.join(follow(found.filter("form IS NOT NULL")), "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n"
    )

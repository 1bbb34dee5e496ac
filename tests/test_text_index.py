import random
from collections import Counter, defaultdict

import pytest

from tallyloom.operators import text_index as ti


def counts_of(spark, rows):
    return ti.term_document_counts(spark.createDataFrame(rows, "doc_id STRING, text STRING"))


def test_counts_start_anew_for_each_word(spark):
    counts = counts_of(spark, [("f1", "apple apple pear"), ("f2", "apple pear pear")])
    assert {tuple(r) for r in counts.collect()} == {
        ("apple", "f1", 2), ("apple", "f2", 1), ("pear", "f1", 1), ("pear", "f2", 2),
    }
    assert {tuple(r) for r in ti.term_average_frequency(counts).collect()} == {
        ("apple", 3, 2, 1.5), ("pear", 3, 2, 1.5),
    }


@pytest.mark.parametrize("count", [ti.term_document_counts, ti.whole_document_counts])
def test_whitespace_and_case(spark, count):
    rows = [("d", "  A\ta  \n b\r\fb A "), ("empty", "   "), ("nothing", ""), ("none", None)]
    counts = count(spark.createDataFrame(rows, "doc_id STRING, text STRING"))
    assert {tuple(r) for r in counts.collect()} == {("A", "d", 2), ("a", "d", 1), ("b", "d", 2)}


def test_document_over_many_rows(spark):
    counts = counts_of(spark, [("d", "x y"), ("d", "x"), ("e", "y")])
    assert {tuple(r) for r in counts.collect()} == {("x", "d", 2), ("y", "d", 1), ("y", "e", 1)}


def test_average_rounds_halves_up(spark):
    rows = [(f"d{i}", "w w" if i == 0 else "w") for i in range(8)]
    assert ti.term_average_frequency(counts_of(spark, rows)).first()["average"] == 1.13


def test_postings_in_document_order(spark):
    counts = counts_of(spark, [("f2", "b a"), ("f1", "a a"), ("f10", "a")])
    postings = ti.inverted_index_postings(counts, ti.document_blocks())
    lines = {r["word"]: r["value"] for r in ti.index_lines(postings).collect()}
    assert lines == {"a": "1.33, f1:2; f10:1; f2:1", "b": "1.00, f2:1"}


@pytest.mark.parametrize("per_line", [1, 3, 50, 1000])
def test_lines_of_a_word_hold_every_posting_in_order(spark, per_line):
    rng = random.Random(5)
    rows = [
        (i, " ".join(["the"] + [rng.choice("abcdefgh") for _ in range(rng.randint(0, 9))]))
        for i in range(120)
    ]
    expected, total = defaultdict(dict), Counter()
    for doc, text in rows:
        for word, n in Counter(text.split()).items():
            expected[word][doc] = n
            total[word] += n
    docs = spark.createDataFrame(rows, "doc_id BIGINT, text STRING")
    found = defaultdict(list)
    lines = ti.inverted_index_postings(ti.whole_document_counts(docs), documents_per_line=per_line)
    for r in sorted(lines.collect(), key=lambda r: (r["word"], r["line_no"])):
        pairs = [tuple(map(int, p.split(":"))) for p in r["postings"].split("; ")]
        assert {d // per_line for d, _ in pairs} == {r["line_no"]}
        assert r["documents"] == len(expected[r["word"]])
        assert r["average"] == pytest.approx(total[r["word"]] / r["documents"], abs=0.0051)
        found[r["word"]] += pairs
    assert {w: list(sorted(d.items())) for w, d in expected.items()} == found


def test_documents_named_by_text_share_blocks(spark):
    counts = counts_of(spark, [(f"d{i}", "a b" if i % 2 else "a") for i in range(40)])
    lines = ti.inverted_index_postings(counts, ti.document_blocks(blocks=3)).collect()
    names = [p.split(":")[0] for r in lines if r["word"] == "a" for p in r["postings"].split("; ")]
    assert sorted(names) == sorted(f"d{i}" for i in range(40)) and len(lines) <= 6
    assert {r["documents"] for r in lines if r["word"] == "b"} == {20}


def test_same_sql_with_short_lines(spark, tables):
    from tallyloom.plans.oracles import TEXT
    from tests.compare import connect, difference

    sql = TEXT["inverted_index_postings"].replace("doc // 100000", "doc // 50")
    docs = spark.read.parquet(f"{tables}/documents.parquet")
    lines = ti.inverted_index_postings(ti.whole_document_counts(docs), documents_per_line=50)
    assert difference(lines, connect(tables), sql) is None


def test_second_rows_of_a_document_are_found(spark):
    docs = spark.createDataFrame([(1, "a"), (2, "b"), (1, "c")], "doc_id BIGINT, text STRING")
    assert [tuple(r) for r in ti.repeated_documents(docs).collect()] == [(1, 2)]


def test_words_counted_in_place(spark):
    docs = spark.createDataFrame([(1, " a b  a "), (2, ""), (3, None)], "doc_id BIGINT, text STRING")
    assert {tuple(r) for r in ti.word_occurrences(docs).collect()} == {(1, 3), (2, 0), (3, 0)}


def test_both_ways_to_count_agree(spark, tables):
    docs = spark.read.parquet(f"{tables}/documents.parquet")
    one, two = ti.term_document_counts(docs), ti.whole_document_counts(docs)
    assert one.exceptAll(two).count() == two.exceptAll(one).count() == 0


def test_order_both_ways(spark):
    averages = spark.createDataFrame([("b", 2.0), ("a", 2.0), ("c", 10.0), ("d", 9.5)], "word STRING, average DOUBLE")
    assert [r["word"] for r in ti.words_by_frequency(averages).collect()] == ["a", "b", "d", "c"]
    assert [r["word"] for r in ti.words_by_frequency(averages, True).collect()] == ["c", "d", "a", "b"]


def test_averages_read_back_from_lines(spark):
    counts = counts_of(spark, [("f1", "a a b"), ("f2", "a")])
    postings = ti.inverted_index_postings(counts, ti.document_blocks(blocks=2))
    lines = ti.index_lines(postings).withColumnRenamed("word", "key")
    assert {tuple(r) for r in ti.averages_from_lines(lines).collect()} == {("a", 1.5), ("b", 1.0)}


def test_postings_sum_to_the_number_of_words(spark, tables):
    docs = spark.read.parquet(f"{tables}/documents.parquet")
    words = ti.word_rows(docs).count()
    assert ti.term_document_counts(docs).agg({"tf": "sum"}).first()[0] == words

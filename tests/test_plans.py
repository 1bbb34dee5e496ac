"""Shape of the physical plans."""

import re

import pytest

from tallyloom.operators import playlog, text_index
from tallyloom.plans import registry


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


LAZY = [
    name
    for name in registry.QUERIES
    if not name.startswith(("kmeans", "win_model", "team_ratings", "predict"))
]


@pytest.mark.parametrize("name", LAZY)
def test_no_python_and_no_cross_product(spark, tables, name):
    text = plan(registry.QUERIES[name](spark, tables))
    for word in ("EvalPython", "CartesianProduct", "BroadcastNestedLoopJoin", "MapInArrow"):
        assert word not in text


def test_join_is_broadcast(spark, tables):
    assert "BroadcastHashJoin" in plan(registry.supplier_nation_join(spark, tables))


@pytest.mark.parametrize("name", ["leaderboard_top5", "leaderboard_distinct_top5"])
def test_rows_are_dropped_before_the_ranking_shuffle(spark, tables, name):
    text = plan(registry.QUERIES[name](spark, tables))
    assert re.search(r"WindowGroupLimit .*Partial", text)


@pytest.mark.parametrize("name", ["match_features", "player_stat_totals", "match_scores"])
def test_the_log_is_read_once(spark, tables, name):
    assert plan(registry.QUERIES[name](spark, tables)).count("FileScan") == 1


def test_totals_start_before_the_shuffle(spark, tables):
    text = plan(playlog.player_totals(playlog.player_facts(registry.plays(spark, tables))))
    assert text.count("Exchange") == 1 and "partial_sum" in text


def test_index_counts_shuffle_once_and_read_two_columns(spark, tables):
    docs = spark.read.parquet(f"{tables}/documents.parquet")
    text = plan(text_index.term_document_counts(docs))
    assert text.count("Exchange") == 1 and "partial_count" in text
    assert "ReadSchema: struct<doc_id:bigint,text:string>" in text


def test_whole_documents_are_counted_in_place(spark, tables):
    docs = spark.read.parquet(f"{tables}/documents.parquet")
    text = plan(text_index.whole_document_counts(docs))
    assert "Exchange" not in text and text.count("split(") == 1


def test_one_shuffle_for_averages(spark, tables):
    counts = text_index.whole_document_counts(spark.read.parquet(f"{tables}/documents.parquet"))
    assert plan(text_index.term_average_frequency(counts)).count(" Exchange") == 1


def test_filters_reach_the_scan(spark, tables):
    text = plan(registry.plays(spark, tables).filter("event_id < 10"))
    assert "LessThan(event_id,10)" in text


def test_assignment_moves_no_rows(spark, tables):
    text = plan(registry.kmeans_assign(spark, tables))
    assert "Exchange" not in text and "ArrowEvalPython" in text

"""Registered queries: each takes a session and a folder of Parquet tables."""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyloom.operators import bounded_clustering, clustering, playlog, relational, text_index, win_model
from tallyloom.operators.lineage import settled
from tallyloom.plans.plays import plays_from_events
from tallyloom.sources import read_table, spread

CLUSTERS = 10


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return read_table(spark, f"{sf_dir}/{name}.parquet")


def _rounded(value: Column) -> Column:
    """Six decimals, without a negative zero."""
    return F.round(value, 6) + F.lit(0.0)


# --- join -------------------------------------------------------------------


def _joined(spark: SparkSession, sf_dir: str) -> DataFrame:
    return relational.supplier_nation_join(
        _table(spark, sf_dir, "supplier"), _table(spark, sf_dir, "nation"), carried="s_acctbal"
    )


def supplier_nation_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return relational.by_supplier(_joined(spark, sf_dir))


def supplier_nation_tagged_union(spark: SparkSession, sf_dir: str) -> DataFrame:
    return relational.tagged_union(
        _table(spark, sf_dir, "supplier"), _table(spark, sf_dir, "nation"), carried="s_acctbal"
    )


def supplier_partition_sort(spark: SparkSession, sf_dir: str) -> DataFrame:
    return relational.sorted_parts(_joined(spark, sf_dir), "s_suppkey")


def supplier_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    whole = _joined(spark, sf_dir).withColumn("s_acctbal", F.col("s_acctbal").cast("decimal(12,2)"))
    return whole.select(relational.supplier_line(carried="s_acctbal").alias("line"))


# --- text index -------------------------------------------------------------


def _documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spread(_table(spark, sf_dir, "documents").select("doc_id", "text"))


def _counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts of the table of documents, which has one row per ``doc_id`` (``text_index.repeated_documents`` checks it)."""
    return text_index.whole_document_counts(_documents(spark, sf_dir))


def word_occurrences(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = text_index.word_occurrences(_documents(spark, sf_dir))
    return found.filter("words > 0")


def term_document_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return text_index.term_document_counts(_documents(spark, sf_dir))


def whole_document_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _counts(spark, sf_dir)


def term_average_frequency(spark: SparkSession, sf_dir: str) -> DataFrame:
    return text_index.term_average_frequency(_counts(spark, sf_dir))


def inverted_index_postings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return text_index.inverted_index_postings(_counts(spark, sf_dir))


def inverted_index_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return text_index.index_lines(inverted_index_postings(spark, sf_dir))


def words_by_frequency_asc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return text_index.words_by_frequency(term_average_frequency(spark, sf_dir))


def words_by_frequency_desc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return text_index.words_by_frequency(term_average_frequency(spark, sf_dir), descending=True)


# --- play log ---------------------------------------------------------------


def plays(spark: SparkSession, sf_dir: str) -> DataFrame:
    return plays_from_events(_table(spark, sf_dir, "events"))


def event_outcome_label(spark: SparkSession, sf_dir: str) -> DataFrame:
    return playlog.outcome_labels(plays(spark, sf_dir))


def event_outcome_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return playlog.outcome_lines(plays(spark, sf_dir))


def match_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    return playlog.scores_in_order(playlog.match_scores(plays(spark, sf_dir)))


def match_score_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return playlog.match_score_lines(match_scores(spark, sf_dir))


def player_stat_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    return playlog.player_totals(playlog.player_facts(plays(spark, sf_dir)))


def leaderboard_top5(spark: SparkSession, sf_dir: str) -> DataFrame:
    return playlog.leaderboard(player_stat_totals(spark, sf_dir))


def leaderboard_distinct_top5(spark: SparkSession, sf_dir: str) -> DataFrame:
    return playlog.leaderboard_distinct(player_stat_totals(spark, sf_dir))


def leaderboard_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return playlog.leaderboard_lines(leaderboard_top5(spark, sf_dir))


def head_to_head_share(spark: SparkSession, sf_dir: str) -> DataFrame:
    return playlog.head_to_head(playlog.match_scores(plays(spark, sf_dir)))


def head_to_head_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return playlog.head_to_head_lines(head_to_head_share(spark, sf_dir))


def match_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    return playlog.match_features(plays(spark, sf_dir))


def match_profile_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return playlog.match_profile_lines(match_features(spark, sf_dir))


def team_profiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    profiles = playlog.team_profiles(match_features(spark, sf_dir))
    return profiles.select("team", *[_rounded(F.col(r)).alias(r) for r in playlog.PROFILE])


def team_profiles_from_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    matches = playlog.parse_match_profiles(match_profile_lines(spark, sf_dir))
    profiles = playlog.team_profiles(matches)
    return profiles.select("team", *[_rounded(F.col(r)).alias(r) for r in playlog.PROFILE])


# --- clustering -------------------------------------------------------------


def _points(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _table(spark, sf_dir, "embeddings")


def _starting_centers(points: DataFrame) -> np.ndarray:
    """The usable vectors with the lowest ids; only these are read in full."""
    given = points.filter(clustering.usable(F.col("embedding")))
    ids = [r["vec_id"] for r in given.select("vec_id").orderBy("vec_id").limit(CLUSTERS).collect()]
    first = given.filter(F.col("vec_id").isin(ids)).select("vec_id", "embedding").orderBy("vec_id").collect()
    return np.array([r["embedding"] for r in first], dtype=np.float64)


def _fit(points: DataFrame) -> clustering.Clustering:
    return clustering.fit(points, _starting_centers(points), vector="embedding")


def _long_centers(spark: SparkSession, centers: np.ndarray) -> DataFrame:
    return clustering.centers_frame(spark, centers).select(
        "cluster", F.posexplode("center").alias("dim", "value")
    ).withColumn("value", _rounded(F.col("value")))


def kmeans_assign(spark: SparkSession, sf_dir: str) -> DataFrame:
    points = _points(spark, sf_dir)
    assigned = clustering.assign(points, _starting_centers(points), vector="embedding")
    return assigned.select("vec_id", "label", "cluster")


def kmeans_step(spark: SparkSession, sf_dir: str) -> DataFrame:
    points = _points(spark, sf_dir)
    moved, _, _ = clustering.lloyd_step(points, _starting_centers(points), vector="embedding")
    return _long_centers(spark, moved)


def kmeans_fit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _long_centers(spark, _fit(_points(spark, sf_dir)).centers)


def kmeans_bounded_fit(spark: SparkSession, sf_dir: str) -> DataFrame:
    points = _points(spark, sf_dir)
    fitted = bounded_clustering.fit_bounded(points, _starting_centers(points), vector="embedding")
    return _long_centers(spark, fitted.centers)


def kmeans_shift_by_step(spark: SparkSession, sf_dir: str) -> DataFrame:
    shifts = _fit(_points(spark, sf_dir)).shifts_frame(spark)
    return shifts.select("step", _rounded(F.col("shift")).alias("shift"))


def kmeans_final_assign(spark: SparkSession, sf_dir: str) -> DataFrame:
    points = _points(spark, sf_dir)
    assigned = clustering.assign(points, _fit(points).centers, vector="embedding")
    return assigned.select("vec_id", "label", "cluster")


# --- win model --------------------------------------------------------------


def _matches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The match table, far smaller than the log, written out once for all rounds."""
    return settled(match_features(spark, sf_dir))


def _model(matches: DataFrame) -> win_model.WinModel:
    return win_model.fit_win_model(matches)


def _ratings(
    matches: DataFrame, profiles: DataFrame, model: win_model.WinModel
) -> win_model.TeamRatings:
    return win_model.fit_team_ratings(matches, profiles, model)


def win_model_fit(spark: SparkSession, sf_dir: str) -> DataFrame:
    model = _model(_matches(spark, sf_dir))
    weights = spark.createDataFrame(model.rows(), "part STRING, i INT, j INT, weight DOUBLE")
    return weights.withColumn("weight", _rounded(F.col("weight")))


def team_ratings_fit(spark: SparkSession, sf_dir: str) -> DataFrame:
    matches = _matches(spark, sf_dir)
    fitted = _ratings(matches, playlog.team_profiles(matches), _model(matches))
    return fitted.teams.select(
        "team",
        "matches",
        *[_rounded(F.col(c)).alias(c) for c in win_model.RATING_COLUMNS],
        _rounded(F.lit(fitted.ratio)).alias("ratio"),
    )


def win_model_newton(spark: SparkSession, sf_dir: str) -> DataFrame:
    model = win_model.fit_win_model_newton(_matches(spark, sf_dir))
    weights = spark.createDataFrame(model.rows(), "part STRING, i INT, j INT, weight DOUBLE")
    return weights.withColumn("weight", _rounded(F.col("weight")))


def team_ratings_in_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    matches = _matches(spark, sf_dir)
    fitted = win_model.ratings_in_order(matches, playlog.team_profiles(matches), _model(matches))
    return fitted.teams.select("team", "matches", *[_rounded(F.col(c)).alias(c) for c in win_model.RATING_COLUMNS])


def predict_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    matches = _matches(spark, sf_dir)
    profiles = settled(playlog.team_profiles(matches))
    model = _model(matches)
    ratings = _ratings(matches, profiles, model)
    swapped = matches.select(
        F.col("home_team").alias("away_team"), F.col("away_team").alias("home_team")
    ).distinct()
    scored = win_model.predict_pairs(swapped, profiles, ratings, model)
    return scored.withColumn("p_away", _rounded(F.col("p_away")))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    query.__name__: query
    for query in (
        supplier_nation_join,
        supplier_nation_tagged_union,
        supplier_partition_sort,
        supplier_lines,
        word_occurrences,
        term_document_counts,
        whole_document_counts,
        term_average_frequency,
        inverted_index_postings,
        inverted_index_lines,
        words_by_frequency_asc,
        words_by_frequency_desc,
        event_outcome_label,
        event_outcome_lines,
        match_scores,
        match_score_lines,
        player_stat_totals,
        leaderboard_top5,
        leaderboard_distinct_top5,
        leaderboard_lines,
        head_to_head_share,
        head_to_head_lines,
        match_features,
        match_profile_lines,
        team_profiles_from_lines,
        team_profiles,
        kmeans_assign,
        kmeans_step,
        kmeans_fit,
        kmeans_bounded_fit,
        kmeans_shift_by_step,
        kmeans_final_assign,
        win_model_fit,
        win_model_newton,
        team_ratings_fit,
        team_ratings_in_order,
        predict_pairs,
    )
}

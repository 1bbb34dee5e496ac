"""Whole jobs from text folders to text folders.

Each job replaces its output. ``python -m tallyloom.plans.file_jobs NAME ARG …``
runs one under ``spark-submit`` as well.
"""

from __future__ import annotations

import sys

from pyspark.sql import DataFrame, SparkSession

from tallyloom.operators import clustering, playlog, relational, text_index, win_model
from tallyloom.operators.lineage import path_exists, settled
from tallyloom.sources import (
    read_centers,
    read_checked,
    read_named_lines,
    read_nations,
    read_pairs,
    read_play_log,
    read_points,
    read_suppliers,
    read_table,
    write_centers,
    write_csv,
    write_key_values,
    write_line_parts,
    write_lines,
    write_parquet,
)


def _play_log(spark: SparkSession, log: str, refused: str | None) -> DataFrame:
    """The play log; with a folder for ``refused`` lines they go there and their number is told, else the first one stops the job."""
    if refused is None:
        return read_play_log(spark, log)
    found = read_checked(spark, log, "play_log")
    write_csv(found.refused, refused, sep="\t")
    print(f"{spark.read.text(refused).count()} lines refused", file=sys.stderr)
    return found.rows


def text_index_job(spark: SparkSession, texts: str, out: str, descending: bool = True, blocks: int | None = None) -> None:
    """Index of a folder of text files under ``index``, its words by frequency under ``sorted``.

    The counts are kept as a table under ``counts``; both outputs start from it. Documents are named by
    their paths, so they are dealt into ``blocks`` by a hash; a word has a line for each block it is found in. By default
    a block has about ``DOCUMENTS_PER_LINE`` of the documents counted.
    """
    lines = read_named_lines(spark, texts)
    write_parquet(
        text_index.term_document_counts(lines, doc="file_name", text="line"), f"{out}/counts"
    )
    counts = read_table(spark, f"{out}/counts")
    if blocks is None:
        blocks = max(1, -(-counts.select("doc").distinct().count() // text_index.DOCUMENTS_PER_LINE))
    postings = text_index.inverted_index_postings(counts, text_index.document_blocks(blocks=int(blocks)))
    write_key_values(text_index.index_lines(postings), f"{out}/index", "word", "value")
    ordered = text_index.words_by_frequency(text_index.term_average_frequency(counts), descending)
    write_key_values(text_index.frequency_lines(ordered), f"{out}/sorted", "word", "average")


def join_job(spark: SparkSession, suppliers: str, nations: str, out: str, parts: int = 4) -> None:
    """Suppliers with nation names, in one ordered folder per ``key % parts``."""
    joined = relational.supplier_nation_join(
        read_suppliers(spark, suppliers), read_nations(spark, nations)
    )
    ordered = relational.sorted_parts(joined, "s_suppkey", parts)
    lines = ordered.select(relational.supplier_line().alias("line"), "part_id")
    write_line_parts(lines, out, "line", "part_id")


def kmeans_job(
    spark: SparkSession, points: str, centers: str, out: str, threshold: float = 0.001, resume: bool = False
) -> clustering.Clustering:
    """Centres of every step under ``temp``, the last under ``centers``, points under ``assigned``.

    The points are parsed once, into the table ``points``. With ``resume`` a job that was broken off goes on from the last
    complete step under ``temp``, and the points are parsed anew only if that was not done.
    """
    if not (resume and path_exists(spark, f"{out}/points/_SUCCESS")):
        write_parquet(read_points(spark, points), f"{out}/points")
    vectors = read_table(spark, f"{out}/points")
    start = clustering.collect_centers(read_centers(spark, centers))
    found = clustering.fit(
        vectors, start, threshold=float(threshold), snapshot_dir=f"{out}/temp", resume=bool(resume)
    )
    write_centers(found.centers_frame(spark), f"{out}/centers")
    write_key_values(
        clustering.assign(vectors, found.centers), f"{out}/assigned", "cluster", "line"
    )
    return found


def outcome_job(spark: SparkSession, log: str, out: str, refused: str | None = None) -> None:
    """Outcome label of every event."""
    write_lines(playlog.outcome_lines(_play_log(spark, log, refused)), out, "label_line")


def score_job(spark: SparkSession, log: str, out: str, refused: str | None = None) -> None:
    """Match scores by date and home team."""
    scores = playlog.scores_in_order(playlog.match_scores(_play_log(spark, log, refused)))
    write_lines(playlog.match_score_lines(scores), out, "line")


def leaderboard_job(spark: SparkSession, log: str, out: str, places: int = 5, refused: str | None = None) -> None:
    """Player totals under ``totals`` and the best per statistic under ``best``."""
    write_parquet(
        playlog.player_totals(playlog.player_facts(_play_log(spark, log, refused))), f"{out}/totals_table"
    )
    totals = read_table(spark, f"{out}/totals_table")
    write_csv(totals.select("player", "stat", "n"), f"{out}/totals")
    board = playlog.leaderboard(totals, int(places))
    write_lines(playlog.leaderboard_lines(board), f"{out}/best", "line")


def head_to_head_job(spark: SparkSession, log: str, out: str, refused: str | None = None) -> None:
    """Win shares per pairing."""
    shares = playlog.head_to_head(playlog.match_scores(_play_log(spark, log, refused)))
    write_lines(playlog.head_to_head_lines(shares), out, "line")


def prediction_job(
    spark: SparkSession,
    log: str,
    pairs: str,
    out: str,
    tolerance: float = win_model.LOSS_TOLERANCE,
    rating_tolerance: float = win_model.RATING_TOLERANCE,
    refused: str | None = None,
) -> DataFrame:
    """Match and team profiles, then win probabilities for the listed pairs.

    The log is read once, into the table ``matches_table``; text and models start from it.
    """
    write_parquet(playlog.match_features(_play_log(spark, log, refused)), f"{out}/matches_table")
    matches = read_table(spark, f"{out}/matches_table")
    write_lines(playlog.match_profile_lines(matches), f"{out}/matches", "line")
    profiles = settled(playlog.team_profiles(matches))
    write_lines(playlog.team_profile_lines(profiles), f"{out}/teams", "line")
    model = win_model.fit_win_model(matches, tolerance=float(tolerance))
    ratings = win_model.fit_team_ratings(matches, profiles, model, tolerance=float(rating_tolerance))
    scored = win_model.predict_pairs(read_pairs(spark, pairs), profiles, ratings, model)
    write_csv(scored, f"{out}/predictions", header=True)
    return scored


JOBS = {
    "index": text_index_job,
    "join": join_job,
    "kmeans": kmeans_job,
    "outcomes": outcome_job,
    "scores": score_job,
    "leaderboard": leaderboard_job,
    "head-to-head": head_to_head_job,
    "predict": prediction_job,
}


def main() -> None:
    if len(sys.argv) < 2 or sys.argv[1] not in JOBS:
        sys.exit(f"usage: file_jobs {{{'|'.join(JOBS)}}} ARG …")
    from tallyloom.session import build_session

    JOBS[sys.argv[1]](build_session(sys.argv[1]), *sys.argv[2:])


if __name__ == "__main__":
    main()

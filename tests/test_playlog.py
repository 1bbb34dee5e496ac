import pytest
from pyspark.sql import functions as F

from tallyloom.operators import playlog
from tallyloom.plans.registry import plays as derived_plays
from tallyloom.sources import schemas


def log(spark, *events):
    """Events given as dicts; teams default to B at A on one date, played by A."""
    names = [part.split()[0] for part in schemas.PLAY_LOG.split(", ")]
    base = {"game_date": "11-1", "home_team": "A", "away_team": "B", "play_by": "A"}
    rows = [
        tuple({**base, "event_id": i, **event}.get(name) for name in names)
        for i, event in enumerate(events, start=1)
    ]
    return spark.createDataFrame(rows, schemas.PLAY_LOG)


def shot(points, outcome="make", **more):
    return {"shooter": "p1", "shot_type": f"{points}-pt jump shot", "shot_outcome": outcome, **more}


def free(outcome="make", **more):
    return {"free_throw_shooter": "p1", "free_throw_outcome": outcome, **more}


def test_outcome_labels(spark):
    plays = log(spark, shot(2), shot(3, play_by="B"), shot(3, "miss"), free(), free("miss"), {})
    assert [r["points"] for r in playlog.outcome_labels(plays).orderBy("event_id").collect()] == [
        2, 3, None, 1, None, None,
    ]
    lines = [r["label_line"] for r in playlog.outcome_lines(plays).collect()]
    assert lines == ["1,A 得 2 分", "2,B 得 3 分", "3,不得分", "4,A 得 1 分", "5,不得分", "6,不得分"]


def test_match_scores(spark):
    plays = log(spark, shot(2), shot(3, play_by="B"), shot(3, "miss"), free(play_by="B"), free("miss"))
    assert [tuple(r) for r in playlog.match_scores(plays).collect()] == [("11-1", "A", 2, "B", 4)]


def test_shot_and_free_throw_in_one_event_count_once_each(spark):
    plays = log(spark, shot(2, **free()))
    assert playlog.match_scores(plays).first()["home_score"] == 3


def test_matches_without_an_attempt_are_not_listed(spark):
    plays = log(spark, {"rebounder": "p1"}, free("miss"), shot(2, "miss", game_date="11-2"))
    assert [tuple(r) for r in playlog.match_scores(plays).collect()] == [("11-2", "A", 0, "B", 0)]


def test_same_date_and_home_with_two_opponents(spark):
    plays = log(spark, shot(2), shot(3, away_team="C"))
    scores = playlog.scores_in_order(playlog.match_scores(plays)).collect()
    assert [(r["away_team"], r["home_score"]) for r in scores] == [("B", 2), ("C", 3)]


def test_score_lines(spark):
    line = playlog.match_score_lines(playlog.match_scores(log(spark, shot(2))))
    assert line.first()["line"] == "11-1,A,2,B,0"


def test_free_throw_points_go_to_their_shooter(spark):
    totals = playlog.player_totals(playlog.player_facts(log(spark, free(), shot(2))))
    assert [tuple(r) for r in totals.collect()] == [("score", "p1", 3)]
    only_shot_field = log(spark, {"shooter": "p9", "free_throw_outcome": "make"})
    assert playlog.player_facts(only_shot_field).collect() == [("score", "p9", 1)]


def test_one_event_gives_several_facts(spark):
    plays = log(spark, shot(3, assister="p2"), shot(2, "miss", blocker="p3", rebounder="Team"),
                {"turnover_type": "bad pass", "turnover_causer": "p4"})
    assert {tuple(r) for r in playlog.player_facts(plays).collect()} == {
        ("score", "p1", 3), ("assist", "p2", 1), ("block", "p3", 1), ("rebound", "Team", 1), ("steal", "p4", 1),
    }
    without = playlog.player_facts(plays, exclude_team_rows=True).filter("stat = 'rebound'")
    assert without.count() == 0


def totals(spark, *rows):
    return spark.createDataFrame(list(rows), "stat STRING, player STRING, n LONG")


def test_leaderboard_with_a_tie_at_the_last_place(spark):
    given = totals(spark, *[("score", p, n) for p, n in zip("abcdefg", (9, 8, 8, 7, 6, 6, 5))])
    board = playlog.leaderboard(given).orderBy("rank", "player").collect()
    assert [(r["rank"], r["player"], r["n"]) for r in board] == [
        (1, "a", 9), (2, "b", 8), (2, "c", 8), (3, "d", 7), (4, "e", 6),
    ]
    distinct = playlog.leaderboard_distinct(given).orderBy("rank").collect()
    assert [(r["rank"], r["player"], r["n"]) for r in distinct] == [
        (1, "a", 9), (2, "b", 8), (3, "d", 7), (4, "e", 6), (5, "g", 5),
    ]


def test_leaderboard_with_fewer_players_than_places(spark):
    board = playlog.leaderboard(totals(spark, ("block", "x", 1), ("score", "y", 2)))
    assert {tuple(r) for r in board.collect()} == {("block", 1, "x", 1), ("score", 1, "y", 2)}
    lines = [r["line"] for r in playlog.leaderboard_lines(board).collect()]
    assert lines == ["得分,1,y,2", "盖帽,1,x,1"]


def scores(spark, *pairs):
    rows = [(f"d{i}", "A", h, "B", a) for i, (h, a) in enumerate(pairs)]
    return spark.createDataFrame(rows, "game_date STRING, home_team STRING, home_score LONG, away_team STRING, away_score LONG")


def test_win_share_is_a_fraction_and_a_draw_is_no_win(spark):
    shares = playlog.head_to_head(scores(spark, (1, 2), (5, 5), (9, 3)))
    row = shares.first()
    assert (row["matches"], row["away_wins"]) == (3, 1)
    assert row["p_away"] == pytest.approx(1 / 3) and row["p_away"] + row["p_home"] == 1.0
    assert playlog.head_to_head_lines(shares).first()["line"] == "B,0.3333,A,0.6667"


def test_match_features(spark):
    plays = log(
        spark,
        shot(2, assister="p2"), shot(2, "miss", blocker="p3"), shot(3),
        {"foul_type": "offensive"}, {"foul_type": "loose ball"}, {"foul_type": "offensive charge"},
        free(play_by="B"), free("miss", play_by="B"),
        {"turnover_type": "bad pass", "play_by": "B"}, {"enter_game": "p5"},
    )
    row = playlog.match_features(plays).first()
    home = [row["home_score"]] + [row[f"home_r{i}"] for i in range(9)]
    away = [row["away_score"]] + [row[f"away_r{i}"] for i in range(9)]
    assert home == [5, 0.5, 1.0, 1.0, 0.0, 2.0, 0.0, 1.0, 0.0, 1.0]
    assert away == [1, 0.0, 0.0, 0.0, 1.0, 1.0, 0.5, 0.0, 1.0, 0.0]


def test_match_without_any_fact_has_no_features(spark):
    assert playlog.match_features(log(spark, {"violation_type": "lane"})).count() == 0


def test_team_profile_is_a_mean_over_home_and_away(spark):
    plays = log(spark, {"assister": "x"}, {"assister": "x"},
                {"assister": "x", "game_date": "11-2", "home_team": "C", "away_team": "A"})
    profiles = {r["team"]: r["r2"] for r in playlog.team_profiles(playlog.match_features(plays)).collect()}
    assert profiles == {"A": 1.5, "B": 0.0, "C": 0.0}


def test_player_points_sum_to_match_points(spark, tables):
    plays = derived_plays(spark, tables)
    by_player = playlog.player_facts(plays).filter("stat = 'score'").agg(F.sum("n")).first()[0]
    by_match = playlog.match_scores(plays).agg(F.sum(F.col("home_score") + F.col("away_score"))).first()[0]
    assert by_player == by_match > 0


def test_both_ways_to_the_match_score_agree(spark, tables):
    plays = derived_plays(spark, tables)
    keys = ["game_date", "home_team", "away_team"]
    both = playlog.match_scores(plays).alias("s").join(playlog.match_features(plays).alias("f"), keys)
    assert both.filter("s.home_score <> f.home_score OR s.away_score <> f.away_score").count() == 0


def test_a_null_field_leaves_its_place(spark):
    scores = spark.createDataFrame([("11-1", None, 3, "B", 2)], "game_date STRING, home_team STRING, home_score BIGINT, away_team STRING, away_score BIGINT")
    assert playlog.match_score_lines(scores).first()["line"] == "11-1,,3,B,2"


def test_profile_lines_are_parsed_where_they_are(spark):
    good = "a:b:3," + ",".join(f"0.{i}" for i in range(9)) + ";c:4," + ",".join(f"1.{i}" for i in range(9))
    lines = [(1, good, "x"), (2, "a:3,oops;", None), (3, None, None), (4, "", None), (5, "no colon;b:x", None)]
    frame = spark.createDataFrame(lines, "id INT, line STRING, away_team STRING")
    parsed = playlog.parse_match_profiles(frame)
    assert parsed.columns == [
        f"{s}_{c}" for s in ("away", "home") for c in ("team", "score", *playlog.PROFILE)
    ]
    rows = [tuple(r) for r in parsed.collect()]
    assert len(rows) == len(lines)
    whole = ("a:b", 3, *[i / 10 for i in range(9)], "c", 4, *[1 + i / 10 for i in range(9)])
    assert whole in rows
    assert ("a", 3, *[None] * 20) in rows and rows.count((None,) * 22) == 2
    assert (None,) * 11 + ("b",) + (None,) * 10 in rows
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        playlog.parse_match_profiles(frame, strict=True).collect()


def test_profiles_from_lines_equal_those_from_columns(spark, tables):
    from tallyloom.plans import registry

    matches = registry.match_features(spark, tables)
    again = playlog.parse_match_profiles(playlog.match_profile_lines(matches))
    plan = again._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange ") <= matches._jdf.queryExecution().executedPlan().toString().count("Exchange ")
    assert sorted(again.collect()) == sorted(matches.select(*again.columns).collect())

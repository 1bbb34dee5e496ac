"""A play log derived from the ``events`` table, row by row.

Only integer arithmetic and conditions are used, so that any SQL engine derives
the same log. Teams come from the day and the event number, players from users.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def plays_from_events(events: DataFrame) -> DataFrame:
    """One play per event, with the columns the reports need."""
    event, user, kind = F.col("event_id"), F.col("user_id"), F.col("event_type")
    day, group = F.day("ts"), event % 5
    home_no = (day * 3 + group * 2) % 10
    away_no = (home_no + 1 + ((day + group) % 3) * 2) % 10

    def player(number: Column) -> Column:
        return F.concat(F.lit("p"), number.cast("string"))

    actor = player(user)
    shot = kind.isin("click", "purchase")
    made = F.col("value") >= 40
    home = F.concat(F.lit("team"), home_no.cast("string"))
    away = F.concat(F.lit("team"), away_no.cast("string"))
    turnover = kind == "error"
    return events.select(
        event.alias("event_id"),
        F.to_date("ts").alias("game_date"),
        home.alias("home_team"),
        away.alias("away_team"),
        F.when(user % 2 == 0, home).otherwise(away).alias("play_by"),
        F.when(shot, actor).alias("shooter"),
        F.when(kind == "click", "2-pt jump shot")
        .when(kind == "purchase", "3-pt jump shot")
        .alias("shot_type"),
        F.when(shot & made, "make").when(shot, "miss").alias("shot_outcome"),
        F.when(shot & made & (event % 3 == 0), player((user + 2) % 150)).alias("assister"),
        F.when(shot & ~made & (event % 4 == 0), player((user + 1) % 150)).alias("blocker"),
        F.when(
            (kind == "signup") & (event % 3 == 1),
            F.when(event % 2 == 0, "offensive").otherwise("shooting"),
        ).alias("foul_type"),
        F.when((kind == "signup") & (event % 3 == 0), actor).alias("rebounder"),
        F.when(kind == "view", actor).alias("free_throw_shooter"),
        F.when((kind == "view") & (F.col("value") >= 20), "make")
        .when(kind == "view", "miss")
        .alias("free_throw_outcome"),
        F.when((kind == "signup") & (event % 3 == 2), actor).alias("enter_game"),
        F.when(turnover, "bad pass").alias("turnover_type"),
        F.when(turnover & (event % 2 == 0), player((user + 1) % 150)).alias("turnover_causer"),
    )

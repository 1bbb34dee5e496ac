"""Reports over a basketball play log.

Every report reads the log once. An event adds a bounded number of facts, and
all totals start before the shuffle, so a player, team or match holding a large
share of all events costs no single task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyloom.functions import first_char, fixed_text, half_up_ratio, hit_rate

MATCH = ("game_date", "home_team", "away_team")
PROFILE = tuple(f"r{i}" for i in range(9))

# Display names of the player statistics.
STAT_NAMES = {
    "score": "得分",
    "rebound": "篮板",
    "assist": "助攻",
    "steal": "抢断",
    "block": "盖帽",
}

# Wording of the outcome labels, "event,team 得 n 分" or "event,不得分".
SCORES, POINTS, NO_SCORE = " 得 ", " 分", "不得分"

# Fouls charged to the acting team; any other goes to its opponent.
OWN_FOULS = ("offensive", "loose ball")

# Fixed value: this rebounder is a team, not a player.
TEAM_REBOUNDER = "Team"


def _joined(mark: str, *fields: Column | str) -> Column:
    """Fields as text with a mark between them; a null is an empty field, so none moves up."""
    texts = [F.coalesce((F.col(f) if isinstance(f, str) else f).cast("string"), F.lit("")) for f in fields]
    return F.concat_ws(mark, *texts)


def _free_throw_made() -> Column:
    return F.coalesce(F.col("free_throw_outcome") == "make", F.lit(False))


def _shot_made() -> Column:
    return F.coalesce(F.col("shot_outcome") == "make", F.lit(False))


def _home_acts() -> Column:
    """The acting team is the home team."""
    return F.coalesce(F.col("play_by") == F.col("home_team"), F.lit(False))


def _home_opposes() -> Column:
    """The opponent of the acting team is the home team."""
    return F.coalesce(F.col("play_by") == F.col("away_team"), F.lit(False))


def outcome_labels(plays: DataFrame) -> DataFrame:
    """Points scored per event: ``event_id, play_by, points`` (null: no score)."""
    points = (
        F.when(_free_throw_made(), F.lit("1"))
        .when(_shot_made(), first_char(F.col("shot_type")))
        .cast("int")
    )
    return plays.select("event_id", "play_by", points.alias("points"))


def outcome_lines(plays: DataFrame) -> DataFrame:
    """Outcome labels as text in text order: ``event_id, label_line``."""
    scored = F.concat(
        F.coalesce("play_by", F.lit("")),
        F.lit(SCORES),
        F.col("points").cast("string"),
        F.lit(POINTS),
    )
    label = F.when(F.col("points").isNull(), F.lit(NO_SCORE)).otherwise(scored)
    line = F.concat(F.col("event_id").cast("string"), F.lit(","), label)
    return outcome_labels(plays).select("event_id", line.alias("label_line")).orderBy("label_line")


def match_scores(plays: DataFrame) -> DataFrame:
    """Points per side and match: ``game_date, home_team, home_score, away_team, away_score``.

    Lists the matches with at least one shot or made free throw. A shot that is
    not marked as missed counts, and an event with a shot and a made free throw
    counts both once.
    """
    shot_points = (
        F.when(F.col("shot_type").isNull(), 0)
        .when(F.col("shot_outcome") == "miss", 0)
        .when(first_char(F.col("shot_type")) == "2", 2)
        .otherwise(3)
    )
    points = shot_points + F.when(_free_throw_made(), 1).otherwise(0)
    home = _home_acts()
    return (
        plays.filter(F.col("shot_type").isNotNull() | (F.col("free_throw_outcome") == "make"))
        .groupBy(*MATCH)
        .agg(
            F.sum(F.when(home, points).otherwise(0)).alias("home_score"),
            F.sum(F.when(home, 0).otherwise(points)).alias("away_score"),
        )
        .select("game_date", "home_team", "home_score", "away_team", "away_score")
    )


def scores_in_order(scores: DataFrame) -> DataFrame:
    """Match scores by date and home team (then away team, to settle repeats)."""
    return scores.orderBy("game_date", "home_team", "away_team")


def match_score_lines(scores: DataFrame) -> DataFrame:
    """Match scores as ``date,home,home score,away,away score`` text: ``line``."""
    return scores.select(
        _joined(",", "game_date", "home_team", "home_score", "away_team", "away_score").alias("line")
    )


def player_facts(plays: DataFrame, exclude_team_rows: bool = False) -> DataFrame:
    """Facts about players: ``stat, player, n``; one event may give several.

    A made free throw belongs to its shooter; only without one does the event's
    shot count.
    """
    scorer = F.when(
        _free_throw_made(), F.coalesce("free_throw_shooter", "shooter")
    ).when(_shot_made(), F.col("shooter"))
    points = F.when(_free_throw_made(), F.lit("1")).when(
        _shot_made(), first_char(F.col("shot_type"))
    )
    rebounder = F.col("rebounder")
    if exclude_team_rows:
        rebounder = F.when(rebounder != TEAM_REBOUNDER, rebounder)

    def fact(stat: str, player: Column, n: Column) -> Column:
        return F.struct(F.lit(stat).alias("stat"), player.alias("player"), n.cast("long").alias("n"))

    facts = F.array(
        fact("score", scorer, points),
        fact("rebound", rebounder, F.lit(1)),
        fact("assist", F.col("assister"), F.lit(1)),
        fact("steal", F.col("turnover_causer"), F.lit(1)),
        fact("block", F.col("blocker"), F.lit(1)),
    )
    return plays.select(F.inline(facts)).filter(F.col("player").isNotNull())


def player_totals(facts: DataFrame) -> DataFrame:
    """Totals: ``stat, player, n``."""
    return facts.groupBy("stat", "player").agg(F.sum("n").alias("n"))


def leaderboard(totals: DataFrame, places: int = 5) -> DataFrame:
    """Best players per statistic: ``stat, rank, player, n``.

    Takes the first ``places`` rows by total and name, then ranks them densely,
    so tied players share a rank. Filtering on the row number first lets each
    task drop all but its best rows before the shuffle.
    """
    best_first = Window.partitionBy("stat").orderBy(F.col("n").desc(), F.col("player"))
    by_total = Window.partitionBy("stat").orderBy(F.col("n").desc())
    return (
        totals.withColumn("place", F.row_number().over(best_first))
        .filter(F.col("place") <= places)
        .withColumn("rank", F.dense_rank().over(by_total))
        .select("stat", "rank", "player", "n")
    )


def leaderboard_distinct(totals: DataFrame, places: int = 5) -> DataFrame:
    """Best distinct totals per statistic, one player (first by name) for each."""
    one_each = totals.groupBy("stat", "n").agg(F.min("player").alias("player"))
    return leaderboard(one_each, places)


def leaderboard_lines(board: DataFrame) -> DataFrame:
    """Leaderboard as ``stat,rank,player,total`` text in rank order: ``line``."""
    shown = F.create_map(*[F.lit(x) for pair in STAT_NAMES.items() for x in pair])
    return (
        board.withColumn("shown", shown[F.col("stat")])
        .orderBy("shown", "rank", "player")
        .select(_joined(",", "shown", "rank", "player", "n").alias("line"))
    )


def away_win() -> Column:
    """The away team won; a draw is not a win."""
    return F.col("away_score") > F.col("home_score")


def head_to_head(scores: DataFrame) -> DataFrame:
    """Share of matches won per pairing: ``away_team, home_team, matches, away_wins, p_away, p_home``."""
    return (
        scores.groupBy("away_team", "home_team")
        .agg(F.count(F.lit(1)).alias("matches"), F.count_if(away_win()).alias("away_wins"))
        .withColumn("p_away", F.col("away_wins") / F.col("matches"))
        .withColumn("p_home", F.lit(1.0) - F.col("p_away"))
    )


def head_to_head_lines(shares: DataFrame) -> DataFrame:
    """Win shares as ``away,share,home,share`` text, four decimals: ``line``."""
    away = half_up_ratio(F.col("away_wins"), F.col("matches"), 4)
    home = half_up_ratio(F.col("matches") - F.col("away_wins"), F.col("matches"), 4)
    return shares.select(
        _joined(",", "away_team", fixed_text(away, 4), "home_team", fixed_text(home, 4)).alias("line")
    )


def match_features(plays: DataFrame) -> DataFrame:
    """Both teams' profile per match: score and ``r0 … r8`` with ``away_`` and ``home_`` prefix.

    Lists the matches with at least one fact. All sums are conditional on the
    side, so the log is grouped once and no event is multiplied.
    """
    shot = F.col("shooter").isNotNull()
    two = F.coalesce(first_char(F.col("shot_type")) == "2", F.lit(False))
    three = ~two
    made = _shot_made()
    free_throw = F.coalesce(F.col("free_throw_outcome").isin("make", "miss"), F.lit(False))
    foul = F.col("foul_type").isNotNull()
    own_foul = F.coalesce(F.col("foul_type").isin(*OWN_FOULS), F.lit(False))
    assist = F.col("assister").isNotNull()
    block = F.col("blocker").isNotNull()
    turnover = F.col("turnover_type").isNotNull()
    entry = F.col("enter_game").isNotNull()
    points = F.when(shot & made, first_char(F.col("shot_type")).cast("int")).otherwise(0) + F.when(
        _free_throw_made(), 1
    ).otherwise(0)

    def side(name: str, acts: Column, opposes: Column) -> list[Column]:
        return [
            F.sum(F.when(acts, points).otherwise(0)).alias(f"{name}_score"),
            F.count_if(acts & shot & two & made).alias(f"{name}_two_made"),
            F.count_if(acts & shot & two).alias(f"{name}_two"),
            F.count_if(acts & shot & three & made).alias(f"{name}_three_made"),
            F.count_if(acts & shot & three).alias(f"{name}_three"),
            F.count_if(acts & assist).alias(f"{name}_assist"),
            F.count_if(opposes & block).alias(f"{name}_block"),
            F.count_if(foul & ((own_foul & acts) | (~own_foul & opposes))).alias(f"{name}_foul"),
            F.count_if(acts & free_throw & _free_throw_made()).alias(f"{name}_free_made"),
            F.count_if(acts & free_throw).alias(f"{name}_free"),
            F.count_if(opposes & turnover).alias(f"{name}_forced"),
            F.count_if(acts & turnover).alias(f"{name}_committed"),
            F.count_if(acts & entry).alias(f"{name}_entry"),
        ]

    def profile(name: str) -> list[Column]:
        def total(key: str) -> Column:
            return F.col(f"{name}_{key}")

        values = (
            hit_rate(total("two_made"), total("two")),
            hit_rate(total("three_made"), total("three")),
            total("assist"),
            total("block"),
            total("foul"),
            hit_rate(total("free_made"), total("free")),
            total("forced"),
            total("committed"),
            total("entry"),
        )
        return [total("score")] + [
            v.cast("double").alias(f"{name}_{r}") for v, r in zip(values, PROFILE)
        ]

    home_acts, home_opposes = _home_acts(), _home_opposes()
    return (
        plays.filter(shot | assist | block | foul | free_throw | turnover | entry)
        .groupBy(*MATCH)
        .agg(*side("away", ~home_acts, ~home_opposes), *side("home", home_acts, home_opposes))
        .select(*MATCH, *profile("away"), *profile("home"))
    )


def team_rows(matches: DataFrame) -> DataFrame:
    """Two rows per match, one for each team: ``team, r0 … r8``."""

    def row(name: str) -> Column:
        return F.struct(
            F.col(f"{name}_team").alias("team"), *[F.col(f"{name}_{r}").alias(r) for r in PROFILE]
        )

    return matches.select(F.inline(F.array(row("away"), row("home"))))


def team_profiles(matches: DataFrame) -> DataFrame:
    """Mean profile of a team over all its matches: ``team, r0 … r8``."""
    return team_rows(matches).groupBy("team").agg(*[F.avg(r).alias(r) for r in PROFILE])


def match_profile_lines(matches: DataFrame) -> DataFrame:
    """Match profiles as ``away:score,r0,…;home:score,r0,…`` text: ``line``."""

    def half(name: str) -> Column:
        numbers = _joined(",", f"{name}_score", *[f"{name}_{r}" for r in PROFILE])
        return _joined(":", F.col(f"{name}_team"), numbers)

    return matches.select(_joined(";", half("away"), half("home")).alias("line"))


def team_profile_lines(profiles: DataFrame) -> DataFrame:
    """Team profiles as ``team,r0,…,r8`` text: ``line``."""
    return profiles.select(_joined(",", "team", *PROFILE).alias("line"))


def parse_match_profiles(lines: DataFrame, line: str = "line", strict: bool = False) -> DataFrame:
    """Lines ``away:score,r0,…,r8;home:score,r0,…,r8`` as the columns of ``match_features`` but those of the match.

    Works on lines from anywhere: a file, a table, or the step before. A name may hold any character but ``;``, since
    the last colon of a half ends it. A half, a field or a number that is missing or cannot be read is null, so a bad line keeps its row;
    with ``strict``, a number that cannot be read ends the job.
    """
    halves = F.split(line, ";")

    def half(name: str, k: int) -> list[Column]:
        text = F.get(halves, F.lit(k))
        numbers = F.split(F.substring_index(text, ":", -1), ",")
        team = F.when(text.contains(":"), F.regexp_extract(text, "(?s)^(.*):", 1))

        def number(i: int, kind: str) -> Column:
            value = F.get(numbers, F.lit(i))
            return F.when(text.contains(":"), value.cast(kind) if strict else value.try_cast(kind))

        return [
            team.alias(f"{name}_team"),
            number(0, "long").alias(f"{name}_score"),
            *[number(i, "double").alias(f"{name}_{r}") for i, r in enumerate(PROFILE, start=1)],
        ]

    return lines.select(*half("away", 0), *half("home", 1))

"""Win models fitted in batch rounds: a bilinear logistic model, then team ratings.

Each round uses all matches at once, so results do not depend on row order.
Features are standardised, and a step is the mean gradient times a step size,
so neither depends on the number of matches.

``fit_win_model_newton`` finds the optimum of the model with a small ridge in a few passes, by curvature.
``ratings_in_order`` is the other way to rate teams: one pass over the dates, each against the ratings before it.
"""

from __future__ import annotations

from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyloom.functions import bilinear, dot, logistic
from tallyloom.operators.lineage import discard, stored
from tallyloom.operators.partials import matrix, slot_sums
from tallyloom.operators.playlog import PROFILE, away_win, team_rows

SIZE = len(PROFILE)
WEIGHTS = SIZE + SIZE + SIZE * SIZE

# A fit ends when a round changes the mean loss, or any rating, by less than this.
LOSS_TOLERANCE = 1e-3
RATING_TOLERANCE = 2e-2

# Newton's method ends when the gradient's norm is below this; weight of the penalty on half the squared weights.
GRADIENT_TOLERANCE, WEIGHT_RIDGE = 1e-6, 1e-3

# What a match moves the ratings of its teams by, per unit of residual, where dates are taken in order.
ORDER_RATE = 0.1

# Up to so many teams, ratings go from round to round as rows in the plan (under a megabyte); beyond, as a stored table.
LOCAL_TEAMS = 10_000

# Number of rotation pairs in a team's rating.
ROTATIONS = 2
ROTATION_COLUMNS = tuple(f"rot{i}" for i in range(2 * ROTATIONS))
RATING_COLUMNS = ("r_away", "r_home", *ROTATION_COLUMNS)


@dataclass
class WinModel:
    """Weights of the away profile, the home profile and their products.

    The size is fixed by the nine features; nothing in here grows with the data.
    """

    mean: np.ndarray
    scale: np.ndarray
    weights: np.ndarray = field(default_factory=lambda: np.zeros(WEIGHTS))
    losses: list[float] = field(default_factory=list)
    gradients: list[float] = field(default_factory=list)
    converged: bool = False

    @property
    def last_change(self) -> float:
        """Change of the mean loss in the last round."""
        return abs(self.losses[-1] - self.losses[-2]) if len(self.losses) > 1 else float("inf")

    @property
    def w_away(self) -> np.ndarray:
        return self.weights[:SIZE]

    @property
    def w_home(self) -> np.ndarray:
        return self.weights[SIZE : 2 * SIZE]

    @property
    def w_cross(self) -> np.ndarray:
        return self.weights[2 * SIZE :].reshape(SIZE, SIZE)

    def rows(self) -> list[tuple[str, int, int, float]]:
        """Weights as ``(part, i, j, weight)``; ``j`` is -1 outside the products."""
        return (
            [("away", i, -1, float(w)) for i, w in enumerate(self.w_away)]
            + [("home", i, -1, float(w)) for i, w in enumerate(self.w_home)]
            + [
                ("cross", i, j, float(self.w_cross[i, j]))
                for i in range(SIZE)
                for j in range(SIZE)
            ]
        )

    def standardised(self, prefix: str) -> Column:
        """Profile columns with this prefix as one standardised array."""
        return F.array(
            *[
                (F.col(prefix + r) - F.lit(float(m))) / F.lit(float(s))
                for r, m, s in zip(PROFILE, self.mean, self.scale)
            ]
        )

    def logit(self, away: Column, home: Column) -> Column:
        """Log odds of an away win from two standardised arrays."""

        def fixed(values: np.ndarray) -> Column:
            return F.array(*[F.lit(float(v)) for v in values])

        return dot(fixed(self.w_away), away) - dot(fixed(self.w_home), home) + bilinear(
            away, self.w_cross, home
        )


def feature_scale(matches: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """Mean and population deviation of each feature over all team rows (1 if constant)."""
    found = team_rows(matches).agg(
        *[F.avg(r).alias(f"m_{r}") for r in PROFILE],
        *[F.stddev_pop(r).alias(f"s_{r}") for r in PROFILE],
    ).first()
    mean = np.array([found[f"m_{r}"] or 0.0 for r in PROFILE])
    scale = np.array([found[f"s_{r}"] or 1.0 for r in PROFILE])
    return mean, scale


def fit_win_model(
    matches: DataFrame,
    step: float = 0.5,
    tolerance: float = LOSS_TOLERANCE,
    max_rounds: int | None = None,
) -> WinModel:
    """Fit the bilinear model by full-batch gradient rounds from zero weights.

    Rounds go on until the mean loss, taken before each round, changes by less than ``tolerance``; a caller
    who passes ``max_rounds`` learns from ``converged`` whether it did.

    ``matches`` is read once per round; pass a settled frame (see
    ``lineage.settled``) or a table, not a plan over the whole play log.
    """
    model = WinModel(*feature_scale(matches))
    prepared = _prepared(matches)
    while max_rounds is None or len(model.losses) < max_rounds:
        loss, gradient = _win_gradient(prepared, model)
        if not np.isfinite(loss):
            raise ValueError("the loss is not finite")
        model.losses.append(loss)
        model.weights = model.weights + step * gradient
        if model.last_change < tolerance:
            model.converged = True
            break
    return model


def _prepared(matches: DataFrame) -> DataFrame:
    """Outcome and both profiles of every match."""
    return matches.select(
        F.when(away_win(), 1.0).otherwise(0.0).alias("won"),
        F.array(*[f"away_{r}" for r in PROFILE]).alias("away"),
        F.array(*[f"home_{r}" for r in PROFILE]).alias("home"),
    )


def _win_gradient(prepared: DataFrame, model: WinModel) -> tuple[float, np.ndarray]:
    """Mean loss and mean gradient of the log likelihood at the current weights."""
    mean, scale, weights = model.mean, model.scale, model.weights

    def add(batch: pa.RecordBatch, counts: np.ndarray, sums: np.ndarray) -> None:
        won = batch.column(0).to_numpy(zero_copy_only=False)
        away = (matrix(batch.column(1), SIZE) - mean) / scale
        home = (matrix(batch.column(2), SIZE) - mean) / scale
        cross = (away[:, :, None] * home[:, None, :]).reshape(len(won), SIZE * SIZE)
        inputs = np.hstack([away, -home, cross])
        logit = inputs @ weights
        residual = won - 1.0 / (1.0 + np.exp(-logit))
        counts[0] += len(won)
        sums[0, :WEIGHTS] += residual @ inputs
        sums[0, WEIGHTS] += np.sum(np.logaddexp(0.0, logit) - won * logit)

    merged = slot_sums(prepared, add, 1, WEIGHTS + 1)
    if not merged:
        return 0.0, np.zeros(WEIGHTS)
    _, total = merged[0]
    return float(total[WEIGHTS]), total[:WEIGHTS]


def fit_win_model_newton(
    matches: DataFrame,
    ridge: float = WEIGHT_RIDGE,
    tolerance: float = GRADIENT_TOLERANCE,
    max_rounds: int | None = None,
) -> WinModel:
    """Fit the bilinear model with a ridge by Newton steps from zero weights.

    The penalised mean loss is ``loss + ridge / 2 * |weights|**2``. A pass over the matches gives loss, gradient and
    curvature (99 x 99 numbers); the driver solves for the step. A step that does not lower the penalised loss
    is halved, which costs a pass. The fit ends when the gradient's norm is below ``tolerance``; a caller who passes ``max_rounds`` (passes
    over the matches) learns from ``converged`` whether it is.

    ``matches`` is read once per pass; pass a table or a settled frame (see ``lineage``), not a plan over the whole play log.
    """
    model = WinModel(*feature_scale(matches))
    prepared = _prepared(matches)
    best, step = np.inf, np.zeros(WEIGHTS)
    while max_rounds is None or len(model.losses) < max_rounds:
        loss, gradient, curvature = _win_curvature(prepared, model)
        penalised = loss + ridge / 2 * float(model.weights @ model.weights)
        if not np.isfinite(penalised):
            raise ValueError("the loss is not finite")
        model.losses.append(loss)
        if penalised > best + 1e-12:
            step = step / 2
            model.weights = model.weights - step
            model.gradients.append(np.inf)
            continue
        best = penalised
        gradient = gradient - ridge * model.weights
        model.gradients.append(float(np.linalg.norm(gradient)))
        if model.gradients[-1] < tolerance:
            model.converged = True
            break
        step = np.linalg.solve(curvature + ridge * np.eye(WEIGHTS), gradient)
        model.weights = model.weights + step
    return model


def _win_curvature(prepared: DataFrame, model: WinModel) -> tuple[float, np.ndarray, np.ndarray]:
    """Mean loss, mean gradient of the log likelihood and mean curvature of the loss at the current weights."""
    mean, scale, weights = model.mean, model.scale, model.weights
    upper = np.triu_indices(WEIGHTS)

    def add(batch: pa.RecordBatch, counts: np.ndarray, sums: np.ndarray) -> None:
        won = batch.column(0).to_numpy(zero_copy_only=False)
        away = (matrix(batch.column(1), SIZE) - mean) / scale
        home = (matrix(batch.column(2), SIZE) - mean) / scale
        cross = (away[:, :, None] * home[:, None, :]).reshape(len(won), SIZE * SIZE)
        inputs = np.hstack([away, -home, cross])
        logit = inputs @ weights
        p = 1.0 / (1.0 + np.exp(-logit))
        counts[0] += len(won)
        sums[0, :WEIGHTS] += (won - p) @ inputs
        sums[0, WEIGHTS] += np.sum(np.logaddexp(0.0, logit) - won * logit)
        sums[0, WEIGHTS + 1 :] += ((inputs * (p * (1 - p))[:, None]).T @ inputs)[upper]

    merged = slot_sums(prepared, add, 1, WEIGHTS + 1 + len(upper[0]))
    curvature = np.zeros((WEIGHTS, WEIGHTS))
    if not merged:
        return 0.0, np.zeros(WEIGHTS), curvature
    _, total = merged[0]
    curvature[upper] = total[WEIGHTS + 1 :]
    curvature = curvature + curvature.T - np.diag(np.diag(curvature))
    return float(total[WEIGHTS]), total[:WEIGHTS], curvature


@dataclass
class TeamRatings:
    """Ratings per team (``team, matches, r_away, r_home, rot0 …``) and the weight of the model's logit."""

    teams: DataFrame
    ratio: float
    changes: list[float] = field(default_factory=list)
    converged: bool = False


def pair_results(matches: DataFrame) -> DataFrame:
    """Matches and away wins per pairing.

    In a batch round all matches of a pairing have the same prediction, so this
    small table stands for the full list of matches without loss.
    """
    return matches.groupBy("away_team", "home_team").agg(
        F.count(F.lit(1)).alias("n"), F.count_if(away_win()).alias("wins")
    )


def pair_kernel(pairs: DataFrame, profiles: DataFrame, model: WinModel) -> DataFrame:
    """Pairs with ``kernel``, the model's logit on both team profiles (null for an unknown team)."""
    away = profiles.select(
        F.col("team").alias("away_team"), model.standardised("").alias("away_profile")
    )
    home = profiles.select(
        F.col("team").alias("home_team"), model.standardised("").alias("home_profile")
    )
    return (
        pairs.join(away, "away_team", "left")
        .join(home, "home_team", "left")
        .withColumn("kernel", model.logit(F.col("away_profile"), F.col("home_profile")))
        .drop("away_profile", "home_profile")
    )


def _rated_pairs(pairs: DataFrame, ratings: DataFrame, more: tuple[str, ...] = ()) -> DataFrame:
    """Pairs with the ratings of both teams, and more columns if asked for, under ``a_`` and ``h_``."""
    columns = ("matches", *RATING_COLUMNS, *more)
    away = ratings.select(
        F.col("team").alias("away_team"), *[F.col(c).alias(f"a_{c}") for c in columns]
    )
    home = ratings.select(
        F.col("team").alias("home_team"), *[F.col(c).alias(f"h_{c}") for c in columns]
    )
    return pairs.join(away, "away_team", "left").join(home, "home_team", "left")


def _rating_logit(ratio: Column) -> Column:
    total = F.col("kernel") * ratio + F.col("a_r_away") - F.col("h_r_home")
    for i in range(0, len(ROTATION_COLUMNS), 2):
        total = (
            total
            + F.col(f"a_rot{i}") * F.col(f"h_rot{i + 1}")
            - F.col(f"a_rot{i + 1}") * F.col(f"h_rot{i}")
        )
    return total


def _rating_round(
    pairs: DataFrame, ratings: DataFrame, step: float, shares: tuple[Column, Column]
) -> DataFrame:
    """Ratings after one round, with the change of ``ratio`` in the row without a team.

    The ratio before the round comes as a column of the ratings, so that all rounds run the same code.
    A residual counts by the given shares for the away team and for the home team.
    """
    scored = _rated_pairs(pairs, ratings, ("ratio",)).withColumn(
        "residual", F.col("wins") - F.col("n") * logistic(_rating_logit(F.col("a_ratio")))
    )
    away_share = F.lit(step) * F.col("residual") * shares[0]
    home_share = F.lit(step) * F.col("residual") * shares[1]
    zero = F.lit(0.0)

    def change(team: Column, r_away: Column, r_home: Column, rotations: list[Column]) -> Column:
        values = (r_away, r_home, *rotations)
        return F.struct(
            team.cast("string").alias("team"),
            F.lit(0).cast("long").alias("matches"),
            *[v.alias(c) for v, c in zip(values, RATING_COLUMNS)],
        )

    away_rotations, home_rotations = [], []
    for i in range(0, len(ROTATION_COLUMNS), 2):
        away_rotations += [away_share * F.col(f"h_rot{i + 1}"), -away_share * F.col(f"h_rot{i}")]
        home_rotations += [-home_share * F.col(f"a_rot{i + 1}"), home_share * F.col(f"a_rot{i}")]
    changes = scored.select(
        F.inline(
            F.array(
                change(F.col("away_team"), away_share, zero, away_rotations),
                change(F.col("home_team"), zero, -home_share, home_rotations),
                change(
                    F.lit(None),
                    F.lit(step) * F.col("residual") * F.col("kernel"),
                    zero,
                    [zero] * len(ROTATION_COLUMNS),
                ),
            )
        )
    )
    # What a round adds is summed beside the ratings, so its size is read without a join.
    before = ratings.filter(F.col("team").isNotNull()).select(
        "team", "matches", *RATING_COLUMNS, *[zero.alias(f"d_{c}") for c in RATING_COLUMNS]
    )
    added = changes.select("*", *[F.col(c).alias(f"d_{c}") for c in RATING_COLUMNS])
    summed = (*RATING_COLUMNS, *[f"d_{c}" for c in RATING_COLUMNS])
    return (
        before.unionByName(added)
        .groupBy("team")
        .agg(F.sum("matches").alias("matches"), *[F.sum(c).alias(c) for c in summed])
    )


def level_ratings(matches: DataFrame) -> DataFrame:
    """All teams with the number of their matches and the ratings they start from."""
    teams = team_rows(matches).groupBy("team").agg(F.count(F.lit(1)).alias("matches"))
    return teams.select(
        "team", "matches", *[F.lit(1.0 if c in ROTATION_COLUMNS else 0.0).alias(c) for c in RATING_COLUMNS]
    )


class _Rounds:
    """Ratings that go from round to round, with a plan that does not grow.

    A checkpoint would cut the history, but keep the size estimated for the plan it came from, and two joins a round square
    that estimate. Few teams (the number is counted) become rows in the plan, others a table that replaces the
    one before; both have the size they have, and a round's joins are planned by it.
    """

    def __init__(self, ratings: DataFrame, total: int | None, local_teams: int) -> None:
        """``total`` is the number of matches over which the ratio moves; without it the ratio stays one."""
        self.total, self.ratio = total, 1.0
        self.table = stored(ratings)
        self.local = self.table.count() <= local_teams
        if self.local:
            self._keep(self.table.toArrow(), self.table)
        else:
            self.frame = self.table.withColumn("ratio", F.lit(self.ratio))

    def _keep(self, rows: pa.Table, like: DataFrame) -> None:
        rows = rows.append_column("ratio", pa.array(np.full(len(rows), self.ratio)))
        self.frame = like.sparkSession.createDataFrame(rows, like.withColumn("ratio", F.lit(1.0)).schema)

    def advance(self, after: DataFrame) -> float:
        """Take the ratings after a round; the largest change of a team's rating."""
        if self.local:
            rows = after.toArrow()
            alone = np.array([t is None for t in rows["team"].to_pylist()], bool)
            moves = np.abs(np.column_stack([rows[f"d_{c}"].to_numpy() for c in RATING_COLUMNS]))
            largest, change = moves[~alone].max(initial=0.0), rows["r_away"].to_numpy()[alone].sum()
        else:
            before, self.table = self.table, stored(after)
            discard(before)
            largest, change = _changes(self.table)
        if self.total is not None:
            self.ratio += float(change) / max(self.total, 1)
        if self.local:
            self._keep(rows, after)
        else:
            self.frame = self.table.withColumn("ratio", F.lit(self.ratio))
        if not np.isfinite(largest):
            raise ValueError("a rating is not finite")
        return float(largest)

    def teams(self) -> DataFrame:
        return self.frame.filter(F.col("team").isNotNull()).select("team", "matches", *RATING_COLUMNS)


def fit_team_ratings(
    matches: DataFrame,
    profiles: DataFrame,
    model: WinModel,
    step: float = 1.0,
    tolerance: float = RATING_TOLERANCE,
    max_rounds: int | None = None,
    local_teams: int = LOCAL_TEAMS,
) -> TeamRatings:
    """Fit team ratings on top of the model's logit, starting from level ratings.

    Rounds go on until none changes any rating by as much as ``tolerance``; a caller who passes
    ``max_rounds`` learns from ``converged`` whether that came about.

    Ratings stay a frame, joined to the pairings in each round, so the number of teams is not bounded by the driver's
    memory: more than ``local_teams`` are written out in each round.
    """
    pairs = stored(pair_kernel(pair_results(matches), profiles, model))
    total = pairs.agg(F.sum("n")).first()[0] or 0
    ratings = _Rounds(level_ratings(matches), total, local_teams)
    shares = (F.lit(1.0) / F.col("a_matches"), F.lit(1.0) / F.col("h_matches"))
    changes: list[float] = []
    while max_rounds is None or len(changes) < max_rounds:
        changes.append(ratings.advance(_rating_round(pairs, ratings.frame, step, shares)))
        if changes[-1] < tolerance:
            break
    done = bool(changes) and changes[-1] < tolerance
    discard(pairs)
    return TeamRatings(ratings.teams(), ratings.ratio, changes, done)


def ratings_in_order(
    matches: DataFrame,
    profiles: DataFrame,
    model: WinModel,
    rate: float = ORDER_RATE,
    date: str = "game_date",
    local_teams: int = LOCAL_TEAMS,
) -> TeamRatings:
    """Ratings after one pass over the dates in their order, starting from level ratings.

    All matches of a date are judged by the ratings before it, and each moves the ratings of both its teams by ``rate``
    times its residual. The model's logit keeps the weight one. With one match a date this is the plain
    sequential update. ``changes`` has the largest move of each date; matches without a date are left out.

    The pairings are written by date, so that a date reads its own folder only; their date is kept as text there, in whose
    order dates of one form (year first) come as they do in time.
    """
    dated = matches.filter(F.col(date).isNotNull())
    results = dated.groupBy(F.col(date).cast("string").alias("played"), "away_team", "home_team").agg(
        F.count(F.lit(1)).alias("n"), F.count_if(away_win()).alias("wins")
    )
    pairs = stored(pair_kernel(results, profiles, model), partition_by=("played",))
    # One row per date; the calendar bounds them.
    days = [r["played"] for r in pairs.select("played").distinct().orderBy("played").collect()]
    ratings, changes = _Rounds(level_ratings(matches), None, local_teams), []
    even = (F.lit(1.0), F.lit(1.0))
    for day in days:
        today = pairs.filter(F.col("played") == F.lit(day))
        changes.append(ratings.advance(_rating_round(today, ratings.frame, rate, even)))
    discard(pairs)
    return TeamRatings(ratings.teams(), 1.0, changes, True)


def _changes(after: DataFrame) -> tuple[float, float]:
    """Largest change of any rating of any team in a round, and the change held by the row without a team."""
    moved = F.greatest(*[F.abs(F.col(f"d_{c}")) for c in RATING_COLUMNS])
    alone = F.col("team").isNull()
    found = after.agg(F.max(F.when(~alone, moved)), F.max(F.when(alone, F.col("r_away")))).first()
    return float(found[0] or 0.0), float(found[1] or 0.0)


def predict_pairs(
    pairs: DataFrame, profiles: DataFrame, ratings: TeamRatings, model: WinModel
) -> DataFrame:
    """Probability of an away win per pair: ``away_team, home_team, p_away``.

    A pair with a team that never played keeps its row with a null.
    """
    rated = _rated_pairs(pair_kernel(pairs, profiles, model), ratings.teams)
    return rated.select(
        "away_team", "home_team", logistic(_rating_logit(F.lit(float(ratings.ratio)))).alias("p_away")
    )

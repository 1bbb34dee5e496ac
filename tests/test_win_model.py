import numpy as np
import pytest
from pyspark.sql import functions as F

from tallyloom.operators import playlog, win_model
from tallyloom.operators.lineage import settled
from tallyloom.plans.registry import match_features

SIDES = ("away", "home")


@pytest.fixture(scope="module")
def matches(spark, tables):
    return settled(match_features(spark, tables))


@pytest.fixture(scope="module")
def local(matches):
    return matches.toPandas()


def local_profiles(local, side, mean, scale):
    return (local[[f"{side}_r{i}" for i in range(9)]].to_numpy() - mean) / scale


def pooled_scale(local):
    rows = np.vstack([local[[f"{s}_r{i}" for i in range(9)]].to_numpy() for s in SIDES])
    scale = rows.std(0)
    return rows.mean(0), np.where(scale == 0, 1, scale)


def brute_force_weights(local, rounds, step):
    mean, scale = pooled_scale(local)
    away, home = (local_profiles(local, s, mean, scale) for s in SIDES)
    inputs = np.hstack([away, -home, np.einsum("ni,nj->nij", away, home).reshape(len(local), 81)])
    won = (local["away_score"] > local["home_score"]).to_numpy(float)
    weights = np.zeros(99)
    for _ in range(rounds):
        weights += step * ((won - 1 / (1 + np.exp(-inputs @ weights))) @ inputs) / len(local)
    return weights


def test_weights_equal_brute_force(matches, local):
    model = win_model.fit_win_model(matches, tolerance=0.0, max_rounds=4, step=0.5)
    np.testing.assert_allclose(model.weights, brute_force_weights(local, 4, 0.5), atol=1e-9)
    assert len(model.rows()) == 99


def test_loss_falls(matches):
    losses = win_model.fit_win_model(matches, tolerance=0.0, max_rounds=6, step=0.2).losses
    assert losses[0] == pytest.approx(np.log(2))
    assert all(after < before for before, after in zip(losses, losses[1:]))


def test_row_order_does_not_matter(matches):
    one = win_model.fit_win_model(matches, tolerance=0.0, max_rounds=3).weights
    two = win_model.fit_win_model(matches.repartition(5).sortWithinPartitions(F.desc("home_score")), tolerance=0.0, max_rounds=3).weights
    np.testing.assert_allclose(one, two, atol=1e-9)


def test_products_depend_on_the_features(spark):
    weights = np.zeros(99)
    weights[18] = 2.0
    model = win_model.WinModel(np.zeros(9), np.ones(9), weights)
    rows = spark.createDataFrame(
        [tuple([x] + [0.0] * 8 + [3.0] + [0.0] * 8) for x in (1.0, -1.0)],
        ", ".join(f"{s}_r{i} DOUBLE" for s in SIDES for i in range(9)),
    )
    logits = rows.select(model.logit(model.standardised("away_"), model.standardised("home_"))).collect()
    assert [r[0] for r in logits] == [6.0, -6.0]


def brute_force_ratings(local, profiles, model, rounds, step):
    teams = sorted(profiles)
    at = {t: i for i, t in enumerate(teams)}
    z = (np.array([profiles[t] for t in teams]) - model.mean) / model.scale
    away = local["away_team"].map(at).to_numpy()
    home = local["home_team"].map(at).to_numpy()
    won = (local["away_score"] > local["home_score"]).to_numpy(float)
    played = np.bincount(away, minlength=len(teams)) + np.bincount(home, minlength=len(teams))
    kernel = z[away] @ model.w_away - z[home] @ model.w_home + np.einsum("ni,ij,nj->n", z[away], model.w_cross, z[home])
    r_away, r_home = np.zeros(len(teams)), np.zeros(len(teams))
    rot, ratio = np.ones((len(teams), 4)), 1.0
    for _ in range(rounds):
        a, h = rot[away], rot[home]
        logit = ratio * kernel + r_away[away] - r_home[home]
        logit += a[:, 0] * h[:, 1] - a[:, 1] * h[:, 0] + a[:, 2] * h[:, 3] - a[:, 3] * h[:, 2]
        residual = won - 1 / (1 + np.exp(-logit))
        d_away, d_home, d_rot = np.zeros(len(teams)), np.zeros(len(teams)), np.zeros_like(rot)
        np.add.at(d_away, away, residual)
        np.add.at(d_home, home, -residual)
        for k in (0, 2):
            np.add.at(d_rot[:, k], away, residual * h[:, k + 1])
            np.add.at(d_rot[:, k + 1], away, -residual * h[:, k])
            np.add.at(d_rot[:, k], home, -residual * a[:, k + 1])
            np.add.at(d_rot[:, k + 1], home, residual * a[:, k])
        r_away = r_away + step * d_away / played
        r_home = r_home + step * d_home / played
        rot = rot + step * d_rot / played[:, None]
        ratio += step * (residual @ kernel) / len(local)
    return {t: [r_away[i], r_home[i], *rot[i]] for t, i in at.items()}, ratio


def test_ratings_equal_match_by_match_brute_force(matches, local):
    model = win_model.fit_win_model(matches, tolerance=0.0, max_rounds=3)
    profiles = playlog.team_profiles(matches)
    fitted = win_model.fit_team_ratings(matches, profiles, model, tolerance=0.0, max_rounds=3, step=0.7)
    as_local = {r["team"]: [r[f"r{i}"] for i in range(9)] for r in profiles.collect()}
    expected, ratio = brute_force_ratings(local, as_local, model, 3, 0.7)
    found = {r["team"]: [r[c] for c in win_model.RATING_COLUMNS] for r in fitted.teams.collect()}
    assert found.keys() == expected.keys()
    for team in expected:
        np.testing.assert_allclose(found[team], expected[team], atol=1e-9)
    assert fitted.ratio == pytest.approx(ratio)


def test_every_pair_keeps_its_row(spark, matches):
    model = win_model.fit_win_model(matches, tolerance=0.0, max_rounds=2)
    profiles = playlog.team_profiles(matches)
    ratings = win_model.fit_team_ratings(matches, profiles, model, tolerance=0.0, max_rounds=1)
    pairs = spark.createDataFrame(
        [("team1", "team2"), ("team2", "team1"), ("team1", "nobody")], "away_team STRING, home_team STRING"
    )
    scored = {(r[0], r[1]): r[2] for r in win_model.predict_pairs(pairs, profiles, ratings, model).collect()}
    assert len(scored) == 3 and scored[("team1", "nobody")] is None
    assert 0 < scored[("team1", "team2")] < 1 and 0 < scored[("team2", "team1")] < 1


def test_no_matches(matches):
    model = win_model.fit_win_model(matches.limit(0), max_rounds=2)
    assert not model.weights.any()


def dense_optimum(local, ridge, passes=200):
    """Weights where the penalised mean loss is least, by damped Newton steps on all rows at once."""
    mean, scale = pooled_scale(local)
    away, home = (local_profiles(local, s, mean, scale) for s in SIDES)
    inputs = np.hstack([away, -home, np.einsum("ni,nj->nij", away, home).reshape(len(local), 81)])
    won = (local["away_score"] > local["home_score"]).to_numpy(float)
    weights = np.zeros(99)
    for _ in range(passes):
        p = 1 / (1 + np.exp(-inputs @ weights))
        gradient = (won - p) @ inputs / len(local) - ridge * weights
        curvature = (inputs * (p * (1 - p))[:, None]).T @ inputs / len(local) + ridge * np.eye(99)
        weights += 0.5 * np.linalg.solve(curvature, gradient)
    return weights


def test_newton_finds_the_optimum_in_few_passes(matches, local):
    model = win_model.fit_win_model_newton(matches)
    assert model.converged and len(model.losses) <= 12
    assert model.gradients[-1] < win_model.GRADIENT_TOLERANCE
    np.testing.assert_allclose(model.weights, dense_optimum(local, win_model.WEIGHT_RIDGE), atol=2e-3)
    stopped = win_model.fit_win_model_newton(matches, max_rounds=2)
    assert not stopped.converged and len(stopped.losses) == 2


def test_newton_where_one_side_always_wins_and_without_matches(matches):
    """Without a ridge there would be no optimum."""
    model = win_model.fit_win_model_newton(matches.filter("away_score > home_score"))
    assert model.converged and np.all(np.isfinite(model.weights))
    none = win_model.fit_win_model_newton(matches.limit(0))
    assert none.converged and not none.weights.any()


def estimate(df):
    return df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes().bit_length()


@pytest.mark.parametrize("local_teams", [win_model.LOCAL_TEAMS, 0])
def test_rounds_stay_cheap(matches, monkeypatch, local_teams):
    """Sixty rounds: the estimated size of a round's plan is flat, and no round takes longer than the first ones by much."""
    from time import perf_counter

    sizes, times = [], []
    plain = win_model._rating_round

    def watched(pairs, ratings, *rest):
        sizes.append(estimate(ratings))
        times.append(perf_counter())
        return plain(pairs, ratings, *rest)

    monkeypatch.setattr(win_model, "_rating_round", watched)
    model = win_model.fit_win_model(matches, max_rounds=2)
    rounds = 60 if local_teams else 15
    win_model.fit_team_ratings(matches, playlog.team_profiles(matches), model, tolerance=0.0, max_rounds=rounds, local_teams=local_teams)
    assert len(sizes) == rounds and max(sizes) <= sizes[0] + 4 and max(sizes) < 24
    taken = np.diff(times)
    assert np.median(taken[-5:]) < 3 * np.median(taken[:10]) and np.median(taken) < 5


def test_few_and_many_teams_get_the_same_ratings(matches):
    model = win_model.fit_win_model(matches, max_rounds=3)
    profiles = playlog.team_profiles(matches)
    found = [
        {r["team"]: tuple(r)[1:] for r in win_model.fit_team_ratings(matches, profiles, model, max_rounds=4, local_teams=n).teams.collect()}
        for n in (0, 10_000)
    ]
    assert found[0].keys() == found[1].keys()
    for team, values in found[0].items():
        np.testing.assert_allclose(values, found[1][team], atol=1e-9)


def plain_sequence(local, profiles, model, rate):
    """One match after the other, in order of date."""
    at = {t: (np.array(profiles[t]) - model.mean) / model.scale for t in profiles}
    state = {t: np.array([0.0, 0.0, 1.0, 1.0, 1.0, 1.0]) for t in profiles}
    for _, m in local.sort_values("game_date").iterrows():
        x, y = at[m["away_team"]], at[m["home_team"]]
        a, h = state[m["away_team"]].copy(), state[m["home_team"]].copy()
        logit = x @ model.w_away - y @ model.w_home + x @ model.w_cross @ y + a[0] - h[1]
        logit += a[2] * h[3] - a[3] * h[2] + a[4] * h[5] - a[5] * h[4]
        residual = rate * (float(m["away_score"] > m["home_score"]) - 1 / (1 + np.exp(-logit)))
        state[m["away_team"]] += residual * np.array([1, 0, h[3], -h[2], h[5], -h[4]])
        state[m["home_team"]] += residual * np.array([0, -1, -a[3], a[2], -a[5], a[4]])
    return state


@pytest.mark.parametrize("local_teams", [win_model.LOCAL_TEAMS, 0])
def test_order_of_play_equals_a_plain_sequence(matches, local_teams):
    """One match a date; a match without a date is left out of the pass."""
    first = matches.dropDuplicates(["game_date"])
    single = settled(first.limit(12))
    model = win_model.fit_win_model(matches, max_rounds=4)
    profiles = settled(playlog.team_profiles(single))
    undated = single.limit(1).withColumn("game_date", F.lit(None).cast(dict(single.dtypes)["game_date"]))
    fitted = win_model.ratings_in_order(single.unionByName(undated), profiles, model, 0.3, local_teams=local_teams)
    as_local = {r["team"]: [r[f"r{i}"] for i in range(9)] for r in profiles.collect()}
    expected = plain_sequence(single.toPandas(), as_local, model, 0.3)
    assert len(fitted.changes) == 12
    for r in fitted.teams.collect():
        np.testing.assert_allclose([r[c] for c in win_model.RATING_COLUMNS], expected[r["team"]], atol=1e-9)


def test_no_dates(matches):
    model = win_model.fit_win_model(matches, max_rounds=1)
    none = win_model.ratings_in_order(matches.limit(0), playlog.team_profiles(matches.limit(0)), model)
    assert none.changes == [] and none.teams.count() == 0

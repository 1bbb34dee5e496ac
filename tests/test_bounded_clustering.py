import numpy as np
import pytest

from tallyloom.operators import bounded_clustering as bounded
from tallyloom.operators import clustering
from tests.test_clustering import brute_force, points_frame


def blobs(seed, points=3000, clusters=12, width=6, apart=6.0):
    rng = np.random.default_rng(seed)
    centers = rng.normal(size=(clusters, width)) * apart
    return centers[rng.integers(0, clusters, points)] + rng.normal(size=(points, width))


@pytest.mark.parametrize("renew", [0.2, 1.0, 100.0])
def test_every_step_equals_the_plain_step(spark, renew):
    matrix = blobs(5, points=900)
    expected, shifts = brute_force(matrix, matrix[:12].copy(), 1e-9)
    found = bounded.fit_bounded(points_frame(spark, matrix), matrix[:12], threshold=1e-9, renew=renew)
    assert found.steps == len(shifts) and found.converged
    np.testing.assert_allclose(found.centers, expected, rtol=1e-9)
    np.testing.assert_allclose(found.shifts, shifts, rtol=1e-6, atol=1e-12)


def test_few_distances_once_the_centres_are_near(spark):
    matrix = blobs(7)
    found = bounded.fit_bounded(points_frame(spark, matrix), matrix[:12], threshold=1e-12)
    full = len(matrix) * 12
    assert found.distances[0] == full and len(found.distances) == found.steps
    later = found.distances[5:]
    assert later and sum(later) < full * len(later) / 3
    rows = found.steps_frame(spark).collect()
    assert [r["distances"] for r in rows] == found.distances


def test_bounds_never_lose_a_changed_point(spark):
    rng = np.random.default_rng(11)
    matrix = np.round(rng.normal(size=(600, 2)) * 3)
    old, new = matrix[:5] + 0.5, matrix[:5] + rng.normal(size=(5, 2))
    table = bounded.anchor(points_frame(spark, matrix), old)
    gained, change, measured = bounded.changes(table, old, new)
    before, after = (clustering.nearest(matrix, c)[0] for c in (old, new))
    counts = [np.bincount(x, minlength=5) for x in (after, before)]
    assert gained.tolist() == (counts[0] - counts[1]).tolist()
    sums = [np.array([matrix[x == i].sum(axis=0) for i in range(5)]) for x in (after, before)]
    np.testing.assert_allclose(change, sums[0] - sums[1], atol=1e-9)
    assert measured <= len(matrix) * 5
    bounded.discard(table)


def test_unmoved_centres_measure_nothing_between_blobs(spark):
    matrix = np.array([[0.0], [1.0], [100.0], [101.0]])
    centers = np.array([[0.5], [100.5]])
    table = bounded.anchor(points_frame(spark, matrix), centers)
    gained, _, measured = bounded.changes(table, centers, centers)
    assert measured == 0 and not gained.any()
    bounded.discard(table)


def test_edges(spark):
    schema = "id LONG, point ARRAY<DOUBLE>"
    none = bounded.fit_bounded(spark.createDataFrame([], schema), [[1.0], [2.0]])
    assert none.converged and none.centers.tolist() == [[1.0], [2.0]]
    odd = spark.createDataFrame(
        [(1, [0.0]), (2, [2.0]), (3, None), (4, [float("nan")]), (5, [None]), (6, [2.0])], schema
    )
    one = bounded.fit_bounded(odd, [[5.0]])
    assert one.converged and one.centers[0][0] == pytest.approx(4 / 3)
    ties = bounded.fit_bounded(odd, [[0.0], [2.0], [2.0]], max_steps=3)
    plain = clustering.fit(odd, [[0.0], [2.0], [2.0]], max_steps=3)
    assert ties.centers.tolist() == plain.centers.tolist()
    with pytest.raises(ValueError):
        bounded.fit_bounded(odd, [[float("nan")]])
    assert bounded.fit_bounded(odd, [[5.0]], max_steps=0).steps == 0


def test_no_shuffle_but_that_of_the_sums(spark):
    matrix = blobs(3, points=200)
    table = bounded.anchor(points_frame(spark, matrix), matrix[:4])
    rows = table.filter(bounded.Bounds.between(matrix[:4], matrix[:4] + 0.1).in_doubt())
    plan = rows._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Python" not in plan
    bounded.discard(table)


def test_anchors_are_removed(spark, tmp_path):
    from pathlib import Path

    from tallyloom.operators.lineage import STORED, ensure_checkpoint_dir

    folder = Path(ensure_checkpoint_dir(spark).removeprefix("file:"))
    before = set(folder.glob(f"{STORED}*"))
    matrix = blobs(2, points=300)
    bounded.fit_bounded(points_frame(spark, matrix), matrix[:5], renew=0.1)
    assert set(folder.glob(f"{STORED}*")) == before

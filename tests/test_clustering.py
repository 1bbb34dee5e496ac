import numpy as np
import pytest

from tallyloom.operators import clustering
from tallyloom.sources import centers_frame, read_centers


def points_frame(spark, matrix):
    rows = [(i, [float(x) for x in row]) for i, row in enumerate(matrix)]
    return spark.createDataFrame(rows, "id LONG, point ARRAY<DOUBLE>").repartition(3)


def brute_force(points, centers, threshold, steps=100):
    shifts = []
    for _ in range(steps):
        index = ((points[:, None] - centers[None]) ** 2).sum(-1).argmin(1)
        moved = np.array([
            points[index == i].mean(0) if (index == i).any() else centers[i] for i in range(len(centers))
        ])
        shifts.append(((moved - centers) ** 2).sum())
        centers = moved
        if shifts[-1] < threshold:
            break
    return centers, shifts


def test_equal_distance_goes_to_the_lower_cluster(spark):
    points = points_frame(spark, [[0.0], [1.0], [-1.0]])
    assigned = clustering.assign(points, [[1.0], [-1.0], [1.0]]).orderBy("id").collect()
    assert [r["cluster"] for r in assigned] == [0, 0, 1]


def test_empty_cluster_keeps_its_centre(spark):
    moved, sizes, _ = clustering.lloyd_step(points_frame(spark, [[0.0], [2.0], [4.0]]), [[1.0], [100.0], [4.0]])
    assert moved.tolist() == [[1.0], [100.0], [4.0]] and sizes.tolist() == [2, 0, 1]


def test_fit_equals_brute_force(spark):
    rng = np.random.default_rng(3)
    matrix = rng.normal(size=(400, 5)) + rng.integers(0, 4, size=(400, 1)) * 3
    expected, shifts = brute_force(matrix, matrix[:6].copy(), 0.001)
    found = clustering.fit(points_frame(spark, matrix), matrix[:6])
    assert found.steps == len(shifts)
    np.testing.assert_allclose(found.centers, expected, rtol=1e-9)
    np.testing.assert_allclose(found.shifts, shifts, rtol=1e-6, atol=1e-9)


def test_error_never_rises(spark):
    rng = np.random.default_rng(4)
    matrix = rng.normal(size=(200, 3))
    points, centers, errors = points_frame(spark, matrix), matrix[:4], []
    for _ in range(6):
        centers, _, error = clustering.lloyd_step(points, centers)
        errors.append(error)
    assert all(after <= before + 1e-9 for before, after in zip(errors, errors[1:]))


def test_steps_can_be_limited_and_are_kept(spark, tmp_path):
    matrix = np.arange(40, dtype=float).reshape(20, 2) ** 1.3
    found = clustering.fit(points_frame(spark, matrix), matrix[:3], max_steps=2, snapshot_dir=str(tmp_path))
    assert found.steps == 2
    last = clustering.collect_centers(read_centers(spark, str(tmp_path / "center_1")))
    np.testing.assert_allclose(last, found.centers)
    assert [r["step"] for r in found.shifts_frame(spark).collect()] == [1, 2]


def test_assignment_keeps_the_row_and_null_vectors(spark):
    df = spark.createDataFrame([(1, "a", [0.0, 0.0]), (2, "b", None)], "id LONG, tag STRING, point ARRAY<DOUBLE>")
    rows = clustering.assign(df, [[5.0, 5.0], [1.0, 1.0]]).orderBy("id").collect()
    assert [tuple(r) for r in rows] == [(1, "a", [0.0, 0.0], 1), (2, "b", None, None)]
    _, sizes, _ = clustering.lloyd_step(df, [[5.0, 5.0], [1.0, 1.0]])
    assert sizes.sum() == 1


def test_wrong_width_is_an_error(spark):
    with pytest.raises(Exception, match="every vector needs 2 numbers"):
        clustering.assign(points_frame(spark, [[1.0, 2.0, 3.0]]), [[0.0, 0.0]]).collect()


def test_centres_come_in_cluster_order(spark):
    frame = centers_frame(spark, [[1.0], [2.0], [3.0]]).orderBy("center", ascending=False)
    assert clustering.collect_centers(frame).tolist() == [[1.0], [2.0], [3.0]]


def test_one_cluster_with_nearly_all_points(spark):
    matrix = np.vstack([np.full((3000, 2), 1.0), np.full((5, 2), 9.0)])
    moved, sizes, _ = clustering.lloyd_step(points_frame(spark, matrix), [[0.0, 0.0], [10.0, 10.0]])
    assert sizes.tolist() == [3000, 5]
    np.testing.assert_allclose(moved, [[1.0, 1.0], [9.0, 9.0]])


def test_vectors_with_gaps_take_no_part(spark):
    nan = float("nan")
    rows = [(1, [0.0, 0.0]), (2, [nan, 1.0]), (3, [None, 1.0]), (4, [9.0, 9.0]), (5, None), (6, [1.0, 0.0])]
    df = spark.createDataFrame(rows, "id LONG, point ARRAY<DOUBLE>")
    start = [[0.0, 1.0], [8.0, 8.0]]
    assert {r["id"]: r["cluster"] for r in clustering.assign(df, start).collect()} == {1: 0, 2: None, 3: None, 4: 1, 5: None, 6: 0}
    assert clustering.points_left_out(df) == 3
    found = clustering.fit(df, start)
    assert found.converged and found.steps == 2
    np.testing.assert_allclose(found.centers, [[0.5, 0.0], [9.0, 9.0]])


def test_a_start_that_is_no_number_is_an_error(spark):
    with pytest.raises(ValueError, match="not finite"):
        clustering.fit(points_frame(spark, [[1.0, 2.0]]), [[float("nan"), 0.0]])


def test_a_limited_fit_says_so(spark):
    matrix = np.arange(40, dtype=float).reshape(20, 2) ** 1.3
    assert not clustering.fit(points_frame(spark, matrix), matrix[:3], max_steps=1).converged


@pytest.mark.parametrize("left", [0, 1, 2, "all"])
def test_resumed_fit_equals_an_unbroken_one(spark, tmp_path, left):
    """Broken off after any step, with a snapshot that is not complete and others behind the gap."""
    draw = np.random.default_rng(4)
    points = points_frame(spark, draw.normal(size=(120, 3)).round(3))
    start = draw.normal(size=(4, 3))
    folder = tmp_path / "steps"
    whole = clustering.fit(points, start, threshold=1e-9, snapshot_dir=str(folder))
    assert whole.converged and whole.steps > 3
    if left != "all":
        (folder / f"center_{left}" / "_SUCCESS").unlink()
    resumed = clustering.fit(points, start, threshold=1e-9, snapshot_dir=str(folder), resume=True)
    np.testing.assert_allclose(resumed.centers, whole.centers, atol=1e-12)
    np.testing.assert_allclose(resumed.shifts, whole.shifts, atol=1e-12)
    assert resumed.converged and len(list(clustering.completed_steps(spark, str(folder)))) == whole.steps


def test_resume_refuses_other_centres_and_counts_all_steps(spark, tmp_path):
    points = points_frame(spark, np.random.default_rng(5).normal(size=(60, 2)))
    start = np.array([[0.0, 0.0], [1.0, 1.0]])
    one = clustering.fit(points, start, threshold=0.0, max_steps=2, snapshot_dir=str(tmp_path / "s"))
    again = clustering.fit(points, start, threshold=0.0, max_steps=1, snapshot_dir=str(tmp_path / "s"), resume=True)
    assert again.shifts == one.shifts[:1]
    with pytest.raises(ValueError):
        clustering.fit(points, start[:, :1], snapshot_dir=str(tmp_path / "s"), resume=True)
    with pytest.raises(ValueError):
        clustering.fit(points, start, resume=True)

"""K-means from given starting centres.

Only the vector column is read for a step. Each task adds up its points per
cluster, so a step shuffles one row per task and cluster, and the driver sees
one row per cluster. Centres are ordered by cluster id, never by position in a
file, and a cluster that loses all its points keeps its centre.

A vector with a null or NaN coordinate counts as not given, like a null vector: it
has no cluster and is in no sum. ``points_left_out`` counts such rows.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyloom.operators.lineage import path_exists
from tallyloom.operators.partials import matrix, slot_sums
from tallyloom.sources.readers import read_centers
from tallyloom.sources.writers import centers_frame, write_centers

SHIFT_THRESHOLD = 0.001


@dataclass
class Clustering:
    """Fitted centres and the total squared shift of every step."""

    centers: np.ndarray
    shifts: list[float]
    converged: bool

    @property
    def steps(self) -> int:
        return len(self.shifts)

    def centers_frame(self, spark: SparkSession) -> DataFrame:
        """``cluster, center``."""
        return centers_frame(spark, self.centers)

    def shifts_frame(self, spark: SparkSession) -> DataFrame:
        """``step, shift``, counted from 1."""
        return spark.createDataFrame(
            [(i, float(s)) for i, s in enumerate(self.shifts, start=1)], "step INT, shift DOUBLE"
        )


def collect_centers(centers: DataFrame) -> np.ndarray:
    """Centres of a ``cluster, center`` frame as a matrix in cluster order.

    The result has one row per cluster, a number the caller chose.
    """
    rows = centers.select("cluster", "center").orderBy("cluster").collect()
    return np.array([r["center"] for r in rows], dtype=np.float64)


def nearest(points: np.ndarray, centers: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Nearest centre of each point and its squared distance; ties go to the lower id."""
    best = np.full(len(points), np.inf)
    index = np.zeros(len(points), dtype=np.int32)
    for i, center in enumerate(centers):
        difference = points - center
        distance = np.einsum("ij,ij->i", difference, difference)
        closer = distance < best
        best[closer] = distance[closer]
        index[closer] = i
    return index, best


def assign(
    points: DataFrame, centers: Sequence[Sequence[float]], vector: str = "point"
) -> DataFrame:
    """Every point row with its nearest ``cluster`` (null for a null vector); no shuffle."""
    centers = np.asarray(centers, dtype=np.float64)
    shared = points.sparkSession.sparkContext.broadcast(centers)

    @F.arrow_udf("int")
    def cluster_of(vectors: pa.Array) -> pa.Array:
        given = vectors.is_valid().to_numpy(zero_copy_only=False)
        cluster = np.zeros(len(vectors), dtype=np.int32)
        cluster[given], _ = nearest(
            matrix(vectors.drop_null(), shared.value.shape[1]), shared.value
        )
        return pa.array(cluster, mask=~given)

    known = F.when(usable(F.col(vector)), F.col(vector))
    return points.withColumn("cluster", cluster_of(known))


def usable(vector: Column) -> Column:
    """Whether a vector is given in full: no null, no coordinate that is null or NaN."""
    return vector.isNotNull() & ~F.exists(vector, lambda x: x.isNull() | F.isnan(x))


def points_left_out(points: DataFrame, vector: str = "point") -> int:
    """Rows that are in no cluster because their vector is not given in full."""
    return points.filter(~usable(F.col(vector))).count()


def lloyd_step(
    points: DataFrame, centers: Sequence[Sequence[float]], vector: str = "point"
) -> tuple[np.ndarray, np.ndarray, float]:
    """One step: new centres, points per cluster, and the squared error of the old centres."""
    centers = np.asarray(centers, dtype=np.float64)
    if not np.all(np.isfinite(centers)):
        raise ValueError("a starting centre has a coordinate that is not finite")
    clusters, width = centers.shape
    context = points.sparkSession.sparkContext
    shared = context.broadcast(centers)

    def add(batch: pa.RecordBatch, weights: np.ndarray, sums: np.ndarray) -> None:
        values = matrix(batch.column(0), width)
        index, distance = nearest(values, shared.value)
        weights += np.bincount(index, minlength=clusters)
        sums[:, width] += np.bincount(index, weights=distance, minlength=clusters)
        for i in np.unique(index):
            sums[i, :width] += values[index == i].sum(axis=0)

    given = points.select(vector).filter(usable(F.col(vector)))
    merged = slot_sums(given, add, clusters, width + 1)
    shared.destroy()
    moved = centers.copy()
    sizes = np.zeros(clusters, dtype=np.int64)
    error = 0.0
    for cluster, (size, mean) in merged.items():
        moved[cluster] = mean[:width]
        sizes[cluster] = int(size)
        error += size * mean[width]
    return moved, sizes, error


def squared_shift(old: np.ndarray, new: np.ndarray) -> float:
    """Total squared movement over all clusters and dimensions."""
    return float(np.sum((np.asarray(new) - np.asarray(old)) ** 2))


def fit(
    points: DataFrame,
    centers: Sequence[Sequence[float]],
    vector: str = "point",
    threshold: float = SHIFT_THRESHOLD,
    max_steps: int | None = None,
    snapshot_dir: str | None = None,
    resume: bool = False,
) -> Clustering:
    """Repeat steps until the total squared shift falls below the threshold.

    A caller who passes ``max_steps`` learns from ``converged`` whether it did. A shift that
    is not finite is an error.

    ``snapshot_dir`` keeps the centres of each step in ``center_0``, ``center_1``, …. With ``resume`` a
    fit of the same points and starting centres goes on from the last of the steps that are there without a gap
    (``completed_steps``) and gives the shifts and centres of a fit that was never broken off; ``max_steps`` counts
    all steps.
    """
    if resume and not snapshot_dir:
        raise ValueError("a fit is resumed from its snapshots")
    current = np.asarray(centers, dtype=np.float64)
    shifts: list[float] = []
    for moved in completed_steps(points.sparkSession, snapshot_dir) if resume else ():
        if moved.shape != current.shape:
            raise ValueError("the snapshots belong to other starting centres")
        if (max_steps is not None and len(shifts) >= max_steps) or (shifts and shifts[-1] < threshold):
            break
        shifts.append(squared_shift(current, moved))
        current = moved
    while (max_steps is None or len(shifts) < max_steps) and not (shifts and shifts[-1] < threshold):
        moved, _, _ = lloyd_step(points, current, vector)
        if snapshot_dir:
            write_centers(
                centers_frame(points.sparkSession, moved), f"{snapshot_dir}/center_{len(shifts)}"
            )
        shifts.append(squared_shift(current, moved))
        current = moved
        if not np.isfinite(shifts[-1]):
            raise ValueError("the centres have moved beyond all numbers")
    return Clustering(current, shifts, bool(shifts) and shifts[-1] < threshold)


def completed_steps(spark: SparkSession, snapshot_dir: str) -> Iterator[np.ndarray]:
    """Centres of the steps whose snapshots are complete, from the first to the first that is missing."""
    step = 0
    while path_exists(spark, f"{snapshot_dir}/center_{step}/_SUCCESS"):
        yield collect_centers(read_centers(spark, f"{snapshot_dir}/center_{step}"))
        step += 1

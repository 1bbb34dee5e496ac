"""K-means steps that measure only the points whose cluster is in doubt.

An *anchor* is a stored table of the points with, for the centres of one step, their cluster and their distances to
its centre, to the second nearest and to each of them. While a point's own centre has moved by ``m`` since then and no other
by more than ``o``, the triangle inequality puts its distance to its own centre at no more than ``own + m`` and to any other at no
less than ``second - o`` (nor less than the way to the next centre less the own distance). A point whose bounds do not meet
keeps its cluster unmeasured. This is a filter on three narrow columns, decided before a vector goes to Python. The
rest is measured, first to its own centre alone, then to each centre whose own bound (the distance then, less its movement)
does not rule it out.

Sums are those of the anchor plus the points that came and less the points that left since, always against
the anchor, so rounding errors do not add up from step to step. Movements are taken from the anchor's centres
to the present ones, which is never more than the sum of the steps between. A step has the shuffle of a plain step (a row per task
and cluster), no join and no sort. An anchor is renewed, which writes the points once more, when the distances measured since
amount to ``renew`` full steps; it replaces the one before.

An anchor adds a number per centre to each vector. Where points lie about as far from all centres, as random vectors of many
dimensions do, no bound rules much out, and the plain fit is the better choice.

The centres are those of ``clustering.fit`` up to rounding. Vectors that are null or not whole are in no cluster.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyloom.operators.clustering import SHIFT_THRESHOLD, Clustering, nearest, squared_shift, usable
from tallyloom.operators.lineage import discard, stored
from tallyloom.operators.partials import matrix, slot_sums

# Bounds closer than this share of their sum count as met, so that rounding never decides.
SLACK = 1e-9
_STATE = "point ARRAY<DOUBLE>, cluster INT, own DOUBLE, second DOUBLE, reach ARRAY<DOUBLE>"


@dataclass
class BoundedClustering(Clustering):
    """A fit with the number of distances measured in each step."""

    distances: list[int] = field(default_factory=list)

    def steps_frame(self, spark: SparkSession) -> DataFrame:
        """``step, shift, distances``, counted from 1."""
        rows = [(i, float(s), int(d)) for i, (s, d) in enumerate(zip(self.shifts, self.distances), start=1)]
        return spark.createDataFrame(rows, "step INT, shift DOUBLE, distances LONG")


def distances_to(points: np.ndarray, center: np.ndarray) -> np.ndarray:
    """Distance of each point to one centre."""
    difference = points - center
    return np.sqrt(np.einsum("ij,ij->i", difference, difference))


@dataclass
class Bounds:
    """What the movement of the centres since the anchor says of each cluster's points."""

    moved: np.ndarray
    others: np.ndarray
    gap: np.ndarray

    @classmethod
    def between(cls, old: np.ndarray, new: np.ndarray) -> Bounds:
        moved = np.sqrt(((new - old) ** 2).sum(axis=1))
        others, gap = np.zeros(len(new)), np.full(len(new), np.inf)
        for i in range(len(new)):
            rest = np.arange(len(new)) != i
            if rest.any():
                others[i] = moved[rest].max()
                gap[i] = np.sqrt(((new[rest] - new[i]) ** 2).sum(axis=1)).min()
        return cls(moved, others, gap)

    def in_doubt(self) -> Column:
        """Whether a row of the anchor may have another nearest centre by now."""

        def of(values: np.ndarray) -> Column:
            return F.get(F.lit([float(v) for v in values]), F.col("cluster"))

        most = F.col("own") + of(self.moved)
        far, between = F.col("second") - of(self.others), of(self.gap) - most
        reach = F.greatest(far, between)
        return most + SLACK * (most + F.abs(reach)) >= reach


def anchor(points: DataFrame, centers: np.ndarray, vector: str = "point") -> DataFrame:
    """The usable points as a stored table with cluster, own and second distance."""
    shared = points.sparkSession.sparkContext.broadcast(centers)

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            values = matrix(batch.column(0), shared.value.shape[1])
            reach = np.stack([distances_to(values, c) for c in shared.value], axis=1)
            index, best = nearest(values, shared.value)
            others = reach.copy()
            others[np.arange(len(values)), index] = np.inf
            second = others.min(axis=1, initial=np.inf)
            ends = pa.array(np.arange(len(values) + 1) * reach.shape[1], pa.int32())
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0).cast(pa.list_(pa.float64())),
                    pa.array(index, pa.int32()),
                    pa.array(np.sqrt(best)),
                    pa.array(second),
                    pa.ListArray.from_arrays(ends, pa.array(reach.ravel())),
                ],
                names=["point", "cluster", "own", "second", "reach"],
            )

    given = points.select(F.col(vector).cast("array<double>").alias("point")).filter(usable(F.col("point")))
    table = stored(given.mapInArrow(measure, _STATE))
    shared.destroy()
    return table


def anchor_sums(table: DataFrame, clusters: int, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Points and sums of coordinates per cluster of an anchor."""

    def add(batch: pa.RecordBatch, weights: np.ndarray, sums: np.ndarray) -> None:
        index = batch.column(1).to_numpy()
        weights += np.bincount(index, minlength=clusters)
        values = matrix(batch.column(0), width)
        for i in np.unique(index):
            sums[i] += values[index == i].sum(axis=0)

    return _dense(slot_sums(table.select("point", "cluster"), add, clusters, width), clusters, width)


def changes(
    table: DataFrame, old: np.ndarray, new: np.ndarray
) -> tuple[np.ndarray, np.ndarray, int]:
    """Points and sums that each cluster gained since the anchor (losses count below zero), and distances measured."""
    clusters, width = new.shape
    bounds = Bounds.between(old, new)
    shared = table.sparkSession.sparkContext.broadcast((new, bounds))

    def add(batch: pa.RecordBatch, weights: np.ndarray, sums: np.ndarray) -> None:
        centers, known = shared.value
        values, cluster = matrix(batch.column(0), width), batch.column(1).to_numpy()
        difference = values - centers[cluster]
        best = np.einsum("ij,ij->i", difference, difference)
        index, nearer = cluster.copy(), np.sqrt(best)
        least = matrix(batch.column(2), clusters) - known.moved
        weights[2 * clusters] += len(values)
        for j, center in enumerate(centers):
            out = nearer + SLACK * (nearer + np.abs(least[:, j])) < least[:, j]
            some = np.flatnonzero(~out & (cluster != j))
            weights[2 * clusters] += len(some)
            difference = values[some] - center
            distance = np.einsum("ij,ij->i", difference, difference)
            closer = (distance < best[some]) | ((distance == best[some]) & (j < index[some]))
            some = some[closer]
            best[some], nearer[some], index[some] = distance[closer], np.sqrt(distance[closer]), j
        change = index != cluster
        here, to, origin = values[change], index[change], cluster[change]
        # Gains and losses have slots of their own, the last slot counts distances.
        for first, of in ((0, to), (clusters, origin)):
            for i in np.unique(of):
                weights[first + i] += np.count_nonzero(of == i)
                sums[first + i] += here[of == i].sum(axis=0)

    rows = table.filter(bounds.in_doubt()).select("point", "cluster", "reach")
    weights, sums = _dense(slot_sums(rows, add, 2 * clusters + 1, width), 2 * clusters + 1, width)
    shared.destroy()
    gained = weights[:clusters] - weights[clusters : 2 * clusters]
    return gained, sums[:clusters] - sums[clusters : 2 * clusters], int(round(weights[2 * clusters]))


def _dense(merged: dict[int, tuple[float, np.ndarray]], slots: int, width: int) -> tuple[np.ndarray, np.ndarray]:
    weights, sums = np.zeros(slots), np.zeros((slots, width))
    for slot, (weight, mean) in merged.items():
        weights[slot], sums[slot] = weight, weight * mean
    return weights, sums


def fit_bounded(
    points: DataFrame,
    centers: Sequence[Sequence[float]],
    vector: str = "point",
    threshold: float = SHIFT_THRESHOLD,
    max_steps: int | None = None,
    renew: float = 1.0,
) -> BoundedClustering:
    """``clustering.fit`` with bounds: repeat steps until the total squared shift falls below the threshold.

    ``renew`` is the number of full steps' worth of distances after which the points are measured and written anew.
    Without usable points the centres stay and the fit ends after one step.
    """
    current = np.asarray(centers, dtype=np.float64)
    if not np.all(np.isfinite(current)):
        raise ValueError("a starting centre has a coordinate that is not finite")
    clusters, width = current.shape
    shifts: list[float] = []
    distances: list[int] = []
    table, since = None, 0
    while (max_steps is None or len(shifts) < max_steps) and not (shifts and shifts[-1] < threshold):
        if table is None or since > renew * base.sum() * clusters:
            before, table = table, anchor(points, current, vector)
            if before is not None:
                discard(before)
            base, base_sums = anchor_sums(table, clusters, width)
            placed, since = current, 0
            weights, sums = base, base_sums
            distances.append(int(round(base.sum())) * clusters)
        else:
            gained, change, measured = changes(table, placed, current)
            weights, sums = base + gained, base_sums + change
            distances.append(measured)
            since += measured
        held = np.round(weights) > 0
        moved = current.copy()
        moved[held] = sums[held] / weights[held, None]
        shifts.append(squared_shift(current, moved))
        current = moved
        if not np.isfinite(shifts[-1]):
            raise ValueError("the centres have moved beyond all numbers")
    if table is not None:
        discard(table)
    return BoundedClustering(current, shifts, bool(shifts) and shifts[-1] < threshold, distances)

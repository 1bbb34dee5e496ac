"""Sums of numeric arrays, formed per task first and merged by Spark."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

PARTIAL_SCHEMA = "slot INT, share INT, weight DOUBLE, mean ARRAY<DOUBLE>"

# Reducers per slot, so that a single slot is not merged by a single task.
SHARES = 16


def matrix(column: pa.Array, width: int) -> np.ndarray:
    """Rows of a list column as a matrix of doubles; every row needs the same width."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count or not np.all(np.diff(column.offsets.to_numpy()) == width):
        raise ValueError(f"every vector needs {width} numbers")
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, width)


def slot_sums(
    df: DataFrame, add: Callable[[pa.RecordBatch, np.ndarray, np.ndarray], None], slots: int, width: int
) -> dict[int, tuple[float, np.ndarray]]:
    """Total weight and weighted mean array per slot.

    ``add`` puts one batch into a task's ``slots`` weights and ``slots x width``
    sums. A task sends at most one row per slot to the shuffle, a few reducers per
    slot merge them as they arrive, and the driver receives one row from each,
    whatever the number of input rows or the part one slot has of them.
    """

    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        weights = np.zeros(slots)
        sums = np.zeros((slots, width))
        for batch in batches:
            add(batch, weights, sums)
        used = np.flatnonzero(weights)
        share = TaskContext.get().partitionId() % SHARES
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(used, pa.int32()),
                pa.array(np.full(len(used), share), pa.int32()),
                pa.array(weights[used], pa.float64()),
                pa.array((sums[used] / weights[used, None]).tolist(), pa.list_(pa.float64())),
            ],
            names=["slot", "share", "weight", "mean"],
        )

    merged = (
        df.mapInArrow(partial, PARTIAL_SCHEMA)
        .groupBy("slot", "share")
        .agg(
            F.sum("weight").alias("weight"),
            Summarizer.mean(array_to_vector("mean"), F.col("weight")).alias("mean"),
        )
        .select("slot", "weight", vector_to_array("mean").alias("mean"))
    )
    weights, sums = np.zeros(slots), np.zeros((slots, width))
    for row in merged.collect():
        weights[row["slot"]] += row["weight"]
        sums[row["slot"]] += row["weight"] * np.array(row["mean"])
    return {int(s): (weights[s], sums[s] / weights[s]) for s in np.flatnonzero(weights)}

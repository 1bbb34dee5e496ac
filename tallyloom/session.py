"""Session settings the jobs rely on; a cluster passes its own master and sizes."""

from __future__ import annotations

import math
import os
import shutil
import sys
import tempfile
from pathlib import Path

from pyspark.sql import SparkSession

import tallyloom

# Shuffle data per task to aim at.
TASK_BYTES = 128 * 1024 * 1024


def shuffle_tasks(shuffle_bytes: int) -> int:
    """Shuffle partitions to start with; adaptive execution merges what stays small."""
    return max(200, math.ceil(shuffle_bytes / TASK_BYTES))


def build_session(
    app_name: str = "tallyloom",
    master: str | None = None,
    extra: dict[str, str] | None = None,
    shuffle_bytes: int | None = None,
) -> SparkSession:
    """Build (or fetch) a session with adaptive execution and a fixed time zone.

    ``shuffle_bytes`` is the size of the largest shuffle to expect, for an index
    about four times the text.
    """
    builder = (
        SparkSession.builder.appName(app_name)
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.cleaner.referenceTracking.cleanCheckpoints", "true")
    )
    if shuffle_bytes:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_tasks(shuffle_bytes)))
    if master:
        builder = builder.master(master)
    for key, value in (extra or {}).items():
        builder = builder.config(key, value)
    return ship_package(builder.getOrCreate())


def ship_package(spark: SparkSession) -> SparkSession:
    """Make this package known to the session's workers, unless their path already leads to it.

    The archive is handed to Spark, which serves it to every executor.
    """
    root = Path(tallyloom.__file__).resolve().parent.parent
    known = [Path(p).resolve() for p in os.environ.get("PYTHONPATH", "").split(os.pathsep) if p]
    installed = [Path(p).resolve() for p in (sys.prefix, sys.base_prefix)]
    context = spark.sparkContext
    if root in known or any(p in root.parents for p in installed) or getattr(context, "_tallyloom", False):
        return spark
    archive = shutil.make_archive(
        os.path.join(tempfile.mkdtemp(prefix="tallyloom-"), "tallyloom"), "zip", root, tallyloom.__name__
    )
    context.addPyFile(archive)
    context._tallyloom = True
    return spark

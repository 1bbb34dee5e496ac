"""Writers. All of them replace what lies at the target path.

The new output is written beside the target and takes its place when it is complete, so a job that fails leaves the old
output as it was, and a job may read what it replaces. The exchange is two renames: on a file system whose renames are
atomic, a reader finds the old output, for a moment none, or the new one, never a mixture; a job lost between the two leaves the old output beside the target
under a name with ``.old-``.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def replace_output(spark: SparkSession, path: str, write: Callable[[str], None]) -> None:
    """Have ``write`` write a folder beside ``path``, then put it in the place of what lies there."""
    context = spark.sparkContext
    target = context._jvm.org.apache.hadoop.fs.Path(path)
    files = target.getFileSystem(context._jsc.hadoopConfiguration())
    mark = uuid.uuid4().hex
    # Hidden names: a reader of the folder above passes over them.
    new, old = (
        context._jvm.org.apache.hadoop.fs.Path(target.getParent(), f".{target.getName()}.{state}-{mark}") for state in ("new", "old")
    )
    try:
        write(new.toString())
        if files.exists(target) and not files.rename(target, old):
            raise OSError(f"{path} cannot be replaced")
        if not files.rename(new, target):
            if files.exists(old):
                files.rename(old, target)
            raise OSError(f"{path} cannot be written")
        files.delete(old, True)
    finally:
        files.delete(new, True)


def write_lines(df: DataFrame, path: str, column: str) -> None:
    """Write one text column, a line per row."""
    lines = df.select(F.col(column).cast("string"))
    replace_output(df.sparkSession, path, lambda target: lines.write.text(target))


def write_key_values(df: DataFrame, path: str, key: str, value: str) -> None:
    """Write ``key <tab> value`` lines."""
    line = F.concat(
        F.coalesce(F.col(key).cast("string"), F.lit("")),
        F.lit("\t"),
        F.coalesce(F.col(value).cast("string"), F.lit("")),
    )
    write_lines(df.select(line.alias("line")), path, "line")


def write_line_parts(df: DataFrame, path: str, column: str, part: str) -> None:
    """Write one text column, a line per row, in one folder per value of ``part``."""
    lines = df.select(F.col(column).cast("string"), part)
    replace_output(df.sparkSession, path, lambda target: lines.write.partitionBy(part).text(target))


def write_csv(df: DataFrame, path: str, sep: str = ",", header: bool = False) -> None:
    """Write delimited text without quoting; null becomes an empty field."""
    replace_output(
        df.sparkSession,
        path,
        lambda target: df.write.csv(target, sep=sep, header=header, quote="", emptyValue="", nullValue=""),
    )


def write_parquet(df: DataFrame, path: str, partition_by: Sequence[str] = ()) -> None:
    """Write Parquet, in one folder per value of the partition columns if given."""
    replace_output(df.sparkSession, path, lambda target: df.write.partitionBy(*partition_by).parquet(target))


def centers_frame(spark: SparkSession, centers: Sequence[Sequence[float]]) -> DataFrame:
    """Centres as ``cluster, center``; the position is the cluster id."""
    rows = [(i, [float(x) for x in center]) for i, center in enumerate(centers)]
    return spark.createDataFrame(rows, "cluster INT, center ARRAY<DOUBLE>")


def write_centers(df: DataFrame, path: str) -> None:
    """Write ``cluster <tab> c1,c2,…`` lines."""
    write_key_values(
        df.select("cluster", F.array_join(F.col("center").cast("array<string>"), ",").alias("center")),
        path,
        "cluster",
        "center",
    )

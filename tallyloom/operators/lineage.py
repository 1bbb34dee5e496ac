"""Cutting the history of frames that are read again and again.

One rule for every kind of master: the checkpoint folder already set, else the
one named by ``spark.checkpoint.dir``, else a folder below the warehouse. All
three are folders that the driver and the executors share.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession

# Name, up to a random part, of the folders of intermediate tables.
STORED = "stored-"

# Name, up to a random part, that a bucketed table bears while it is written.
STORED_NAME = "stored_"


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Folder for checkpoints and intermediate tables."""
    context = spark.sparkContext
    current = context.getCheckpointDir()
    if current:
        return current
    named = spark.conf.get("spark.checkpoint.dir", None)
    root = named or spark.conf.get("spark.sql.warehouse.dir").rstrip("/") + "/_checkpoints"
    context.setCheckpointDir(root)
    return context.getCheckpointDir() or root


def settled(df: DataFrame) -> DataFrame:
    """The frame written out once, with its history cut."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def stored(df: DataFrame, partition_by: Sequence[str] = ()) -> DataFrame:
    """The frame as a Parquet table in the shared folder; compressed and column by column.

    Better than a checkpoint where the rows are wide or read by single columns, and in loops: a checkpoint keeps the size
    estimated for the plan it came from, which grows by a factor with every join of every round, while a table has the size it has. With
    ``partition_by`` there is a folder for each value of these columns, which come last.
    """
    spark = df.sparkSession
    path = f"{ensure_checkpoint_dir(spark)}/{STORED}{uuid.uuid4().hex}"
    if partition_by:
        df = df.select(*[c for c in df.columns if c not in partition_by], *partition_by)
        df.write.partitionBy(*partition_by).parquet(path)
    else:
        df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def stored_by_key(df: DataFrame, key: str) -> DataFrame:
    """Like ``stored``, in buckets of ``key``: a join or grouping on the key then reads the table where it lies.

    For wide rows that meet narrow ones again and again, which alone are shuffled then. There are as many buckets as shuffle
    partitions; the name that Spark needs for them is given back at once.
    """
    spark = df.sparkSession
    name = uuid.uuid4().hex
    path = f"{ensure_checkpoint_dir(spark)}/{STORED}{name}"
    buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
    df.write.format("parquet").bucketBy(buckets, key).option("path", path).saveAsTable(f"{STORED_NAME}{name}")
    table = spark.table(f"{STORED_NAME}{name}")
    spark.sql(f"DROP TABLE {STORED_NAME}{name}")
    return table


def discard(table: DataFrame) -> None:
    """Remove the files of a frame that came from ``stored``, once all that reads it has been written.

    Frames that still read the table fail afterwards. A frame from elsewhere is an error and stays untouched.
    """
    folders = set()
    for file in table.inputFiles():
        head, found, tail = file.rpartition(f"/{STORED}")
        folders.add(f"{head}{found}{tail.split('/', 1)[0]}" if found else "")
    if not folders:
        return
    folder = folders.pop()
    if folders or not folder:
        raise ValueError("only a whole stored table can be discarded")
    context = table.sparkSession.sparkContext
    path = context._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(context._jsc.hadoopConfiguration()).delete(path, True)


def path_exists(spark: SparkSession, path: str) -> bool:
    """Whether a file or folder is there, on any file system Spark reads."""
    context = spark.sparkContext
    target = context._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(context._jsc.hadoopConfiguration()).exists(target)

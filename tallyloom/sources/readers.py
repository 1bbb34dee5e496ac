"""Readers for the supported text layouts.

Every reader takes a file, a folder or a glob. Schemas are given, never
inferred, so no extra pass over the data is made.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyloom.operators.playlog import parse_match_profiles
from tallyloom.sources import schemas

PROFILE_SIZE = 9

# Column that holds a malformed line while it is told apart.
_REFUSED = "_refused_line"


def _delimited(
    spark: SparkSession, path: str, schema: str, sep: str, header: bool, mode: str
) -> DataFrame:
    """Delimited text without quoting; an empty field is null.

    The default mode stops on a malformed line, as a failed number parse should.
    """
    return spark.read.csv(
        path, schema=schema, sep=sep, header=header, quote="", mode=mode
    )


# Delimited layouts by name: schema, separator, whether files begin with a header.
LAYOUTS = {
    "suppliers": (schemas.SUPPLIER, "|", False),
    "nations": (schemas.NATION, "|", False),
    "parts": (schemas.PART, "|", False),
    "play_log": (schemas.PLAY_LOG, ",", True),
    "pairs": (schemas.PAIRS, ",", True),
}


@dataclass(frozen=True)
class Checked:
    """Rows that were read, and the lines that were refused: ``file_name, line``. Together they are all lines."""

    rows: DataFrame
    refused: DataFrame


def read_checked(spark: SparkSession, path: str, layout: str) -> Checked:
    """Read a layout of ``LAYOUTS``, or ``points``, without stopping at malformed lines.

    A line is refused if a number does not parse or it has too few or too many fields; for ``points`` also if it has
    no id or no coordinates. Every column is parsed whichever are used later, so the same lines are refused by every query.
    Blank lines of delimited files are neither rows nor refused, as in the other readers.
    """
    if layout == "points":
        return _checked_points(spark, path)
    schema, sep, header = LAYOUTS[layout]
    found = spark.read.csv(
        path, schema=f"{schema}, {_REFUSED} STRING", sep=sep, header=header, quote="", mode="PERMISSIVE",
        columnNameOfCorruptRecord=_REFUSED,
    )
    # Columns that are not used are not parsed, so all of them are used to tell whether there is a malformed line.
    told = F.concat(F.col(_REFUSED), F.concat_ws("", *[F.col(c).cast("string") for c in found.columns]))
    refused = found.filter(told.isNotNull())
    return Checked(
        found.filter(told.isNull()).drop(_REFUSED),
        refused.select(F.col("_metadata.file_path").alias("file_name"), F.col(_REFUSED).alias("line")),
    )


def _checked_points(spark: SparkSession, path: str) -> Checked:
    fields = F.split(F.trim(F.col("value")), " +")
    parsed = spark.read.text(path).select(
        F.get(fields, F.lit(0)).try_cast("long").alias("id"),
        F.transform(F.slice(fields, F.lit(2), F.greatest(F.size(fields) - 1, F.lit(0))), lambda x: x.try_cast("double")).alias("point"),
        F.col("value").alias("line"),
        F.col("_metadata.file_path").alias("file_name"),
    )
    good = F.col("id").isNotNull() & (F.size("point") > 0) & ~F.exists("point", lambda x: x.isNull())
    return Checked(parsed.filter(good).drop("file_name"), parsed.filter(~good).select("file_name", "line"))


def read_table(spark: SparkSession, path: str) -> DataFrame:
    """Parquet table."""
    return spark.read.parquet(path)


def spread(scan: DataFrame) -> DataFrame:
    """A plain scan, dealt out over all cores if it comes in fewer pieces than that.

    For work that is heavy per row on an input of few, unsplittable files. A
    scan of many pieces is returned as it is, without an exchange.
    """
    cores = scan.sparkSession.sparkContext.defaultParallelism
    return scan.repartition(cores) if scan.rdd.getNumPartitions() < cores else scan


def read_lines(spark: SparkSession, path: str) -> DataFrame:
    """One row per text line: ``line``."""
    return spark.read.text(path).select(F.col("value").alias("line"))


def read_named_lines(spark: SparkSession, path: str) -> DataFrame:
    """One row per text line with its file: ``file_name, line``.

    The name is the path below the folder given, so files of one name in different folders stay apart; for a
    pattern or a single file it is the whole path.
    """
    whole = F.url_decode(F.replace(F.col("_metadata.file_path"), F.lit("+"), F.lit("%2B")))
    folder = "^.*?" + re.escape(path.rstrip("/").split(":", 1)[-1]) + "/"
    return spark.read.text(path).select(
        F.regexp_replace(whole, folder, "").alias("file_name"), F.col("value").alias("line")
    )


def read_key_values(spark: SparkSession, path: str) -> DataFrame:
    """Lines split at their first tab: ``key, value`` (empty value if there is no tab)."""
    parts = F.split("value", "\t", 2)
    return spark.read.text(path).select(
        F.get(parts, F.lit(0)).alias("key"),
        F.coalesce(F.get(parts, F.lit(1)), F.lit("")).alias("value"),
    )


def read_suppliers(spark: SparkSession, path: str, mode: str = "FAILFAST") -> DataFrame:
    """Pipe-delimited supplier table."""
    return _delimited(spark, path, schemas.SUPPLIER, "|", False, mode)


def read_nations(spark: SparkSession, path: str, mode: str = "FAILFAST") -> DataFrame:
    """Pipe-delimited nation table."""
    return _delimited(spark, path, schemas.NATION, "|", False, mode)


def read_parts(spark: SparkSession, path: str, mode: str = "FAILFAST") -> DataFrame:
    """Pipe-delimited part table."""
    return _delimited(spark, path, schemas.PART, "|", False, mode)


def read_play_log(spark: SparkSession, path: str, mode: str = "FAILFAST") -> DataFrame:
    """The 26-column play log; the header is dropped once per file."""
    return _delimited(spark, path, schemas.PLAY_LOG, ",", True, mode)


def read_pairs(spark: SparkSession, path: str, mode: str = "FAILFAST") -> DataFrame:
    """Away and home team pairs to score."""
    return _delimited(spark, path, schemas.PAIRS, ",", True, mode)


def read_points(spark: SparkSession, path: str) -> DataFrame:
    """Lines ``id x1 x2 …``: ``id, point, line`` with the line as it was."""
    fields = F.split(F.trim(F.col("value")), " +")
    return spark.read.text(path).select(
        F.get(fields, F.lit(0)).cast("long").alias("id"),
        F.slice(fields, F.lit(2), F.size(fields) - 1).cast("array<double>").alias("point"),
        F.col("value").alias("line"),
    )


def read_centers(spark: SparkSession, path: str) -> DataFrame:
    """Lines ``id c1,c2,…`` (blank or tab after the id): ``cluster, center``.

    Reads a single file or every file of a folder.
    """
    fields = F.split(F.trim(F.col("value")), "\\s+")
    return spark.read.text(path).select(
        F.get(fields, F.lit(0)).cast("int").alias("cluster"),
        F.split(F.get(fields, F.lit(1)), ",").cast("array<double>").alias("center"),
    )


def read_match_profiles(spark: SparkSession, path: str) -> DataFrame:
    """Lines ``away:score,r0,…,r8;home:score,r0,…,r8`` as typed columns; a number that cannot be read ends the job."""
    return parse_match_profiles(read_lines(spark, path), strict=True)


def read_team_profiles(spark: SparkSession, path: str) -> DataFrame:
    """Lines ``team,r0,…,r8``: ``team, r0 … r8``."""
    schema = "team STRING, " + ", ".join(f"r{i} DOUBLE" for i in range(PROFILE_SIZE))
    return _delimited(spark, path, schema, ",", False, "FAILFAST")

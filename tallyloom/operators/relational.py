"""Supplier and nation join, and key-ordered output."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def distinct_suppliers(suppliers: DataFrame, carried: str = "s_phone") -> DataFrame:
    """One row per nation key and supplier key, the smallest of any duplicates."""
    return (
        suppliers.groupBy("s_nationkey", "s_suppkey")
        .agg(F.min(F.struct("s_name", carried)).alias("kept"))
        .select("s_suppkey", "s_nationkey", "kept.s_name", f"kept.{carried}")
    )


def nation_names(nations: DataFrame) -> DataFrame:
    """One name per nation key, so that a repeated nation never doubles a supplier."""
    return nations.groupBy("n_nationkey").agg(F.min("n_name").alias("n_name"))


def supplier_nation_join(
    suppliers: DataFrame, nations: DataFrame, carried: str = "s_phone"
) -> DataFrame:
    """Suppliers with the name of their nation; suppliers without one are left out.

    No hint is given: Spark broadcasts the nations while they are small by
    measured size, and otherwise joins by key and splits heavy nations.
    """
    kept = distinct_suppliers(suppliers, carried)
    names = nation_names(nations)
    return kept.join(names, kept["s_nationkey"] == names["n_nationkey"], "inner").select(
        "s_suppkey", "s_name", carried, "n_name"
    )


def by_supplier(joined: DataFrame) -> DataFrame:
    """Global order by supplier key."""
    return joined.orderBy("s_suppkey")


def sorted_parts(df: DataFrame, key: str, parts: int = 4) -> DataFrame:
    """Rows ordered by key within ``part_id = key % parts``.

    Both columns form one range-partitioned sort, so the number of parts sets
    the layout but not the number of tasks; a part may span several of them.
    Write it with ``partition_by=["part_id"]`` to get one folder per part.
    """
    return df.withColumn(
        "part_id", F.pmod(F.col(key), F.lit(parts)).cast("int")
    ).orderBy("part_id", key)


def tagged_union(
    suppliers: DataFrame, nations: DataFrame, carried: str = "s_phone"
) -> DataFrame:
    """Both record kinds as one stream, told apart by ``source_table``."""
    return suppliers.select(
        F.lit("supplier").alias("source_table"),
        F.col("s_nationkey").alias("nation_key"),
        F.col("s_suppkey").cast("long").alias("supplier_key"),
        F.col("s_name").alias("supplier_name"),
        F.col(carried).alias(carried),
    ).unionByName(
        nations.select(
            F.lit("nation").alias("source_table"),
            F.col("n_nationkey").alias("nation_key"),
            F.col("n_name").alias("nation_name"),
        ),
        allowMissingColumns=True,
    )


def supplier_line(carried: str = "s_phone") -> Column:
    """A joined row as ``key|name|phone|nation`` text."""
    fields = [
        F.coalesce(F.col(name).cast("string"), F.lit(""))
        for name in ("s_suppkey", "s_name", carried, "n_name")
    ]
    return F.concat_ws("|", *fields)

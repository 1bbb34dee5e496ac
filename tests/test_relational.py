from pyspark.sql import functions as F

from tallyloom.operators import relational as rel

SUPPLIER = "s_suppkey INT, s_name STRING, s_nationkey INT, s_phone STRING"
NATION = "n_nationkey INT, n_name STRING"


def frames(spark):
    suppliers = spark.createDataFrame(
        [(1, "S1", 7, "p1"), (2, "S2", 7, "p2"), (3, "S3", 99, "p3"), (2, "S2", 7, "p2")], SUPPLIER
    )
    nations = spark.createDataFrame([(7, "PERU"), (7, "PERU"), (8, "CHINA")], NATION)
    return suppliers, nations


def test_join_drops_dangling_and_counts_each_supplier_once(spark):
    joined = rel.by_supplier(rel.supplier_nation_join(*frames(spark)))
    assert [tuple(r) for r in joined.collect()] == [(1, "S1", "p1", "PERU"), (2, "S2", "p2", "PERU")]


def test_same_supplier_key_in_two_nations_stays_twice(spark):
    suppliers = spark.createDataFrame([(1, "S", 7, "p"), (1, "S", 8, "p")], SUPPLIER)
    _, nations = frames(spark)
    joined = rel.supplier_nation_join(suppliers, nations)
    assert sorted(r["n_name"] for r in joined.collect()) == ["CHINA", "PERU"]


def test_supplier_without_nation_key(spark):
    suppliers = spark.createDataFrame([(1, "S", None, "p")], SUPPLIER)
    assert rel.supplier_nation_join(suppliers, frames(spark)[1]).count() == 0


def test_line(spark):
    joined = rel.by_supplier(rel.supplier_nation_join(*frames(spark)))
    assert joined.select(rel.supplier_line()).first()[0] == "1|S1|p1|PERU"


def test_parts_are_ordered_and_spread_over_tasks(spark):
    df = rel.sorted_parts(spark.range(200).select(F.col("id").alias("s_suppkey")), "s_suppkey", 4)
    rows = [(r["part_id"], r["s_suppkey"]) for r in df.collect()]
    assert rows == sorted(rows) and len(rows) == 200
    assert all(part == key % 4 for part, key in rows)


def test_tagged_union(spark):
    union = rel.tagged_union(*frames(spark))
    assert union.columns == [
        "source_table", "nation_key", "supplier_key", "supplier_name", "s_phone", "nation_name",
    ]
    assert union.groupBy("source_table").count().orderBy("source_table").collect() == [("nation", 3), ("supplier", 4)]


def test_one_nation_with_most_suppliers(spark):
    suppliers = spark.range(5000).select(
        F.col("id").cast("int").alias("s_suppkey"),
        F.concat(F.lit("S"), "id").alias("s_name"),
        F.when(F.col("id") % 10 < 9, 7).otherwise(8).alias("s_nationkey"),
        F.lit("p").alias("s_phone"),
    )
    nations = frames(spark)[1]
    limit = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    broadcast = rel.supplier_nation_join(suppliers, nations).groupBy("n_name").count().collect()
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        merged = rel.supplier_nation_join(suppliers, nations).groupBy("n_name").count().collect()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)
    assert sorted(broadcast) == sorted(merged) == [("CHINA", 500), ("PERU", 4500)]

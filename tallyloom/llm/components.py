"""Connected components of a graph of links, by alternating star contraction.

Every round hangs the neighbours of a node on its least neighbour, first the
greater ones, then the lesser ones. Only least values are gathered per node, so a
node with very many links needs no more memory than one with few. Rounds are
written to the shared folder, and the loop ends when a round changes nothing.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyloom.operators.lineage import settled


def _state(links: DataFrame) -> tuple:
    row = links.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("a", "b"))).first()
    return tuple(row)


def _large_star(links: DataFrame) -> DataFrame:
    both = links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
    return both.filter("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))


def _small_star(links: DataFrame) -> DataFrame:
    down = links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    least = down.groupBy("a").agg(F.min("b").alias("m"))
    moved = down.join(least, "a").filter("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return least.select("a", F.col("m").alias("b")).unionByName(moved).distinct()


def components(links: DataFrame) -> DataFrame:
    """``node, root`` for every node of ``links`` (columns ``a, b``) that is not itself a root.

    The root is the least node of the component. Links of a node with itself say nothing.
    """
    current = settled(links.select("a", "b").filter("a <> b").distinct())
    state = _state(current)
    while state[0]:
        current = settled(_small_star(_large_star(current)))
        new = _state(current)
        if new == state:
            break
        state = new
    return current.select(F.col("a").alias("node"), F.col("b").alias("root"))

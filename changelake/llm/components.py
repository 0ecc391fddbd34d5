"""Connected components of a table of links, by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from changelake.llm.storage import Scratch


def _state(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("a", "b"))).first())


def _least(pairs: DataFrame) -> DataFrame:
    """Every row with the least ``v`` of its ``u``, at most ``u`` itself; a hub's rows are added up before they move."""
    least = pairs.groupBy(F.col("u").alias("hub")).agg(F.min("v").alias("m"))
    # a key of its own, so that both sides are exchanged and a hub can be split
    joined = pairs.withColumn("__k", F.xxhash64("u")).join(
        least.withColumn("__h", F.xxhash64("hub")), (F.col("__k") == F.col("__h")) & (F.col("u") == F.col("hub"))
    )
    return joined.select("u", "v", F.least("u", "m").alias("m"))


def components(edges: DataFrame) -> DataFrame:
    """``node`` and ``root``, the least node of its component, for all nodes of the links ``a``-``b``.

    Nodes are of any type with an order. The number of rounds grows with the logarithm of the longest path; links are
    written after each. Nulls and loops are ignored.
    """
    edges = edges.where(F.col("a") != F.col("b")).select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()
    tables, n = Scratch(edges.sparkSession, "links"), 0
    edges = tables.written(edges, "0")
    before = _state(edges)
    while before[0]:
        # large star: a node's larger neighbours go to its least one
        both = edges.select(F.col("a").alias("u"), F.col("b").alias("v")).union(edges.select("b", "a"))
        large = _least(both).where(F.col("v") > F.col("u")).select(F.col("v").alias("a"), F.col("m").alias("b")).distinct()
        # small star: a node and its smaller neighbours go to the least of these
        down = _least(large.select(F.col("a").alias("u"), F.col("b").alias("v")))
        small = down.select(F.explode(F.array("u", "v")).alias("a"), F.col("m").alias("b")).where(F.col("a") != F.col("b"))
        edges, n = tables.written(small.distinct(), str(n + 1)), n + 1
        tables.drop(str(n - 1))
        after = _state(edges)
        if after == before:
            break
        before = after
    stars = edges.select(F.col("a").alias("node"), F.col("b").alias("root"))
    return stars.union(edges.select("b", "b").distinct())

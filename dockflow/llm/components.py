"""Connected components of an edge table by alternating stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dockflow.llm.common import cut


#: A hub's edges meet its label in so many tasks.
_SALTS = 16


def _beside_least(table: DataFrame) -> DataFrame:
    """Each (a, b) with the smallest b of its a, m."""
    least = table.groupBy("a").agg(F.min("b").alias("m"))
    least = least.withColumn("salt", F.explode(F.array(*[F.lit(i) for i in range(_SALTS)])))
    salted = table.withColumn("salt", F.pmod(F.xxhash64("b"), F.lit(_SALTS)).cast("int"))
    return salted.join(least, ["a", "salt"]).drop("salt")


def _sum_of(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())


def components(edges: DataFrame) -> DataFrame:
    """(node, component) of every node in ``edges`` (a, b); the component is the
    smallest node that can be reached.

    A round hangs every neighbour of a node on the smallest one: first the
    larger neighbours, then the smaller. The number of rounds grows with the
    logarithm of the longest path. Edges only ever stay or become fewer.
    """
    edges = cut(edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct())
    before = None
    while (now := _sum_of(edges)) != before:
        before = now
        both = edges.union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        large = _beside_least(both).where("b > a").select(F.col("b").alias("a"), F.least("a", "m").alias("b")).distinct()
        small = _beside_least(large)
        small = small.select(F.when(F.col("b") == F.col("m"), F.col("a")).otherwise(F.col("b")).alias("a"), F.col("m").alias("b"))
        edges = cut(small.where("a <> b").distinct())
    nodes = edges.groupBy("a").agg(F.min("b").alias("component")).withColumnRenamed("a", "node")
    return nodes.union(edges.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct())

"""Connected components by alternating large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from headway.llm.common import stage


def _large(edges: DataFrame) -> DataFrame:
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.least("u", F.min("v")).alias("m"))
    return both.filter("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))


def _small(edges: DataFrame) -> DataFrame:
    down = edges.filter("u > v")
    least = down.groupBy("u").agg(F.min("v").alias("m"))
    moved = down.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.unionByName(least.select("u", F.col("m").alias("v")))


def components(edges: DataFrame) -> DataFrame:
    """``node`` and ``root`` (the smallest node of its component) of every node with an edge.

    ``edges`` holds long columns u and v in any direction; loops count for nothing. Each
    round is written to the shared folder, so lineage stays short and a lost executor
    costs a round at most. The number of rounds grows with the logarithm of the size.
    """
    edges = stage(
        edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
        .filter("u <> v")
        .distinct(),
        "components",
    )

    def mark(df: DataFrame) -> tuple:
        return tuple(df.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())

    before = mark(edges)
    while before[0]:
        edges = stage(_small(_large(edges)).filter("u <> v").distinct(), "components")
        after = mark(edges)
        if after == before:
            break
        before = after
    nodes = edges.select(F.col("u").alias("node"), F.col("v").alias("root"))
    roots = edges.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct()
    return nodes.unionByName(roots)

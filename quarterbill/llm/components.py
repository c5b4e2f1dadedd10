"""Connected components of an edge table, by star contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarterbill.llm.common import stage, unstage


def _sum(edges: DataFrame) -> tuple:
    row = edges.agg(
        F.count(F.lit(1)),
        F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")),
    ).first()
    return tuple(row)


def components(edges: DataFrame) -> DataFrame:
    """(node, root) for each node of `edges` (u, v: long); the root is the smallest node.

    Large-star and small-star steps alternate until the edges no longer change. Each step
    is a minimum per node (combined before the shuffle) and a join back, so no node's
    neighbours are gathered; each round is staged, so that lineage stays short. Self loops
    and repeated edges are fine; an empty table gives an empty table.
    """
    now = stage(
        edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
        .where("u != v")
        .distinct(),
        "edges",
    )
    before = None
    while (state := _sum(now)) != before:
        before = state
        both = now.unionByName(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
        large = (
            both.join(least, "u")
            .where("v > u")
            .select(F.col("v").alias("u"), F.col("m").alias("v"))
            .distinct()
        )
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = (
            large.join(least, "u")
            .select(F.explode(F.array(F.struct("u", F.col("m").alias("v")), F.struct(F.col("v").alias("u"), F.col("m").alias("v")))).alias("e"))
            .select("e.u", "e.v")
            .where("u != v")
            .distinct()
        )
        then = stage(small, "edges")
        unstage(now)
        now = then
    return now.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(
        now.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct()
    )

"""Connected components of a table of links, by alternating large-star and small-star steps.

Each step is a grouping by node (its least neighbour, pre-aggregated) joined back to the links; no node's neighbours are
gathered, and nothing goes to the driver but two numbers a round.  Rounds are written to the shared folder, so lineage
stays short and a lost executor costs one round's tasks.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import written


def _state(links: DataFrame) -> tuple:
    return tuple(links.agg(F.count("*"), F.coalesce(F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")), F.lit(0))).first())


def _large_star(links: DataFrame) -> DataFrame:
    both = links.unionAll(links.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
    return both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct()


def _small_star(links: DataFrame) -> DataFrame:
    down = links.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    least = down.groupBy("u").agg(F.min("v").alias("m"))
    joined = down.join(least, "u")
    return joined.select(F.col("v").alias("u"), F.col("m").alias("v")).unionAll(least.select("u", F.col("m").alias("v"))).where("u <> v").distinct()


def components(links: DataFrame) -> DataFrame:
    """``(node, component)`` for every node of the links ``(a, b)``; the component is its least node."""
    edges = written(links.select(F.col("a").alias("u"), F.col("b").alias("v")).where("u IS NOT NULL AND v IS NOT NULL"))
    nodes = written(edges.select(F.col("u").alias("node")).unionAll(edges.select("v")).distinct())
    edges = written(edges.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct())
    before = _state(edges)
    while before[0]:
        edges = written(_small_star(_large_star(edges)))
        now = _state(edges)
        if now == before:
            break
        before = now
    roots = edges.groupBy("u").agg(F.min("v").alias("v"))
    return nodes.join(roots, F.col("node") == F.col("u"), "left").select("node", F.coalesce("v", "node").alias("component"))

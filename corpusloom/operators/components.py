"""Connected components of an edge table by alternating star contractions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusloom.operators.joins import join_groups
from corpusloom.session import cut_lineage


def _both_ways(edges: DataFrame) -> DataFrame:
    return edges.select("u", "v").unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))


def _least(edges: DataFrame) -> DataFrame:
    return edges.groupBy("u").agg(F.min("v").alias("m"), F.count(F.lit(1)).alias("n"))


def _large_star(edges: DataFrame, total: int) -> DataFrame:
    """Larger neighbours of each node point to the least of its neighbourhood."""
    near = _both_ways(edges)
    least = _least(near).select("u", F.least("u", "m").alias("m"), "n")
    return join_groups(near, least, ["u"], 2 * total, look=False).filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).filter("u <> v").distinct()


def _small_star(edges: DataFrame, total: int) -> DataFrame:
    """A node and its smaller neighbours point to the least of them."""
    down = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    least = _least(down)
    moved = join_groups(down, least, ["u"], total, look=False).select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(least.select("u", F.col("m").alias("v")))
    return moved.filter("u <> v").distinct()


def connected_components(edges: DataFrame, nodes: DataFrame | None = None) -> DataFrame:
    """``node`` and ``component`` (its least node) from edges in the first two columns.

    Null ends and loops tie nothing; repeated edges count once. Nodes of ``nodes`` (first column)
    without an edge form components of their own. Each round is a few joins on single nodes, the
    edges of hubs are not shuffled to one task, the number of rounds is logarithmic in the
    longest path, and lineage is cut after each.
    """
    a, b = edges.columns[:2]
    now = edges.select(F.col(a).alias("u"), F.col(b).alias("v")).filter("u IS NOT NULL AND v IS NOT NULL AND u <> v").distinct()
    mark = lambda df: df.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
    now = cut_lineage(now)
    before = mark(now)
    while before[0]:
        now = cut_lineage(_small_star(_large_star(now, before[0]), before[0]))
        after = mark(now)
        if after == before:
            break
        before = after
    tied = now.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(now.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct())
    if nodes is None:
        return tied
    every = nodes.select(F.col(nodes.columns[0]).alias("node")).filter("node IS NOT NULL").distinct()
    return every.unionByName(tied.select("node")).distinct().join(tied, "node", "left").select("node", F.coalesce("component", "node").alias("component"))

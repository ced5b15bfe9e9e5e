"""Connected components of a graph by alternating large and small stars.

Every round is two aggregations and two joins of the edges; a vertex with very
many edges is never held in one task, since its smallest neighbour is found by
partial aggregation and its edges are matched by a join that Spark may split.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .shared import cut, drop


def _star(edges: DataFrame, large: bool) -> DataFrame:
    """edges (u, v). large: each vertex links its larger neighbours to the smallest vertex around it; else its smaller ones and itself."""
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v"))) if large else edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    low = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
    joined = both.join(low, "u")
    if large:
        out = joined.where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    else:
        out = joined.select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(low.select("u", F.col("m").alias("v")))
    return out.where("u <> v").distinct()


def connected_components(edges: DataFrame) -> DataFrame:
    """(id, component) of each vertex that has an edge; component: the smallest id that can be reached. edges: columns a, b of one type; null ends and loops are ignored."""
    now = cut(edges.where("a is not null and b is not null and a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(), "edges")
    before = None
    while True:
        mark = now.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if mark == before or not mark[0]:
            return now.select(F.col("u").alias("id"), F.col("v").alias("component")).unionByName(now.select(F.col("v").alias("id"), F.col("v").alias("component"))).distinct()
        before = mark
        new = cut(_star(_star(now, True), False), "edges")
        drop(now)
        now = new

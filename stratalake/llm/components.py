"""Connected components of a graph given as a table of edges."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stratalake.session import staged


def _star(edges: DataFrame, keep: str) -> DataFrame:
    """Link the neighbours that ``keep`` selects, and the node itself, to the least of both."""
    least = edges.groupBy("u").agg(F.min("v").alias("m"))
    least = least.withColumn("m", F.least("u", "m"))
    return edges.join(least, "u").where(keep).select(F.col("v").alias("u"), F.col("m").alias("v"))


def _state(edges: DataFrame):
    return edges.agg(
        F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(20,0)"))
    ).first()


def connected_components(edges: DataFrame) -> DataFrame:
    """``edges`` (a, b) to rows (node, component): the least node reachable from each.

    Alternates large-star and small-star steps, which takes a number of rounds that grows with the
    logarithm of the nodes. Per node only the least neighbour is aggregated, so a hub's
    neighbours never meet in one task. Every round is written to the shared folder.
    """
    now = edges.select(F.col("a").alias("u"), F.col("b").alias("v")).where("u != v").distinct()
    now = staged(now, "components")
    before = None
    while (state := _state(now)) != before:
        before = state
        both = now.unionByName(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        large = staged(_star(both, "v > u").where("u != v").distinct(), "components")
        down = large.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
        least = down.groupBy("u").agg(F.min("v").alias("m"))
        small = _star(down, "v != m").unionByName(least.select("u", F.col("m").alias("v")))
        now = staged(small.where("u != v").distinct(), "components")
    stars = now.select(F.col("u").alias("node"), F.col("v").alias("component"))
    roots = now.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    return stars.unionByName(roots)

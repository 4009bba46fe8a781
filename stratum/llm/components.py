"""Connected components of an edge table by alternating large-star and small-star rounds."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .store import store, unstore


def _is_star(edges: DataFrame) -> bool:
    """Whether every node has one link to a root that itself has none upwards."""
    ends = edges.select(F.col("u").alias("x"), F.lit(1).alias("up")).unionAll(
        edges.select(F.col("v").alias("x"), F.lit(0).alias("up")))
    return ends.groupBy("x").agg(F.sum("up").alias("ups"), F.min("up").alias("low")) \
        .where("ups > 1 OR (ups = 1 AND low = 0)").isEmpty()


def components(edges: DataFrame) -> tuple[DataFrame, str]:
    """(node, component) for every node of ``edges(u, v)``; component is the smallest node reachable.

    Each round only groups and joins on one endpoint; no neighbour list is
    ever collected, so a node with many links stays a partial aggregate and a
    join key that can be split.  Rounds are written tables.  Returns the table
    and its path; no edges give no rows.
    """
    spark = edges.sparkSession
    now, path = store(
        edges.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(), "cc")
    while not _is_star(now):
        both = now.unionAll(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.join(low, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = large.where("u <> v")
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u")
        small = small.where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v")).unionAll(
            least.select("u", F.col("m").alias("v"))).distinct()
        new, new_path = store(small, "cc")
        unstore(spark, path)
        now, path = new, new_path
    nodes = now.select(F.col("u").alias("node"), F.col("v").alias("component")).unionAll(
        now.select(F.col("v").alias("node"), F.col("v").alias("component"))).distinct()
    out, out_path = store(nodes, "components")
    unstore(spark, path)
    return out, out_path

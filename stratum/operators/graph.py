"""Graph patterns over a ``triples(s, p, o)`` DataFrame.

``closure`` is the property path ``p*`` (zero or more steps) by path doubling:
round k joins what is reached so far to the pairs that lie exactly 2^k steps
apart, then joins these pairs to themselves for the next round.  So a
hierarchy of depth d takes about log2(d) rounds instead of d.  Pairs seen
before are dropped (left anti join), so cycles end.  Every round is written to the shared
folder, which cuts the lineage (a lost executor re-reads it instead of
replaying all rounds), and the step pairs of the round before are deleted.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import discard, stored


def edges(triples: DataFrame, predicate: str) -> DataFrame:
    return triples.where(F.col("p") == predicate).select("s", "o").distinct()


def closure(edge: DataFrame, start: DataFrame | None = None) -> DataFrame:
    """All (node, anc) pairs reachable by zero or more ``edge`` steps.

    ``start`` (a one-column DataFrame ``node``) limits the sources; by
    default every node that appears as a subject.  Zero-step pairs
    (node, node) are included, as in a ``*`` property path.

    After round k all walks of up to 2^(k+1) - 1 steps are covered: their lengths are sums of the powers used so far.  A round
    that finds nothing new is the last, since the nodes at the next distances would be missing as well.  Rounds run
    when this is called.  The step pairs of round k are at most one for each node and each of its ancestors 2^k steps away.
    """
    spark = edge.sparkSession
    nodes = (start if start is not None else edge.select(F.col("s").alias("node"))).distinct()
    seen = stored(nodes.select("node", F.col("node").alias("anc")), "closure")[0]
    step, step_path = stored(edge.select(F.col("s").alias("_s"), F.col("o").alias("_o")).distinct(), "closure-steps")
    while True:      # ends by itself: every round finds new pairs or is the last
        further = seen.join(step, seen["anc"] == step["_s"]).select("node", F.col("_o").alias("anc")).distinct()
        fresh, fresh_path = stored(further.join(seen, ["node", "anc"], "left_anti"), "closure")
        if fresh.isEmpty():
            discard(spark, fresh_path)
            discard(spark, step_path)
            return seen
        seen = seen.unionByName(fresh)
        onward = step.select(F.col("_s").alias("_m"), F.col("_o").alias("_e"))
        double, double_path = stored(step.join(onward, step["_o"] == onward["_m"]).select("_s", F.col("_e").alias("_o")).distinct(),
                                     "closure-steps")
        discard(spark, step_path)
        step, step_path = double, double_path


def path_then_star(triples: DataFrame, first: str, star: str) -> DataFrame:
    """``?x first/star* ?y``: one ``first`` step, then zero or more ``star`` steps."""
    one = edges(triples, first)
    classes = one.select(F.col("o").alias("node")).distinct()
    up = closure(edges(triples, star), start=classes)
    return (one.join(up, one["o"] == up["node"])
            .select(F.col("s").alias("entity"), F.col("anc").alias("class")).distinct())


def instances_below(triples: DataFrame, first: str, star: str, target: str) -> DataFrame:
    """``?x first/star* target`` as (entity): the walk starts at the target.

    Only the target's own descendants are followed, backwards along ``star``;
    the entities then need one semi join, so no entity-to-ancestor pairs are
    made.
    """
    spark = triples.sparkSession
    up = edges(triples, star).select(F.col("o").alias("s"), F.col("s").alias("o"))
    start = spark.createDataFrame([(target,)], "node string")
    classes = closure(up, start=start).select(F.col("anc").alias("o")).distinct()
    return edges(triples, first).join(classes, "o", "left_semi").select(F.col("s").alias("entity")).distinct()

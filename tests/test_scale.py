"""Plan-level checks of the properties the scale design relies on."""

import contextlib
import io

from pyspark.sql import functions as F

from stratum.operators.ordering import assign_dense_keys, best_per_key
from stratum.operators.quantile import agg_with_median, exact_median
from stratum.operators.stats import variance_decomposition


def plan(df) -> str:
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain(mode="extended")
    return buf.getvalue()


def hot_frame(spark, n=30000):
    # one key holds a third of all rows
    return spark.range(n).select(
        F.when(F.col("id") % 3 == 0, F.lit("hot")).otherwise((F.col("id") % 97).cast("string")).alias("g"),
        (F.col("id") * 7 % 1009).cast("double").alias("v"),
        F.col("id").alias("u"))


def test_variance_decomposition_has_no_pairing_join(spark):
    df = hot_frame(spark).withColumn("f2", F.col("u") % 5)
    p = plan(variance_decomposition(df, "v", ["g", "f2"]))
    assert "CartesianProduct" not in p and "BroadcastNestedLoopJoin" not in p


def test_best_per_key_combines_before_the_shuffle(spark):
    p = plan(best_per_key(hot_frame(spark), "g", "v", tiebreak=["u"]))
    phys = p.split("== Physical Plan ==")[1]
    assert "partial_min" in phys


def test_distributed_median_holds_no_percentile_buffer(spark):
    df = hot_frame(spark)
    out = agg_with_median(df, ["g"], [F.count(F.lit(1)).alias("n")], "v", "m")
    p = plan(out)
    phys = p.split("== Physical Plan ==")[1]
    assert "percentile(" not in phys and "median(" not in phys
    got = {r.g: r.m for r in out.collect()}
    want = {r.g: r.m for r in df.groupBy("g").agg(F.median("v").alias("m")).collect()}
    assert got == want


def test_hot_group_median_and_keys_correct(spark):
    df = hot_frame(spark)
    hot = exact_median(df.where(F.col("g") == "hot"), [], "v", "m").first().m
    assert hot == df.where(F.col("g") == "hot").agg(F.median("v")).first()[0]
    keyed = assign_dense_keys(df, ["g", "u"], key="k", partitions=8)
    assert keyed.agg(F.countDistinct("k"), F.min("k"), F.max("k")).first() == (30000, 1, 30000)

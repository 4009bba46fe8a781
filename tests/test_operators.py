"""Distributed operators against their single-task / brute-force definitions."""

import math

from pyspark.sql import Window
from pyspark.sql import functions as F

from stratum.operators.ordering import assign_dense_keys, best_per_key
from stratum.operators.quantile import agg_with_median, exact_median
from stratum.operators.stats import guarded_corr, variance_decomposition

from conftest import SF01


def test_dense_keys_equal_global_row_number(spark):
    part = spark.read.parquet(f"{SF01}/part.parquet").select("p_partkey", "p_name", "p_type")
    got = assign_dense_keys(part, ["p_name", "p_type"], key="k", partitions=5)
    want = part.withColumn("k", F.row_number().over(
        Window.orderBy("p_name", "p_type", "p_partkey")).cast("bigint"))
    assert got.select("k", "p_partkey").exceptAll(want.select("k", "p_partkey")).count() == 0
    keys = [r[0] for r in got.select("k").collect()]
    assert sorted(keys) == list(range(1, part.count() + 1))


def test_best_per_key_null_ranks_last(spark):
    df = spark.createDataFrame(
        [("a", None, "x1"), ("a", 5.0, "x2"), ("a", 3.0, "x3"), ("b", None, "y1"), ("b", None, "y0"),
         ("c", 2.0, "z9"), ("c", 2.0, "z1")], "k string, r double, label string")
    got = {r.k: (r.r, r.label) for r in best_per_key(df, "k", "r", tiebreak=["label"]).collect()}
    assert got == {"a": (3.0, "x3"), "b": (None, "y0"), "c": (2.0, "z1")}


def test_exact_median_matches_builtin_with_hot_group(spark):
    rows = [("hot", float(i % 997)) for i in range(30000)]          # one dominant group
    rows += [("even", v) for v in (1.0, 2.0, 10.0, 20.0)]
    rows += [("odd", v) for v in (5.0, 1.0, 3.0)]
    rows += [("dups", 7.0)] * 5 + [("nulls", None), ("nulls", 4.0), ("nulls", 8.0)]
    rows += [(None, 1.0), (None, 3.0)]
    df = spark.createDataFrame(rows, "g string, v double")
    got = {r.g: r.m for r in exact_median(df, ["g"], "v", "m").collect()}
    want = {r.g: r.m for r in df.groupBy("g").agg(F.median("v").alias("m")).collect()}
    assert got.keys() == want.keys()
    for k in want:
        assert math.isclose(got[k], want[k], rel_tol=1e-12), k


def test_agg_with_median_matches_builtin(spark):
    df = spark.range(0, 5000).select((F.col("id") % 3).alias("g"), (F.col("id") * 1.5).alias("v"))
    aggs = [F.count(F.lit(1)).alias("n"), F.count_distinct("v").alias("d")]
    got = agg_with_median(df, ["g"], aggs, "v", "med").collect()
    want = df.groupBy("g").agg(*aggs, F.median("v").alias("med")).collect()
    assert sorted(tuple(x) for x in got) == sorted(tuple(x) for x in want)


def test_best_per_key_null_tiebreak_last(spark):
    df = spark.createDataFrame([("a", 1.0, None), ("a", 1.0, "z")], "k string, r double, label string")
    assert [tuple(x) for x in best_per_key(df, "k", "r", tiebreak=["label"]).collect()] == [("a", 1.0, "z")]


def test_ungrouped_median(spark):
    df = spark.range(0, 1001).select((F.col("id") * 2.0).alias("v"))
    assert exact_median(df, [], "v", "m").first().m == 1000.0


def test_guarded_corr_zero_variance_is_null(spark):
    df = spark.createDataFrame([(1.0, 2.0), (1.0, 3.0), (1.0, None)], "x double, y double")
    assert df.agg(guarded_corr("x", "y")).first()[0] is None
    df2 = spark.createDataFrame([(1.0, 2.0), (2.0, 4.1), (3.0, 5.9), (None, 1.0)], "x double, y double")
    import numpy as np
    want = np.corrcoef([1, 2, 3], [2.0, 4.1, 5.9])[0, 1]
    assert math.isclose(df2.agg(guarded_corr("x", "y")).first()[0], want, rel_tol=1e-9)


def test_variance_decomposition_brute_force(spark):
    import random
    rnd = random.Random(3)
    rows = [(rnd.choice("abc"), rnd.choice(["x", "y", None]), rnd.gauss(10, 2)) for _ in range(500)]
    df = spark.createDataFrame(rows, "f1 string, f2 string, v double")
    got = {r.factor_name: r for r in variance_decomposition(df, "v", ["f1", "f2"]).collect()}
    vals = [r[2] for r in rows]
    mu = sum(vals) / len(vals)
    total = sum((v - mu) ** 2 for v in vals)
    for i, name in ((0, "f1"), (1, "f2")):
        groups = {}
        for r in rows:
            if r[i] is not None:
                groups.setdefault(r[i], []).append(r[2])
        between = sum(len(g) * (sum(g) / len(g) - mu) ** 2 for g in groups.values())
        assert got[name].group_count == len(groups)
        assert got[name].observation_count == sum(len(g) for g in groups.values())
        assert math.isclose(got[name].total_sum_squares, total, rel_tol=1e-9)
        assert math.isclose(got[name].between_group_sum_squares, between, rel_tol=1e-9)


def test_median_of_skewed_and_tied_values(spark):
    import random
    rnd = random.Random(5)
    rows = [(g, float(rnd.choice([rnd.randrange(5), rnd.gauss(0, 1e6)]))) for g in range(4) for _ in range(rnd.choice([1, 2, 7, 9001]))]
    df = spark.createDataFrame(rows, "g int, v double").repartition(5)
    got = {r.g: r.m for r in exact_median(df, ["g"], "v", "m").collect()}
    assert got == {r.g: r.m for r in df.groupBy("g").agg(F.median("v").alias("m")).collect()}


def test_reserved_names_are_rejected(spark):
    import pytest
    df = spark.createDataFrame([(1, 2.0)], "_v int, v double")
    with pytest.raises(ValueError):
        exact_median(df, ["_v"], "v")
    with pytest.raises(ValueError):
        best_per_key(spark.createDataFrame([(1, 2.0)], "_rank int, r double"), "_rank", "r")

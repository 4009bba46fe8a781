"""The exact median's rounds: small tables at every step, exact results for hot, tied, null and tiny groups."""

import random

import pytest
from pyspark.sql import functions as F

from stratum.operators import quantile


def expected(df, keys):
    return {tuple(r[k] for k in keys): r.m for r in df.groupBy(*keys).agg(F.median("v").alias("m")).collect() if r.m is not None}


@pytest.fixture(scope="module")
def values(spark):
    rng = random.Random(3)
    rows = [("hot", rng.gauss(0, 1e6)) for _ in range(30000)]                    # nearly all rows in one group
    rows += [("ties", float(rng.choice([1, 2, 2, 2, 3]))) for _ in range(4000)] + [("two", 1.0), ("two", 4.0), ("one", 7.5)]
    rows += [("null", None), (None, 3.0), (None, 9.0), (None, 4.0), ("edge", float("inf")), ("edge", 1.0), ("edge", float("-inf"))]
    rows += [("heavy", 5.0)] * 9000 + [("heavy", rng.uniform(0, 10)) for _ in range(8000)]
    return spark.createDataFrame(rows, "g string, v double").repartition(7)


@pytest.mark.parametrize("limit,splits,margin", [(4096, 64, 0.001), (16, 4, 0.3), (4, 64, 0.49), (50, 2, 0.1)])
def test_rounds_give_the_exact_median(spark, values, monkeypatch, limit, splits, margin):
    for name, x in (("LIMIT", limit), ("SPLITS", splits), ("MARGIN", margin)):
        monkeypatch.setattr(quantile, name, x)
    got = {(r.g,): r.m for r in quantile.exact_median(values, ["g"], "v", "m").collect()}
    assert got == expected(values, ["g"])
    assert quantile.exact_median(values, [], "v", "m").first().m == values.agg(F.median("v")).first()[0]


def test_one_group_of_all_rows_never_meets_in_one_task(spark, monkeypatch):
    monkeypatch.setattr(quantile, "LIMIT", 200)
    monkeypatch.setattr(quantile, "MARGIN", 0.25)
    n = 200_000
    df = spark.range(n).select(F.lit("all").alias("g"), (F.xxhash64("id") % 10**9).cast("double").alias("v"))
    rounds, keep = [], quantile.stored

    def watched(frame, name):
        table, path = keep(frame, name)
        if name == "median":
            # rows of the largest task that wrote this round: its largest file
            sizes = [r[0] for r in table.groupBy(F.input_file_name()).count().select("count").collect()]
            rounds.append((sum(sizes), max(sizes)))
        return table, path

    monkeypatch.setattr(quantile, "stored", watched)
    monkeypatch.setattr(quantile, "discard", lambda *_: None)
    before = spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        got = quantile.exact_median(df, ["g"], "v", "m").first().m
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", before)
    assert got == df.agg(F.median("v")).first()[0]
    assert len(rounds) >= 3 and rounds[-1][0] <= 201                      # the only rows that one task sorts
    assert all(largest <= max(total / 4, 201) for total, largest in rounds)  # eight tasks share every other round


def test_aggregates_beside_the_median_and_no_scratch_left(spark, values, tmp_path):
    import os

    from stratum.session import shared_dir
    base = shared_dir(spark).removeprefix("file:")
    before = set(os.listdir(base))
    out = quantile.agg_with_median(values, ["g"], [F.count(F.lit(1)).alias("n"), F.sum("v").alias("s")], "v", "m", store=True)
    got = {r.g: (r.n, r.m) for r in out.collect()}
    want = {r.g: (r.n, r.m) for r in values.groupBy("g").agg(F.count(F.lit(1)).alias("n"), F.median("v").alias("m")).collect()}
    assert got == want and got["null"] == (1, None)
    # the result reads one row a group and the last round; inputs and earlier rounds are gone
    assert len(set(os.listdir(base)) - before) == 2


def test_median_of_nothing(spark):
    none = spark.createDataFrame([], "g string, v double")
    assert quantile.exact_median(none, ["g"], "v").count() == 0
    assert quantile.agg_with_median(none, ["g"], [F.count(F.lit(1)).alias("n")], "v").count() == 0

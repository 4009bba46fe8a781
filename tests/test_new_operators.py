"""Skewed joins, bitmap counts, path doubling, alias tables, checked writes, bucketed tables: results against plain Spark or brute force."""

import os
import random
import statistics

import pytest
from pyspark.sql import functions as F

from stratum.operators import aliases, checks, distinct, graph, skew
from stratum.operators.skew import spread_join


@pytest.fixture
def plain_shuffles(spark):
    """No adaptive help and no broadcast: what the plan itself does."""
    conf = {"spark.sql.adaptive.enabled": "false", "spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.shuffle.partitions": "16"}
    before = {k: spark.conf.get(k) for k in conf}
    for k, v in conf.items():
        spark.conf.set(k, v)
    yield
    for k, v in before.items():
        spark.conf.set(k, v)


def rows_per_task(df):
    return [r[1] for r in df.groupBy(F.spark_partition_id()).count().collect()]


def test_half_of_all_rows_under_one_key_is_dealt_over_the_tasks(spark, plain_shuffles):
    n = 40_000
    left = spark.range(n).select("id", F.when(F.col("id") % 2 == 0, "Unknown Founder").otherwise(F.concat(F.lit("f"), (F.col("id") % 5000))).alias("k"))
    right = spark.range(5000).select(F.concat(F.lit("f"), "id").alias("k"), F.col("id").alias("r")).unionByName(
        spark.range(3).select(F.lit("Unknown Founder").alias("k"), (F.col("id") + 9000).alias("r")))
    plain, spread = left.join(right, "k"), spread_join(left, right, "k")
    assert max(rows_per_task(plain)) > 0.5 * plain.count()
    tasks = rows_per_task(spread)
    assert len(tasks) == 16 and max(tasks) < 1.6 * statistics.median(tasks)
    key = lambda df: sorted(map(tuple, df.select("id", "k", "r").collect()))
    assert key(spread) == key(plain)


def test_spread_join_equals_the_plain_join(spark):
    rng = random.Random(2)
    pick = lambda: rng.choice([None, None, 0, 0, 0, 1, rng.randint(2, 30)])
    left = spark.createDataFrame([(pick(), k, "x") for k in range(800)] + [(0, 1, "x")] * 40, "k int, a int, t string")
    right = spark.createDataFrame([(pick(), -k, "y") for k in range(300)], "k int, b int, u string")
    both = lambda df: sorted(map(tuple, df.select("k", "a", "t", "b", "u").collect()), key=repr)
    for how in ("inner", "left"):
        for share in (1 / 256, 1 / 8, 1.0):
            assert both(spread_join(left, right, "k", how, share)) == both(left.join(right, "k", how))
    none = left.where("false")
    assert spread_join(none, right, "k").count() == 0 and spread_join(left, right.where("false"), "k", "left").count() == left.count()
    hot = skew.hot_keys(left, "k", 1 / 8)
    assert None in hot and 0 in hot and hot[0] >= 3 and len(hot) <= 8
    with pytest.raises(ValueError):
        spread_join(left.withColumnRenamed("a", "_i"), right, "k")
    with pytest.raises(ValueError):
        spread_join(left, right, "k", "outer")


def test_bitmap_counts_equal_count_distinct(spark):
    df = spark.range(30_000).select((F.col("id") % 3).alias("g"), F.when(F.col("id") % 7 > 0, F.lit("a")).alias("h"),
                                    (F.xxhash64("id") % 90_000 + 90_000).alias("x"), (F.col("id") % 11).cast("int").alias("y"),
                                    F.when(F.col("id") % 3 > 0, F.col("id")).alias("z"))
    got = distinct.distinct_counts(df, ["g", "h"], {"nx": "x", "ny": "y", "nz": "z"})
    want = df.groupBy("g", "h").agg(*[F.count_distinct(c).alias(a) for a, c in (("nx", "x"), ("ny", "y"), ("nz", "z"))])
    assert sorted(map(tuple, got.collect()), key=repr) == sorted(map(tuple, want.collect()), key=repr)
    assert tuple(distinct.distinct_counts(df, [], {"nx": "x", "nz": "z"}).first()) == tuple(df.agg(F.count_distinct("x"), F.count_distinct("z")).first())
    assert tuple(distinct.distinct_counts(df.where("false"), [], {"nx": "x"}).first()) == (0,)
    assert "Expand" not in got._jdf.queryExecution().toString()
    # bitmaps of parts are put together
    parts = distinct.key_bitmaps(df.where("id % 2 = 0" if "id" in df.columns else "y % 2 = 0"), ["g"], "x").unionByName(
        distinct.key_bitmaps(df.where("y % 2 = 1"), ["g"], "x"))
    whole = distinct.counted(distinct.merged(parts, ["g"]), ["g"], "n")
    assert {r.g: r.n for r in whole.collect()} == {r.g: r.n for r in df.groupBy("g").agg(F.count_distinct("x").alias("n")).collect()}


def test_negative_and_zero_keys_in_bitmaps(spark):
    df = spark.createDataFrame([(x,) for x in (-40000, -1, 0, 0, 1, 32768, 32769, 70000, None)], "x long")
    assert distinct.distinct_counts(df, [], {"n": "x"}).first().n == 7


def brute_closure(edges, starts):
    out = set()
    for start in starts:
        seen, todo = {start}, [start]
        while todo:
            x = todo.pop()
            for a, b in edges:
                if a == x and b not in seen:
                    seen.add(b)
                    todo.append(b)
        out |= {(start, y) for y in seen}
    return out


def test_a_chain_of_a_thousand_nodes_ends_in_few_rounds(spark, monkeypatch):
    edge = spark.range(1000).select(F.col("id").cast("string").alias("s"), (F.col("id") + 1).cast("string").alias("o"))
    rounds, keep = [], graph.stored

    def counted(df, name):
        rounds.append(name)
        return keep(df, name)

    monkeypatch.setattr(graph, "stored", counted)
    start = spark.createDataFrame([("0",)], "node string")
    assert graph.closure(edge, start).count() == 1001
    assert rounds.count("closure") - 1 <= 12


def test_cycles_and_diamonds(spark):
    edges = [("a", "b"), ("a", "c"), ("b", "d"), ("c", "d"), ("d", "e"), ("e", "b"), ("x", "x"), ("p", "q"), ("q", "r"), ("r", "s"), ("s", "p")]
    rng = random.Random(4)
    edges += [(f"n{rng.randrange(25)}", f"n{rng.randrange(25)}") for _ in range(40)]
    df = spark.createDataFrame(edges + edges[:3], "s string, o string")
    got = sorted(map(tuple, graph.closure(df).collect()))
    assert got == sorted(brute_closure(edges, {a for a, _ in edges}))
    some = spark.createDataFrame([("a",), ("lonely",), ("a",)], "node string")
    assert sorted(map(tuple, graph.closure(df, some).collect())) == sorted(brute_closure(edges, {"a", "lonely"}))


def test_alias_chains_cycles_and_contradictions(spark):
    make = lambda rows: spark.createDataFrame(rows, "alias string, name string")
    chain = [(f"a{k}", f"a{k + 1}") for k in range(100)] + [("b", "a50"), ("same", "same"), (None, "x"), ("y", None), ("b", "a50")]
    got = {r.alias: r.name for r in aliases.resolve_aliases(make(chain)).collect()}
    assert got == {**{f"a{k}": "a100" for k in range(100)}, "b": "a100"}
    for bad in ([("a", "b"), ("b", "c"), ("c", "a")], [("a", "b"), ("b", "a"), ("q", "a")], chain + [("a100", "a3")]):
        with pytest.raises(ValueError, match="cycle"):
            aliases.resolve_aliases(make(bad))
    with pytest.raises(ValueError, match="more than one"):
        aliases.resolve_aliases(make([("a", "b"), ("a", "c")]))
    table = aliases.resolve_aliases(make(chain))
    df = spark.createDataFrame([(1, "a7"), (2, "none"), (3, None)], "k int, who string")
    assert {r.k: r.who for r in aliases.with_final_names(df, "who", table).collect()} == {1: "a100", 2: "none", 3: None}
    assert aliases.resolve_aliases(make([])).count() == 0


def test_a_hundred_thousand_aliases_make_one_join(spark):
    from stratum.plans import silver
    big = spark.range(100_000).select(F.concat(F.lit("university of old "), "id").alias("alias"), F.concat(F.lit("university of new "), F.expr("id div 2")).alias("name"))
    table = aliases.resolve_aliases(big)
    profiles = spark.createDataFrame([("Acme", "Ann", "University of OLD 7", "BA"), ("Acme", "Bob", "University of new 3", "BA"), ("Acme", "Cy", "Elsewhere", "BA")],
                                     "companyLabel string, executiveLabel string, universityLabel string, degreeLabel string")
    rankings = spark.createDataFrame([("University of Old 6", "=12")], "`Institution Name` string, `QS Rank` string")
    out = silver.executive_profiles(profiles, rankings, table)
    assert {r.executiveLabel: r.QS_Rank_Num for r in out.collect()} == {"Ann": 12.0, "Bob": 12.0, "Cy": None}
    assert out._jdf.queryExecution().optimizedPlan().toString().count("regexp_replace") < 40


def test_checked_write_counts_and_refuses(spark, tmp_path):
    path = str(tmp_path / "t")
    good = spark.range(10).select("id", F.col("id").cast("string").alias("name"))
    assert checks.checked_write(good, path, checks.row_metrics(["id", "name"])) == {"rows": 10, "null_id": 0, "null_name": 0}
    bad = spark.range(20).select(F.when(F.col("id") > 2, F.col("id")).alias("id"), F.lit("x").alias("name"))
    with pytest.raises(checks.CheckFailed, match="null_id = 3") as failed:
        checks.checked_write(bad, path, checks.row_metrics(["id", "name"]))
    assert failed.value.metrics["rows"] == 20 and failed.value.broken == ["null_id"]
    assert spark.read.parquet(path).count() == 10 and os.listdir(tmp_path) == ["t"]
    assert checks.checked_write(bad, path, checks.row_metrics(["id"]), zero=[])["null_id"] == 3
    assert spark.read.parquet(path).count() == 20


def test_gold_write_fails_when_a_company_is_lost(spark, tmp_path, monkeypatch):
    from conftest import SF001
    from stratum.plans import catalog, gold
    startups, execs = catalog._gold_inputs(spark, SF001)
    metrics = gold.write_gold(startups, execs, str(tmp_path / "gold"))
    fact = spark.read.parquet(str(tmp_path / "gold/fact_valuation_grit"))
    assert metrics["fact_valuation_grit"] == {"rows": fact.count(), "null_company_key": 0, "null_executive_key": 0}
    assert metrics["dim_company"]["rows"] == startups.select("Company").distinct().count()
    lost = gold.explode_founders
    monkeypatch.setattr(gold, "explode_founders", lambda s: lost(s).where("NOT company_name LIKE '%7'"))
    with pytest.raises(checks.CheckFailed, match="null_executive_key"):
        gold.write_gold(startups, execs, str(tmp_path / "gold"))
    assert spark.read.parquet(str(tmp_path / "gold/fact_valuation_grit")).count() == fact.count()


def test_star_joins_on_bucketed_tables_do_not_shuffle_the_fact(spark, tmp_path, plain_shuffles):
    from conftest import SF001
    from stratum.plans import fixtures, star_tables
    s = fixtures.star(spark, SF001)
    tables = star_tables.save_star(s.fact, s.dim_company, s.dim_executive, str(tmp_path), "bucket_test", 4)
    try:
        t = tables.read(spark)
        for fact, dim, key in (("fact_by_company", "dim_company", "company_key"), ("fact_by_executive", "dim_executive", "executive_key")):
            joined = t[fact].join(t[dim].drop("company_age_years"), key)
            plan = joined._jdf.queryExecution().executedPlan().toString()
            assert "SortMergeJoin" in plan and "Exchange" not in plan
            assert joined.count() == s.fact.count()
        grouped = t["fact_by_company"].groupBy("company_key").agg(F.max("valuation_usd"))
        assert "Exchange" not in grouped._jdf.queryExecution().executedPlan().toString()
        assert len(t["dim_company"].inputFiles()) <= 4
    finally:
        star_tables.drop_star(spark, tables)

"""Statistical aggregates: guarded correlation and one-way variance decomposition."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _c(col) -> Column:
    return F.col(col) if isinstance(col, str) else col


def guarded_corr(x, y) -> Column:
    """Pearson correlation over pairs where both sides are non-null.

    ``covar_pop / (stddev_pop(x) * stddev_pop(y))`` with a zero denominator
    giving null, where Spark's ``corr`` would raise under ANSI mode.
    """
    x, y = _c(x), _c(y)
    both = x.isNotNull() & y.isNotNull()
    xs, ys = F.when(both, x), F.when(both, y)
    den = F.stddev_pop(xs) * F.stddev_pop(ys)
    return F.covar_pop(xs, ys) / F.nullif(den, F.lit(0.0))


def stack_factors(df: DataFrame, value: str, factors: list[str],
                  name_col: str = "factor_name", value_col: str = "factor_value") -> DataFrame:
    """Unpivot ``factors`` into (factor_name, factor_value, value) rows (no shuffle)."""
    entries = F.array(*[F.struct(F.lit(f).alias(name_col),
                                 F.col(f).cast("string").alias(value_col)) for f in factors])
    return df.select(F.inline(entries), F.col(value))


def factor_group_stats(df: DataFrame, value: str, factors: list[str]) -> DataFrame:
    """Per (factor_name, factor_value): row count, non-null count, sum, within-group SS.

    One shuffle for all factors; partial aggregation keeps it map-side, so
    hot factor values cost nothing extra.
    """
    stacked = stack_factors(df, value, factors)
    v = F.col(value)
    return stacked.groupBy("factor_name", "factor_value").agg(
        F.count(F.lit(1)).alias("n"),
        F.count(v).alias("_nv"),
        F.sum(v).alias("_s"),
        (F.var_pop(v) * F.count(v)).alias("_m2"),
    ).withColumn("group_mean", F.col("_s") / F.col("_nv"))


def variance_decomposition(df: DataFrame, value: str, factors: list[str]) -> DataFrame:
    """One-way decomposition of ``value`` for each factor (eta squared).

    Per factor: number of non-null groups, their observation count,
    between-group SS ``sum n_g (mean_g - mean)^2`` over non-null groups, the
    total SS ``sum (x - mean)^2`` and their ratio (null when the total is 0).

    The overall mean and total SS come from the per-group table by the law
    of total variance (sum of within-group SS plus between-group SS over all
    groups of one factor), so no pass pairs every row with a global
    aggregate.
    """
    g = factor_group_stats(df, value, factors)
    # two small aggregates over the group table: first each factor's overall mean (one row per factor, joined
    # back), then both sums of squares; a wide factor is never sorted or buffered in one task
    means = g.groupBy("factor_name").agg((F.sum("_s") / F.sum("_nv")).alias("_mean"))
    g = g.join(means, "factor_name")
    dev = F.pow(F.col("group_mean") - F.col("_mean"), 2)
    named = F.col("factor_value").isNotNull()
    return g.groupBy("factor_name").agg(
        F.count_if(named).alias("group_count"),
        F.sum(F.when(named, F.col("n"))).alias("observation_count"),
        F.sum(F.when(named, F.col("n") * dev)).alias("between_group_sum_squares"),
        F.sum(F.coalesce(F.col("_m2"), F.lit(0.0)) + F.coalesce(F.col("_nv") * dev, F.lit(0.0)))
         .alias("total_sum_squares"),
    ).where("group_count > 0").withColumn("variance_explained_ratio",
                 F.col("between_group_sum_squares") / F.nullif(F.col("total_sum_squares"), F.lit(0.0)))

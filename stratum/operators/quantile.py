"""Exact median per group by distributed selection in rounds.

Spark's ``median`` buffers every distinct value of a group, so a hot group's
final merge runs in one task.  Here a mergeable sketch (``percentile_approx``)
brackets each group's middle first; one pass keeps the values inside the
bracket, one row for each distinct value, and one row for everything below.
While a group still has more than LIMIT distinct values there, its bracket is
cut at SPLITS - 1 further values, the rows of every cell are counted exactly,
and only the cells that hold the middle stay.  What is sorted at the end is
LIMIT rows a group, however many rows the group has.  The result is exact and
there is one plan for all sizes.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import discard, stored

ACCURACY = 10_000    # rank error of the first sketch: 1 / ACCURACY of a group's rows
MARGIN = 0.001       # half the width of the first bracket
LIMIT = 4096         # distinct values of a group that are sorted in one task
SPLITS = 64          # cells of a bracket in one round

_INTERNAL = {"_v", "_c", "_n", "_range", "_cum", "_lo", "_hi", "_all", "_d", "_splits", "_cell", "_first", "_last"}
_BELOW = None        # the value of the row that counts everything below a bracket; sorts first


def null_safe_join(left: DataFrame, right: DataFrame, keys: list[str], how: str = "inner") -> DataFrame:
    """Join of grouped tables on their group columns, null groups included; without keys both have one row."""
    if not keys:
        return left.withColumn("_all", F.lit(0)).join(
            right.withColumn("_all", F.lit(0)), "_all", how).drop("_all")
    renamed = right.select(*[F.col(c).alias(f"_r_{c}") if c in keys else F.col(c)
                             for c in right.columns])
    cond = reduce(lambda a, b: a & b,
                  [F.col(k).eqNullSafe(F.col(f"_r_{k}")) for k in keys])
    return left.join(renamed, cond, how).drop(*[f"_r_{k}" for k in keys])


def _bracket(value: str) -> list[Column]:
    """Aggregates that give a group's count of values and a bracket of its middle."""
    v = F.col(value).cast("double")
    return [F.count(v).alias("_n"), F.percentile_approx(v, [0.5 - MARGIN, 0.5 + MARGIN], ACCURACY).alias("_range")]


def _middle_ranks() -> tuple[Column, Column]:
    return F.floor((F.col("_n") - 1) / 2), F.ceil((F.col("_n") - 1) / 2)


def _at_rank(position: Column, what: str) -> Column:
    """``what`` of the first row whose running count passes ``position``."""
    return F.min_by(what, F.when(F.col("_cum") > position, F.col("_cum")))


def _narrowed(table: DataFrame, crowded: DataFrame, keys: list[str]) -> DataFrame:
    """One round: crowded groups keep the cells that hold their middle; everything below these is one row."""
    cells = null_safe_join(table, crowded.select(*keys, "_splits"), keys, "left").withColumn(
        "_cell", F.when(F.col("_splits").isNull(), 0).otherwise(F.size(F.filter("_splits", lambda s: s < F.col("_v")))))
    counted = cells.groupBy(*keys, "_n", "_cell").agg(F.sum("_c").alias("_c"))
    low, high = _middle_ranks()
    # at most SPLITS rows a group
    running = Window.partitionBy(*keys, "_n").orderBy("_cell").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    kept = counted.withColumn("_cum", F.sum("_c").over(running)).groupBy(*keys, "_n").agg(
        _at_rank(low, "_cell").alias("_first"), _at_rank(high, "_cell").alias("_last")).drop("_n")
    inside = null_safe_join(cells.drop("_splits"), kept, keys).where(F.col("_cell") <= F.col("_last"))
    below = F.when(F.col("_cell") < F.col("_first"), F.lit(_BELOW).cast("double")).otherwise(F.col("_v"))
    return inside.groupBy(*keys, "_n", below.alias("_v")).agg(F.sum("_c").alias("_c"))


def select_middle(values: DataFrame, brackets: DataFrame, keys: list[str]) -> tuple[DataFrame, str]:
    """The distinct values around every group's middle: keys, _n, _v, _c (how often), at most LIMIT + 1 rows a group.

    ``values(keys, _v)`` has no nulls; ``brackets(keys, _n, _range)`` comes from ``_bracket``.  A row with null _v counts
    all that lies below.  Each round's table is written to the shared folder and the one before is
    deleted; rounds end by themselves, as a cell holds about 1/SPLITS of a group's distinct values.
    Returns the last table and its path.
    """
    spark = values.sparkSession
    hit = null_safe_join(values, brackets, keys).where(F.col("_v") <= F.col("_range")[1])
    below = F.when(F.col("_v") < F.col("_range")[0], F.lit(_BELOW).cast("double")).otherwise(F.col("_v"))
    table, path = stored(hit.groupBy(*keys, "_n", below.alias("_v")).agg(F.count(F.lit(1)).alias("_c")), "median")
    cuts = [i / SPLITS for i in range(1, SPLITS)]
    while not table.groupBy(*keys).agg(F.count(F.lit(1)).alias("_d")).where(F.col("_d") > LIMIT).isEmpty():
        crowded, cut_path = stored(table.groupBy(*keys).agg(
            F.count(F.lit(1)).alias("_d"), F.percentile_approx("_v", cuts, 16 * SPLITS).alias("_splits"))
            .where(F.col("_d") > LIMIT), "median-cuts")
        after, after_path = stored(_narrowed(table, crowded, keys), "median")
        for old in (path, cut_path):
            discard(spark, old)
        table, path = after, after_path
    return table, path


def _medians(middle: DataFrame, keys: list[str], alias: str) -> DataFrame:
    """One row per group from the table of ``select_middle``."""
    running = Window.partitionBy(*keys, "_n").orderBy("_v").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    low, high = _middle_ranks()
    med = middle.withColumn("_cum", F.sum("_c").over(running)).groupBy(*keys, "_n").agg(
        _at_rank(low, "_v").alias("_lo"), _at_rank(high, "_v").alias("_hi"))
    # a sketch that missed its stated error would show here; a wrong median must not pass
    lost = F.raise_error(F.lit("a group's middle lies outside its bracket"))
    value = F.col("_lo") + (F.col("_hi") - F.col("_lo")) * F.lit(0.5)
    return med.select(*keys, F.when(F.col("_lo").isNull() | F.col("_hi").isNull(), lost).otherwise(value).alias(alias))


def _check_names(keys: list[str]) -> None:
    if clash := set(keys) & _INTERNAL:
        raise ValueError(f"group columns {sorted(clash)} clash with internal names")


def exact_median(df: DataFrame, keys: list[str], value: str, alias: str = "median") -> DataFrame:
    """One row per group of ``keys``: the interpolated median of ``value``.

    Nulls are skipped; a group with no non-null value is absent (join it
    back with a left join to get null).  Equal to ``median`` /
    ``quantile_cont(0.5)``: lower + (upper - lower) * 0.5.  ``df`` is read
    twice, when this is called: give it a stored table if it is dear to compute.
    """
    keys = list(keys)
    _check_names(keys)
    values = df.select(*keys, F.col(value).cast("double").alias("_v")).where(F.col("_v").isNotNull())
    brackets = values.groupBy(*keys).agg(*_bracket("_v")).where("_n > 0")
    return _medians(select_middle(values, brackets, keys)[0], keys, alias)


def agg_with_median(df: DataFrame, keys: list[str], aggs: list[Column], value: str,
                    alias: str = "_median", store: bool = False) -> DataFrame:
    """``groupBy(keys).agg(*aggs, median(value))`` with the exact median above.

    The first pass over ``df`` computes ``aggs`` and the brackets together and stores them, one row a group; the
    second keeps the values inside the brackets.  ``store`` writes ``df`` once for both passes and
    deletes it afterwards: for a ``df`` that is dearer to compute than to write.
    """
    keys = list(keys)
    _check_names(keys)
    path = None
    if store:
        df, path = stored(df, "median-input")
    base = stored(df.groupBy(*keys).agg(*aggs, *_bracket(value)), "median-base")[0]
    values = df.select(*keys, F.col(value).cast("double").alias("_v")).where(F.col("_v").isNotNull())
    middle, _ = select_middle(values, base.select(*keys, "_n", "_range").where("_n > 0"), keys)
    if path:
        discard(df.sparkSession, path)
    return null_safe_join(base.drop("_n", "_range"), _medians(middle, keys, alias), keys, "left")

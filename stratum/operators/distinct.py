"""Exact distinct counts over dense integer keys by mergeable bitmaps.

Several ``count(DISTINCT ...)`` in one aggregate make Spark repeat every row
for each of them (Expand) and shuffle every distinct value of every group.
Over dense keys a group's values fit bitmaps of 32,768 bits: each task sets
bits, bitmaps of equal (group, bucket) are merged by OR, and the counts are
sums of set bits.  What is shuffled is at most 4 KB for each bucket that a task meets,
and on tables stored in key order a task meets few.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .quantile import null_safe_join


def key_bitmaps(df: DataFrame, keys: list[str], column: str) -> DataFrame:
    """(keys, _bucket, _bits): the bitmap of ``column`` (a whole number) for every group and bucket; nulls are skipped."""
    value = F.col(column).cast("long")
    return df.where(F.col(column).isNotNull()).groupBy(*keys, F.bitmap_bucket_number(value).alias("_bucket")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position(value)).alias("_bits"))


def merged(bitmaps: DataFrame, keys: list[str]) -> DataFrame:
    """Bitmaps of finer groups (other days, other tables) put together for ``keys``."""
    return bitmaps.groupBy(*keys, "_bucket").agg(F.bitmap_or_agg("_bits").alias("_bits"))


def counted(bitmaps: DataFrame, keys: list[str], alias: str) -> DataFrame:
    """One row a group: how many values its bitmaps hold."""
    return bitmaps.groupBy(*keys).agg(F.sum(F.bitmap_count("_bits")).alias(alias))


def distinct_counts(df: DataFrame, keys: list[str], columns: dict[str, str]) -> DataFrame:
    """One row per group of ``keys`` with, for each alias, the exact number of distinct values of its column.

    Columns hold whole numbers, dense ones for small bitmaps.  A group whose values are all null counts 0.
    Without keys there is one row.
    """
    keys = list(keys)
    groups = df.select(*keys).distinct() if keys else df.sparkSession.range(1).select()
    each = [counted(key_bitmaps(df, keys, c), keys, a) for a, c in columns.items()]
    if not keys:
        return reduce(lambda a, b: null_safe_join(a, b, []), each).select(*[F.coalesce(a, F.lit(0)).alias(a) for a in columns])
    out = reduce(lambda a, b: null_safe_join(a, b, keys, "left"), each, groups)
    return out.select(*keys, *[F.coalesce(a, F.lit(0)).alias(a) for a in columns])

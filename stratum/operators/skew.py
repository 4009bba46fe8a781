"""Joins on keys of which a few hold a large share of the rows.

A hash join sends all rows of one key to one task.  Here the keys that hold
more than ``share`` of a side are found by a counted aggregate; there are at
most 1/share of them on each side, however large the tables are.  A hot key's
rows are dealt over several cells by a hash of the whole row, and the rows of
the other side that carry this key are copied to each of these cells.  All
other keys have one cell, so they join as ever.  There is one plan at every
size, and it does not rest on the optimiser noticing the skew.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

SHARE = 1 / 1024

_INTERNAL = {"_here", "_there", "_i", "_j", "_hot", "_rows"}


def hot_keys(df: DataFrame, key: str, share: float = SHARE) -> dict:
    """The keys (null included) that hold more than ``share`` of the rows, and into how many parts their rows go."""
    total = df.count()
    rows = df.groupBy(key).agg(F.count(F.lit(1)).alias("_rows")).where(F.col("_rows") > total * share).collect()
    return {r[0]: -int(-r[1] // (total * share)) for r in rows}


def _dealt(df: DataFrame, key: str, hot: DataFrame, mine: str, other: str, row: str, copy: str) -> DataFrame:
    """``df`` with cell numbers: ``row`` deals a hot key's rows, ``copy`` repeats them for the other side's parts."""
    columns = df.columns
    marked = df.join(F.broadcast(hot), df[key].eqNullSafe(hot["_hot"]), "left")
    parts, copies = F.coalesce(mine, F.lit(1)), F.coalesce(other, F.lit(1))
    return marked.select(*[df[c] for c in columns], F.pmod(F.xxhash64(*[df[c] for c in columns]), parts).alias(row),
                         F.explode(F.sequence(F.lit(0).cast("long"), (copies - 1).cast("long"))).alias(copy))


def spread_join(left: DataFrame, right: DataFrame, on: str, how: str = "inner", share: float = SHARE) -> DataFrame:
    """``left.join(right, on, how)`` for ``how`` inner or left, with hot keys split over many tasks.

    Both sides are counted first by their key column alone, when this is called.  In an inner join a key that is hot on both
    sides is dealt over a grid of cells, and rows with a null key go first.  In a left join only the left side is
    split (its null keys as well).  Equal rows stay together, as the cell hangs on a row's content and
    not on where it was read; so a retried task deals its rows the same way.
    """
    if how not in ("inner", "left"):
        raise ValueError("spread_join joins inner or left")
    if clash := _INTERNAL & {*left.columns, *right.columns}:
        raise ValueError(f"columns {sorted(clash)} are reserved by spread_join")
    right = right.where(F.col(on).isNotNull())
    if how == "inner":
        left = left.where(F.col(on).isNotNull())
    here, there = hot_keys(left, on, share), hot_keys(right, on, share) if how == "inner" else {}
    kind = T.StructType([T.StructField("_hot", left.schema[on].dataType), T.StructField("_here", T.LongType()), T.StructField("_there", T.LongType())])
    # at most 1/share keys of each side
    hot = left.sparkSession.createDataFrame([(k, here.get(k, 1), there.get(k, 1)) for k in {*here, *there}], kind)
    dealt = _dealt(left, on, hot, "_here", "_there", "_i", "_j")
    copied = _dealt(right, on, hot, "_there", "_here", "_j", "_i")
    return dealt.join(copied, [on, "_i", "_j"], how).drop("_i", "_j")

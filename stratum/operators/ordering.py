"""Order-dependent operators that stay distributed.

``assign_dense_keys`` replaces ``ROW_NUMBER() OVER (ORDER BY ...)`` without
a window over the whole table (which Spark runs in one task).
``best_per_key`` keeps the best row of every key with a partial aggregate,
so a key holding a third of all rows is still combined map-side.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import materialize

_LOCAL_BITS = 33  # monotonically_increasing_id: partition id << 33 | row index


def _order_col(c) -> Column:
    if isinstance(c, str):
        return F.asc_nulls_last(c)
    return c


def with_global_position(df: DataFrame, order: list, name: str = "_pos",
                         partitions: int | None = None) -> DataFrame:
    """Add a 0-based position in the total ``order`` (distributed).

    Range-partition on the order, sort inside partitions, tag every row with
    ``monotonically_increasing_id`` and write that layout once to the shared
    checkpoint folder; then one tiny per-partition count table (at most one
    row per partition) gives each partition its offset, broadcast back.
    The sampling pass of the range partitioning runs ``df`` down to its last
    shuffle only, as shuffle files are kept; there are
    ``spark.sql.shuffle.partitions`` partitions unless ``partitions`` says
    otherwise, and adaptive execution joins small neighbours.
    ``order`` must be total (unique) for the positions to be reproducible.
    """
    if {"_mid", "_pid", "_local", "_off", "_n"} & set(df.columns):
        raise ValueError("columns _mid, _pid, _local, _off and _n are reserved")
    cols = [_order_col(c) for c in order]
    ranged = df.repartitionByRange(partitions, *cols) if partitions else df.repartitionByRange(*cols)
    tagged = materialize(ranged.sortWithinPartitions(*cols).withColumn("_mid", F.monotonically_increasing_id()), "positions")
    tagged = tagged.withColumns({
        "_pid": F.shiftright("_mid", _LOCAL_BITS),
        "_local": F.col("_mid").bitwiseAND(F.lit((1 << _LOCAL_BITS) - 1)),
    })
    counts = tagged.groupBy("_pid").agg(F.count(F.lit(1)).alias("_n"))
    # one row for each range partition
    offsets = counts.withColumn(
        "_off", F.coalesce(F.sum("_n").over(
            Window.orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
    out = tagged.join(F.broadcast(offsets.select("_pid", "_off")), "_pid")
    return out.withColumn(name, (F.col("_off") + F.col("_local")).cast("bigint")) \
              .drop("_mid", "_pid", "_local", "_off")


def assign_dense_keys(df: DataFrame, order: list, key: str = "key", start: int = 1,
                      complete_order: bool = True, partitions: int | None = None) -> DataFrame:
    """``ROW_NUMBER() OVER (ORDER BY order)`` as a bigint key.

    With ``complete_order`` the remaining columns are appended to the order
    so ties are broken the same way on every run.  One plan at every size:
    :func:`with_global_position`, no window over the whole table.
    """
    order = list(order)
    if complete_order:
        named = {o for o in order if isinstance(o, str)}
        order += [c for c in df.columns if c not in named]
    out = with_global_position(df, order, "_pos", partitions)
    out = out.withColumn(key, F.col("_pos") + F.lit(start)).drop("_pos")
    return out.select(key, *[c for c in df.columns])


def best_per_key(df: DataFrame, key, rank: str, tiebreak: list[str] | None = None,
                 ascending: bool = True) -> DataFrame:
    """Keep one row per ``key``: lowest ``rank``, ties by ``tiebreak``, nulls last in both.

    ``min(struct(rank IS NULL, rank, tiebreak IS NULL, tiebreak..., rest...))``
    per key: the flags put nulls last, partial aggregation combines rows
    before the shuffle.
    """
    keys = [key] if isinstance(key, str) else list(key)
    if {"_null", "_r", "_rank", "_best"} & set(df.columns):
        raise ValueError("columns _null, _r, _rank and _best are reserved by best_per_key")
    tiebreak = list(tiebreak or [c for c in df.columns if c not in keys and c != rank])
    rest = [c for c in df.columns if c not in keys and c != rank and c not in tiebreak]
    r = F.col(rank) if ascending else -F.col(rank)
    packed = F.struct(F.col(rank).isNull().alias("_null"), r.alias("_r"),
                      *[x for i, c in enumerate(tiebreak)
                        for x in (F.col(c).isNull().alias(f"_null{i}"), F.col(c))],
                      *[F.col(c) for c in rest], F.col(rank).alias("_rank"))
    best = df.groupBy(*keys).agg(F.min(packed).alias("_best"))
    return best.select(*keys, *[F.col(f"_best.{c}").alias(c) for c in tiebreak + rest],
                       F.col("_best._rank").alias(rank)).select(*df.columns)

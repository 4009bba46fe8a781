"""Groups of equal documents into shards by best-fit decreasing."""

from __future__ import annotations

from bisect import bisect_left

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .store import store, unstore

GRAIN = 128          # a group above 1/GRAIN of a shard is a unit of its own; the others share GRAIN bundles a shard
MAX_UNITS = 1 << 20  # units that the driver places
ROW_BYTES = 16       # bytes that a row takes besides its text


# A balanced (AVL) tree of keys as nested tuples: (key, left, right, height).

def _node(key, left, right):
    return key, left, right, 1 + max(left[3] if left else 0, right[3] if right else 0)


def _balanced(key, left, right):
    tall, low = (left[3] if left else 0), (right[3] if right else 0)
    if tall > low + 1:
        if (left[2][3] if left[2] else 0) > (left[1][3] if left[1] else 0):
            left = _node(left[2][0], _node(left[0], left[1], left[2][1]), left[2][2])
        return _node(left[0], left[1], _node(key, left[2], right))
    if low > tall + 1:
        if (right[1][3] if right[1] else 0) > (right[2][3] if right[2] else 0):
            right = _node(right[1][0], right[1][1], _node(right[0], right[1][2], right[2]))
        return _node(right[0], _node(key, left, right[1]), right[2])
    return _node(key, left, right)


def tree_insert(tree, key):
    if tree is None:
        return key, None, None, 1
    if key < tree[0]:
        return _balanced(tree[0], tree_insert(tree[1], key), tree[2])
    return _balanced(tree[0], tree[1], tree_insert(tree[2], key))


def tree_remove(tree, key):
    """The tree without ``key``, which it holds."""
    at, left, right, _ = tree
    if key < at:
        return _balanced(at, tree_remove(left, key), right)
    if key > at:
        return _balanced(at, left, tree_remove(right, key))
    if left is None or right is None:
        return left or right
    after = right
    while after[1]:
        after = after[1]
    return _balanced(after[0], left, tree_remove(right, after[0]))


def tree_at_least(tree, key):
    """The smallest key that is not below ``key``, or None."""
    found = None
    while tree:
        if tree[0] < key:
            tree = tree[2]
        else:
            found, tree = tree[0], tree[1]
    return found


def best_fit(sizes, capacity: int, shards: int | None = None) -> list[int] | None:
    """A shard for each of ``sizes`` (decreasing), or None if more than ``shards`` are needed.

    Every size enters the open shard with the least room that still holds it (ties: the lower number), a new shard if none does.
    A size above ``capacity`` fills a shard of its own.
    """
    rooms, used, out = None, 0, []
    for size in sizes:
        found = tree_at_least(rooms, (size, -1)) if size <= capacity else None
        if found is None:
            if used == shards:
                return None
            found, used = (max(capacity, size), used), used + 1
        else:
            rooms = tree_remove(rooms, found)
        out.append(found[1])
        if size <= capacity:
            rooms = tree_insert(rooms, (found[0] - size, found[1]))
    return out


def least_capacity(sizes, shards: int) -> tuple[int, list[int]]:
    """The least capacity, to 1/4096, with which ``best_fit`` needs at most ``shards`` shards, and that placement.

    Starts at the greatest capacity that the sizes' sums rule out, steps up until a placement fits, then bisects.
    """
    rising = list(reversed(sizes))
    sums = [0, *np.cumsum(np.array(rising, dtype=np.int64)).tolist()] if rising else [0]

    def ruled_out(capacity: int) -> bool:
        k = bisect_left(rising, capacity + 1)
        return len(rising) - k + -(-sums[k] // capacity) > shards

    low, high = 0, max(sums[-1], 1)
    while high - low > 1:
        mid = (low + high) // 2
        low, high = (mid, high) if ruled_out(mid) else (low, mid)
    low, step = high - 1, max(1, high >> 12)
    while (placed := best_fit(sizes, high, shards)) is None:
        low, high, step = high, high + step, step * 2
    while high - low > max(1, high >> 12):
        mid = (low + high) // 2
        tried = best_fit(sizes, mid, shards)
        low, high, placed = (mid, high, placed) if tried is None else (low, mid, tried)
    return high, placed


def text_size(text_col: str) -> Column:
    """UTF-8 bytes of the text (null: none) plus ROW_BYTES."""
    return (F.octet_length(F.coalesce(F.col(text_col), F.lit(""))) + ROW_BYTES).cast("long")


def sharded(docs: DataFrame, shards: int | None = None, capacity: int | None = None, id_col: str = "doc_id",
            text_col: str = "text") -> DataFrame:
    """Per document: id_col, size, text_crc32, text_md5, law ('bytes'), shard, slot, grown_shard (null).

    Documents of equal text form a group that is never divided.  Best-fit decreasing fills ``shards`` shards with the least
    capacity that holds everything, so their sizes come out near equal; or, given a ``capacity`` in bytes, it fills as few
    shards as it finds.  A group larger than the capacity is a shard of its own.  ``slot`` counts a shard's
    rows from 0 in order of (text_md5, id).

    One pass over the texts writes a narrow table of sizes and digests; group sizes are partial aggregates, so a hot group costs
    one row a task.  Groups of at most 1/GRAIN of a shard are put together by digest into GRAIN bundles a shard, which
    move as one.  So the driver places at most 2 * GRAIN units a shard, MAX_UNITS in all (an error beyond), and
    that placement is broadcast.  Slots come from a range partitioning and per-partition offsets: a shard spans many tasks.

    A null text counts as the empty one.  Null ids and repeated rows are placed like any other row, other columns are
    ignored, and an empty table gives no rows.
    """
    if (shards is None) == (capacity is None):
        raise ValueError("give either shards or capacity")
    spark = docs.sparkSession
    text = F.coalesce(F.col(text_col), F.lit(""))
    rows, row_path = store(docs.select(
        F.col(id_col).cast("long").alias("id"), text_size(text_col).alias("size"), F.crc32(text).alias("crc"),
        F.md5(text).alias("digest"), F.monotonically_increasing_id().alias("at")), "sizes")
    total = rows.agg(F.sum("size")).first()[0] or 0
    count = shards or max(1, -(-total // capacity))
    if 2 * GRAIN * count > MAX_UNITS:
        raise ValueError(f"{count} shards need more than {MAX_UNITS} units: raise the capacity")
    bundles = GRAIN * count
    limit = total // bundles
    groups = rows.groupBy("digest").agg(F.sum("size").alias("size"))
    bundle = F.conv(F.substring("digest", 1, 8), 16, 10).cast("long") % bundles
    unit = F.when(F.col("size") > limit, F.col("digest")).otherwise(bundle.cast("string"))
    units = [(r[0], r[1]) for r in groups.groupBy(unit.alias("unit")).agg(F.sum("size").alias("size")).collect()]
    units.sort(key=lambda u: (-u[1], u[0]))
    sizes = [u[1] for u in units]
    placed = least_capacity(sizes, shards)[1] if shards else best_fit(sizes, capacity)
    table = spark.createDataFrame([(u[0], s) for u, s in zip(units, placed)], "unit string, shard int")
    alone = table.where(F.length("unit") == 32).select(F.col("unit").alias("digest"), F.col("shard").alias("own"))
    shared = table.where(F.length("unit") < 32).select(F.col("unit").cast("long").alias("bundle"), F.col("shard").alias("common"))
    put = rows.join(F.broadcast(alone), "digest", "left").withColumn("bundle", bundle).join(F.broadcast(shared), "bundle", "left") \
        .select("id", "size", "crc", "digest", "at", F.coalesce("own", "common").alias("shard"))
    parts = max(int(spark.conf.get("spark.sql.shuffle.partitions")), 1)
    order = ["shard", "digest", "id", "at"]
    laid, _ = store(put.repartitionByRange(parts, *order).sortWithinPartitions(*order).drop("at").withColumn(
        "part", F.spark_partition_id()).withColumn("place", F.monotonically_increasing_id()), "laid")
    unstore(spark, row_path)
    runs = laid.groupBy("shard", "part").agg(F.min("place").alias("first"), F.count(F.lit(1)).alias("k"))
    before = Window.partitionBy("shard").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    runs = runs.select("shard", "part", (F.coalesce(F.sum("k").over(before), F.lit(0)) - F.col("first")).alias("shift"))
    return laid.join(runs, ["shard", "part"]).select(
        F.col("id").alias(id_col), "size", F.col("crc").alias("text_crc32"), F.col("digest").alias("text_md5"),
        F.lit("bytes").alias("law"), "shard", (F.col("place") + F.col("shift")).alias("slot"),
        F.lit(None).cast("int").alias("grown_shard"))

"""Packing into optimal length buckets and token-budget batches."""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .store import store, unstore


def word_count(text_col: str) -> Column:
    """Words (runs of characters other than 0x20 and 0x09-0x0D) of a text; null counts none."""
    words = F.split(F.coalesce(F.col(text_col), F.lit("")), r"[\x20\x09-\x0D]+")
    edges = F.when(words[0] == "", 1).otherwise(0) + F.when((F.size(words) > 1) & (F.element_at(words, -1) == ""), 1).otherwise(0)
    return (F.size(words) - edges).cast("long")


def optimal_boundaries(lengths: np.ndarray, counts: np.ndarray, buckets: int) -> list[int]:
    """Upper bounds of at most ``buckets`` buckets with the least total padding, from a sorted histogram.

    Dynamic programming over (buckets used, last length).  The smallest best predecessor moves only upwards with
    the last length, so each layer takes M log M steps by divide and conquer.  Ties take the smallest predecessor.
    """
    m = len(lengths)
    if not m:
        return []
    upto = np.concatenate([[0], np.cumsum(counts)]).astype(np.int64)
    tokens = np.concatenate([[0], np.cumsum(counts * lengths)]).astype(np.int64)

    def cost(i, j):      # lengths i .. j-1 padded to lengths[j-1]
        return lengths[j - 1] * (upto[j] - upto[i]) - (tokens[j] - tokens[i])

    buckets = min(buckets, m)
    best = np.array([0, *(cost(0, j) for j in range(1, m + 1))], dtype=np.int64)
    chosen = []
    for k in range(2, buckets + 1):
        layer, pick = np.full(m + 1, np.iinfo(np.int64).max), np.zeros(m + 1, dtype=np.int64)
        todo = [(k, m, k - 1, m - 1)]
        while todo:
            low, high, first, last = todo.pop()
            if low > high:
                continue
            j = (low + high) // 2
            i = np.arange(max(first, k - 1), min(last, j - 1) + 1)
            total = best[i] + cost(i, j)
            at = int(total.argmin())
            layer[j], pick[j] = total[at], i[at]
            todo += [(low, j - 1, first, int(i[at])), (j + 1, high, int(i[at]), last)]
        best = layer
        chosen.append(pick)
    out, j = [], m
    for pick in reversed(chosen):
        out.append(int(lengths[j - 1]))
        j = int(pick[j])
    return [int(lengths[j - 1]), *reversed(out)]


def packed(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", buckets: int = 8,
           token_budget: int = 16384, length: Column | None = None) -> DataFrame:
    """Per document: id_col, n_tokens, bucket, bucket_length, batch, slot, padding.

    ``length`` is the token count to pack by, words by default.  The histogram of all lengths goes to the driver
    (one row per distinct length: at most the square root of twice the corpus's tokens), where dynamic programming picks
    the bucket bounds with the least padding.  Inside a bucket, documents in order of (length, id) fill batches of
    max(1, token_budget // bucket_length) documents, each padded to ``bucket_length``; a document longer than the
    budget is a batch of its own.

    Positions come from a range partitioning on (bucket, length, id) and per-partition offsets, so a bucket with
    a third of all documents spans many tasks.  Documents without tokens (null or empty text) are kept with null bucket,
    batch, slot and padding 0; null ids and repeated rows are packed like any other row; an empty table gives no rows.
    """
    spark = docs.sparkSession
    n = word_count(text_col) if length is None else F.coalesce(length, F.lit(0)).cast("long")
    sizes, size_path = store(docs.select(F.col(id_col).cast("long").alias("id"), n.alias("n")), "lengths")
    rows = sizes.where("n > 0").groupBy("n").count().orderBy("n").collect()
    bounds = optimal_boundaries(np.array([r[0] for r in rows], np.int64), np.array([r[1] for r in rows], np.int64), buckets)
    bucket, bound = F.lit(None).cast("long"), F.lit(None).cast("long")
    for k in reversed(range(len(bounds))):
        here = (F.col("n") > 0) & (F.col("n") <= bounds[k])
        bucket, bound = F.when(here, F.lit(k).cast("long")).otherwise(bucket), F.when(here, F.lit(bounds[k])).otherwise(bound)
    placed = sizes.select("id", "n", bucket.alias("bucket"), bound.cast("long").alias("bucket_length"))
    parts = max(int(spark.conf.get("spark.sql.shuffle.partitions")), 1)
    laid, laid_path = store(
        placed.repartitionByRange(parts, "bucket", "n", "id").sortWithinPartitions("bucket", "n", "id")
        .withColumn("part", F.spark_partition_id()).withColumn("at", F.monotonically_increasing_id()), "laid")
    unstore(spark, size_path)
    runs = laid.groupBy("bucket", "part").agg(F.min("at").alias("first"), F.count(F.lit(1)).alias("k"))
    before = Window.partitionBy("bucket").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    runs = runs.select(F.col("bucket").alias("run_bucket"), F.col("part").alias("run_part"), (F.coalesce(F.sum("k").over(before), F.lit(0)) - F.col("first")).alias("shift"))
    fit = F.greatest(F.lit(1), F.floor(F.lit(token_budget) / F.col("bucket_length"))).cast("long")
    rank = F.col("at") + F.col("shift")
    out = laid.join(runs, (F.col("part") == F.col("run_part")) & F.col("bucket").eqNullSafe(F.col("run_bucket"))).select(
        F.col("id"), F.col("n").alias("n_tokens"), "bucket", "bucket_length",
        F.floor(rank / fit).cast("long").alias("batch"), F.when(fit.isNotNull() & F.col("bucket_length").isNotNull(),
                                                               F.pmod(rank, fit)).alias("slot"),
        (F.coalesce(F.col("bucket_length"), F.lit(0)) - F.col("n")).alias("padding"))
    return out.withColumn("batch", F.when(F.col("bucket").isNotNull(), F.col("batch"))).withColumnRenamed("id", id_col)

"""Reading the driver's parquet tables."""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem",
          "events", "documents", "embeddings", "pages", "benchmark", "labels",
          "conversations")

# Tables whose rows carry CPU-heavy per-row work (long texts, many string
# columns); spreading them pays off.  For scan-join-aggregate tables the
# single reading task is cheap per row and a spread shuffle costs more.
SPREAD = frozenset(("orders", "documents", "pages", "conversations"))


def spread(df: DataFrame) -> DataFrame:
    """Round-robin a scan that has fewer splits than the session has cores.

    A file written as one row group is read by one task however large it
    is; CPU-heavy work after it (text cleaning, joins, aggregation) would
    then run on one core.  On a cluster, bulk tables have far more splits
    than cores and this returns ``df`` unchanged (no shuffle is added).
    Filters and column pruning still reach the scan below the exchange.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores) if df.rdd.getNumPartitions() < cores else df


_READ_CACHE: dict = {}


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One parquet table; column pruning and filters reach the scan.

    The DataFrame (a plan, not data) is reused per session and path, so the
    footer/schema job of a parquet read runs once, not once per query.
    """
    path = os.path.join(sf_dir, f"{name}.parquet")
    key = (id(spark), path)
    df = _READ_CACHE.get(key)
    if df is None or df.sparkSession is not spark:
        df = spark.read.parquet(path)
        df = spread(df) if name in SPREAD else df
        _READ_CACHE[key] = df
    return df


class Tables:
    """Lazy accessor: ``Tables(spark, dir).lineitem``."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = spark
        self.sf_dir = sf_dir

    def __getattr__(self, name: str) -> DataFrame:
        if name not in TABLES:
            raise AttributeError(name)
        return read_table(self.spark, self.sf_dir, name)

"""Intermediate tables of the operators, written to the cluster's shared folder."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from ..session import shared_dir


_BATCH = "spark.sql.execution.arrow.maxRecordsPerBatch"


def store(df: DataFrame, name: str, batch_rows: int | None = None) -> tuple[DataFrame, str]:
    """Write ``df`` once below ``spark.checkpoint.dir``; the table read back, and its path.

    A written table cuts the lineage and survives lost executors.  ``batch_rows`` bounds the rows that Python
    tasks hold at a time while it is written, for rows with long texts.
    """
    spark = df.sparkSession
    path = f"{shared_dir(spark).rstrip('/')}/llm-{name}-{uuid.uuid4().hex}"
    before = spark.conf.get(_BATCH)
    try:
        if batch_rows:
            spark.conf.set(_BATCH, str(batch_rows))
        df.write.parquet(path)
    finally:
        spark.conf.set(_BATCH, before)
    return spark.read.schema(df.schema).parquet(path), path


def unstore(spark: SparkSession, path: str) -> None:
    """Delete a table that ``store`` wrote and that no open DataFrame reads any more."""
    jvm = spark.sparkContext._jvm
    target = jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(target, True)


def free_name(df: DataFrame, base: str) -> str:
    """A column name that ``df`` does not have in any letter case."""
    taken = {c.lower() for c in df.columns}
    name = base
    while name.lower() in taken:
        name += "_"
    return name

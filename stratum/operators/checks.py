"""Writes that measure what they write and refuse a bad result, in the same pass."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from ..session import discard


class CheckFailed(ValueError):
    """A write whose metrics break a rule; the target keeps what it held."""

    def __init__(self, target: str, metrics: dict, broken: list[str]):
        super().__init__(f"{target}: {', '.join(f'{b} = {metrics[b]}' for b in broken)} must be 0")
        self.metrics, self.broken = metrics, broken


def row_metrics(keys: list[str]) -> dict[str, Column]:
    """``rows`` and the count of nulls in each of ``keys``."""
    return {"rows": F.count(F.lit(1)), **{f"null_{k}": F.count_if(F.col(k).isNull()) for k in keys}}


def checked_write(df: DataFrame, path: str, metrics: dict[str, Column], zero: list[str] | None = None, fmt: str = "parquet") -> dict:
    """Overwrite ``path`` with ``df`` and return the metrics, which the write itself collects (``observe``).

    ``zero`` names the metrics that must be 0, by default all that begin with ``null_``.  The rows are written beside the target first; if a
    rule is broken they are deleted, ``CheckFailed`` is raised and the target is as before.  Otherwise the
    target is replaced by a rename (on object stores a copy, which is not atomic).
    """
    spark = df.sparkSession
    zero = [m for m in metrics if m.startswith("null_")] if zero is None else zero
    staged = f"{path.rstrip('/')}.staged-{uuid.uuid4().hex}"
    seen = Observation()
    df.observe(seen, *[c.alias(n) for n, c in metrics.items()]).write.format(fmt).mode("overwrite").save(staged)
    got = seen.get
    if broken := [m for m in zero if got[m]]:
        discard(spark, staged)
        raise CheckFailed(path, got, broken)
    jvm = spark.sparkContext._jvm
    source, target = jvm.org.apache.hadoop.fs.Path(staged), jvm.org.apache.hadoop.fs.Path(path)
    files = target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    files.delete(target, True)
    if not files.rename(source, target):
        raise OSError(f"{staged} could not be renamed to {path}")
    return got

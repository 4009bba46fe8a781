"""Bounded samples that no task has to gather from all others."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame


def smallest_hashes(df: DataFrame, h: Column, rows: int) -> DataFrame:
    """The ``rows`` rows of ``df`` with the smallest hashes ``h`` (evenly spread 64-bit numbers); all, if there are fewer.

    A count first tells below which hash about twice as many rows lie, so the final sort sees these alone and not ``rows`` of every
    task.
    """
    total = df.count()
    if total > 2 * rows:
        df = df.where(h < -2**63 + int(2**64 * 2 * rows / total))
    return df.orderBy(h).limit(rows)

"""Alias tables of any size: chains resolved, cycles and contradictions refused, applied by a join."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import discard, stored


def resolve_aliases(aliases: DataFrame, alias: str = "alias", name: str = "name") -> DataFrame:
    """(alias, name) with every name final: no name is itself an alias.

    ``aliases`` maps an alias to a name that may be an alias again.  Each round joins the table to itself, so the steps
    that a row has taken double and a chain of n aliases needs about log2(n) rounds.  Nulls and aliases of themselves are
    dropped.  An alias with two names, and a cycle, raise ``ValueError`` naming some of them.  Runs when it is called; the
    result is a written table.
    """
    spark = aliases.sparkSession
    a, n = F.col(alias).cast("string"), F.col(name).cast("string")
    first = aliases.select(a.alias("alias"), n.alias("name")).where("alias <> name").distinct()
    table, path = stored(first, "aliases")
    double = [r[0] for r in table.groupBy("alias").count().where("count > 1").select("alias").orderBy("alias").limit(5).collect()]
    if double:
        raise ValueError(f"aliases with more than one name: {double}")
    rounds = max(1, table.count()).bit_length() + 1
    while True:
        onward = table.select(F.col("alias").alias("_a"), F.col("name").alias("_n"))
        open_rows = table.join(onward, table["name"] == onward["_a"], "left")
        if open_rows.where("_a IS NOT NULL").isEmpty():
            return table
        if not rounds:
            looped = [r[0] for r in open_rows.where("_a IS NOT NULL").select("alias").orderBy("alias").limit(5).collect()]
            raise ValueError(f"aliases that lead into a cycle: {looped}")
        rounds -= 1
        after, after_path = stored(open_rows.select("alias", F.coalesce("_n", "name").alias("name")), "aliases")
        discard(spark, path)
        table, path = after, after_path


def with_final_names(df: DataFrame, column: str, resolved: DataFrame) -> DataFrame:
    """``df`` with ``column`` replaced by its final name where ``resolved(alias, name)`` has one.

    A left join on the value; the alias side has one row a key, and Catalyst broadcasts it when its size is known to be small.
    """
    table = resolved.select(F.col("alias").alias("_alias"), F.col("name").alias("_name"))
    joined = df.join(table, df[column] == table["_alias"], "left")
    return joined.select(*[F.coalesce("_name", df[c]).alias(c) if c == column else df[c] for c in df.columns])

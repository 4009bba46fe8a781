"""The star as catalog tables stored for its joins: bucketed and sorted by the join keys."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession


@dataclass(frozen=True)
class StarTables:
    """Names of the stored tables; the fact is kept once in company order and once, narrower, in executive order."""

    fact_by_company: str
    fact_by_executive: str
    dim_company: str
    dim_executive: str

    def read(self, spark: SparkSession) -> dict[str, DataFrame]:
        return {name: spark.table(table) for name, table in vars(self).items()}


def _save(df: DataFrame, table: str, path: str, key: str, buckets: int) -> None:
    # one task writes one bucket, so a bucket is one sorted file
    (df.repartition(buckets, key).write.mode("overwrite").bucketBy(buckets, key).sortBy(key)
       .option("path", path).format("parquet").saveAsTable(table))


def save_star(fact: DataFrame, dim_company: DataFrame, dim_executive: DataFrame, path: str, prefix: str, buckets: int) -> StarTables:
    """Write the star below ``path`` as tables ``<prefix>_...`` of the session's catalog, bucketed by their join keys.

    Joins on ``company_key`` and ``executive_key`` and groupings by ``company_key`` then need no shuffle of the fact; with too many
    rows for a broadcast, both sides are read bucket by bucket.  ``buckets`` should give buckets of some 100 MB.  A hot
    executive fills one bucket: use ``operators.skew.spread_join`` on the company table for those.
    """
    tables = StarTables(*(f"{prefix}_{n}" for n in ("fact_by_company", "fact_by_executive", "dim_company", "dim_executive")))
    narrow = [c for c in ("executive_key", "company_key", "valuation_usd", "company_age_years", "experience_grit_index") if c in fact.columns]
    for df, table, key in ((fact, tables.fact_by_company, "company_key"), (fact.select(*narrow), tables.fact_by_executive, "executive_key"),
                           (dim_company, tables.dim_company, "company_key"), (dim_executive, tables.dim_executive, "executive_key")):
        _save(df, table, f"{path}/{table}", key, buckets)
    return tables


def drop_star(spark: SparkSession, tables: StarTables) -> None:
    """Remove the tables from the catalog; their files stay."""
    for table in vars(tables).values():
        spark.sql(f"DROP TABLE IF EXISTS {table}")

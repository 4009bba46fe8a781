"""Gold layer: star schema with dense surrogate keys.

dim_company and dim_executive get ``ROW_NUMBER() OVER (ORDER BY ...)`` keys
from :func:`assign_dense_keys`.  Every stored table is checked against its
contract first, and its write counts rows and null keys and fails on nulls.  The
fact is built from the *stored* dimensions when paths are given, so its
keys are the written ones.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.buckets import DEGREE_UNKNOWN, TIER_UNKNOWN, grit_index
from ..functions.numeric import parse_money
from ..functions.text import UNKNOWN_FOUNDER, slug, split_list
from ..operators.checks import checked_write, row_metrics
from ..operators.ordering import assign_dense_keys
from ..operators.skew import spread_join
from ..schemas import check_contract
from ..session import discard, stored


def explode_founders(startups: DataFrame) -> DataFrame:
    """One (company_name, founder_name, founder_match_key) row per founder.

    Companies without a usable founder list get one ``Unknown Founder`` row,
    so every company stays in the fact.  ``explode`` is a generator inside
    the scan stage; the distinct is a partial aggregate.
    """
    rows = (startups.where(F.col("Company").isNotNull())
            .select(F.col("Company").alias("company_name"),
                    F.explode(split_list("Founders", ",", UNKNOWN_FOUNDER)).alias("founder_name")))
    return rows.withColumn("founder_match_key", F.lower(F.trim("founder_name"))).dropDuplicates()


def dim_company(startups: DataFrame) -> DataFrame:
    """Distinct companies with dense keys."""
    base = (startups.where(F.col("Company").isNotNull())
            .select(F.col("Company").alias("company_name"), F.col("Industry").alias("industry"),
                    F.col("Country").alias("country"), F.col("Continent").alias("continent"),
                    F.col("City").alias("city"))
            .distinct())
    keyed = assign_dense_keys(base, ["company_name"], key="company_key")
    return keyed.select("company_key", slug("company_name").alias("company_id"), "company_name",
                        "industry", "country", "continent", "city")


def dim_executive(founders: DataFrame, executives: DataFrame) -> DataFrame:
    """Founders with their education rows (Unknown Education when none match)."""
    e = executives.select(F.lower(F.trim("executiveLabel")).alias("_key"),
                          F.col("universityLabel").alias("highest_education_institution"),
                          F.col("degreeLabel").alias("highest_degree"),
                          F.col("QS_Rank_Num").alias("qs_world_ranking"),
                          F.col("University_Tier_Flag").alias("tier_flag"))
    # one row per founder before the join: a founder of many companies is no hot join key
    f = founders.select(F.col("founder_name").alias("executive_name"), "founder_match_key") \
        .where(F.col("executive_name").isNotNull()).distinct()
    joined = f.join(e, f["founder_match_key"] == e["_key"], "left")
    cand = joined.select(
        "executive_name", "highest_education_institution",
        F.coalesce("highest_degree", F.lit(DEGREE_UNKNOWN)).alias("highest_degree"),
        "qs_world_ranking",
        F.coalesce("tier_flag", F.lit(TIER_UNKNOWN)).alias("tier_flag"),
    ).distinct()
    keyed = assign_dense_keys(
        cand, ["executive_name", F.asc_nulls_last(F.coalesce("highest_education_institution",
                                                               F.lit("Unknown")))],
        key="executive_key")
    exec_id = F.concat(slug("executive_name"), F.lit("_"),
                       slug(F.coalesce("highest_education_institution", F.lit("unknown"))))
    return keyed.select("executive_key", exec_id.alias("executive_id"), "executive_name",
                        "highest_education_institution", "highest_degree",
                        "qs_world_ranking", "tier_flag")


def fact_valuation_grit(startups: DataFrame, founders: DataFrame, dim_co: DataFrame,
                        dim_ex: DataFrame, money_scale: float = 1e9,
                        strict_money: bool = True, every_company: bool = False) -> DataFrame:
    """Company x founder x education-row grain fact with the grit index.

    Founders meet their education rows first: ``Unknown Founder`` may stand for half of all companies, so its rows are dealt over
    many tasks (``spread_join``).  ``every_company`` keeps a company that misses a key, with nulls there, so that a check can see it.
    """
    how = "left" if every_company else "inner"
    s = startups.where(F.col("Company").isNotNull()).select(
        F.col("Company").alias("company_name"),
        parse_money("Valuation_Formatted", money_scale, strict_money).alias("valuation_usd"),
        F.col("Valuation_Tier").alias("valuation_tier"), F.col("Year_Founded").alias("year_founded"),
        F.col("Company_Age_Years").alias("company_age_years"))
    c = dim_co.select("company_key", "company_name")
    f = founders.select("company_name", "founder_name")
    e = dim_ex.select("executive_key", F.col("executive_name").alias("founder_name"), "tier_flag")
    bridge = spread_join(f, e, "founder_name")
    matched = s.join(c, "company_name", how).join(bridge, "company_name", how)
    rows = matched.select(
        "company_key", "executive_key", "valuation_usd", "valuation_tier", "year_founded",
        "company_age_years",
        grit_index("company_age_years", "tier_flag").alias("experience_grit_index"))
    keyed = assign_dense_keys(rows, ["company_key", "executive_key"], key="fact_valuation_grit_key")
    return keyed


def coverage_check(startups: DataFrame, fact: DataFrame, dim_co: DataFrame) -> DataFrame:
    """Companies missing from the fact (must be empty)."""
    present = fact.select("company_key").join(dim_co.select("company_key", "company_name"),
                                              "company_key").select("company_name").distinct()
    names = startups.where(F.col("Company").isNotNull()).select(F.col("Company").alias("company_name"))
    return names.join(present, "company_name", "left_anti").distinct()


def build_gold(startups: DataFrame, executives: DataFrame, money_scale: float = 1e9,
               path: str | None = None) -> tuple[DataFrame, DataFrame, DataFrame]:
    """dim_company, dim_executive, fact; written under ``path`` when given.

    With a path the fact is built from the re-read dimensions, so its keys
    are exactly the stored ones and the lineage is cut at each write.
    """
    if path:
        write_gold(startups, executives, path, money_scale)
        spark = startups.sparkSession
        return tuple(spark.read.parquet(f"{path}/{t}") for t in ("dim_company", "dim_executive", "fact_valuation_grit"))
    founders = explode_founders(startups)
    dc = dim_company(startups)
    de = dim_executive(founders, executives)
    return dc, de, fact_valuation_grit(startups, founders, dc, de, money_scale)


def write_gold(startups: DataFrame, executives: DataFrame, path: str, money_scale: float = 1e9) -> dict[str, dict]:
    """Write the three gold tables under ``path``; the metrics that each write collected, by table.

    A null key fails the job before its table is replaced (``CheckFailed``).  The fact is joined from the companies' side
    without dropping any, so a company that no founder row or dimension row reaches has a null key: the write
    itself finds missing companies, without a second pass.
    """
    spark = startups.sparkSession
    founders, founder_path = stored(explode_founders(startups), "founders")
    out: dict[str, dict] = {}

    def put(df: DataFrame, name: str, keys: list[str]) -> DataFrame:
        check_contract(df, f"gold.{name}")
        out[name] = checked_write(df, f"{path}/{name}", row_metrics(keys))
        return spark.read.parquet(f"{path}/{name}")

    dc = put(dim_company(startups), "dim_company", ["company_key", "company_name"])
    de = put(dim_executive(founders, executives), "dim_executive", ["executive_key", "executive_name"])
    put(fact_valuation_grit(startups, founders, dc, de, money_scale, every_company=True), "fact_valuation_grit",
        ["company_key", "executive_key"])
    discard(spark, founder_path)
    return out

"""The pipeline stages as runnable jobs over files (bronze -> silver -> gold -> analyses).

    python -m stratum.jobs bronze   --drop-zone DIR --bronze DIR --manifest DIR
    python -m stratum.jobs silver   --bronze DIR --manifest DIR --silver DIR
    python -m stratum.jobs silver   --startups CSV [--profiles CSV] [--rankings CSV] --silver DIR
    python -m stratum.jobs gold     --silver DIR --gold DIR
    python -m stratum.jobs analyses --gold DIR [--out DIR]
    python -m stratum.jobs footprint --bronze-files DIR --silver DIR

Every stage reads what the previous one wrote; paths may be any Hadoop
filesystem URI.  Without ``--out`` the analyses are printed (small results).
"""

from __future__ import annotations

import argparse

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .plans import analytics, bronze, gold, silver
from .sources import files, objects

# --- fixed values that must equal the reference's --------------------------
STARTUP_COLUMNS = ("Rank", "Company", "Valuation_Formatted", "Valuation_Tier", "Industry",
                   "Country", "Continent", "City", "Founders", "Year_Founded",
                   "Company_Age_Years", "Status", "Data_Source", "Collection_Date")
PROFILE_COLUMNS = ("companyLabel", "executiveLabel", "universityLabel", "degreeLabel")
STARTUPS_OBJECT, PROFILES_OBJECT = "kaggle_unicorn_startups.csv", "wikidata_executive_profile.csv"
RANKING_KEYWORD, RANKING_HEADER_ROW = "QS World University Rankings", 2
# ---------------------------------------------------------------------------


def _strings(names) -> T.StructType:
    return T.StructType([T.StructField(n, T.StringType()) for n in names])


def run_bronze(spark: SparkSession, drop_zone: str, bronze_dir: str, manifest_dir: str,
               api_pattern: str | None = None) -> DataFrame:
    return bronze.land(spark, drop_zone, bronze_dir, manifest_dir, api_pattern=api_pattern)


def run_silver(spark: SparkSession, startups_csv: str, silver_dir: str,
               profiles_csv: str | None = None, rankings_csv: str | None = None,
               rankings_header_row: int = 2, fmt: str = "parquet") -> None:
    """Refine the three landed inputs and write the two silver tables."""
    startups = silver.refine_startups(files.read_csv(spark, startups_csv, _strings(STARTUP_COLUMNS), multi_line=True))
    profiles = (files.read_csv(spark, profiles_csv, _strings(PROFILE_COLUMNS), multi_line=True) if profiles_csv
                else spark.createDataFrame([], _strings(PROFILE_COLUMNS)))
    rankings = (files.read_with_preamble(spark, rankings_csv, header_row=rankings_header_row)
                if rankings_csv else spark.createDataFrame([], _strings(["Institution", "Rank"])))
    _write_silver(startups, profiles, rankings, silver_dir, fmt)


def _write_silver(startups: DataFrame, profiles: DataFrame, rankings: DataFrame, silver_dir: str, fmt: str) -> None:
    silver.write_table(startups, f"{silver_dir}/unicorn_startups", fmt, contract="silver.unicorn_startups")
    silver.write_table(silver.executive_profiles(profiles, rankings),
                       f"{silver_dir}/executive_profiles", fmt, contract="silver.executive_profiles")


def run_silver_from_bronze(spark: SparkSession, bronze_dir: str, manifest_dir: str, silver_dir: str, fmt: str = "parquet",
                           ranking_extension: str = ".xlsx") -> str:
    """Refine the landed objects as they are now and write the two silver tables; returns the ranking object's name.

    The newest ranking workbook is chosen among all landed objects (greatest year in its name, then modification time, then
    name); without one the job fails, as it does when the startups object is missing.  The profiles object may be missing.
    """
    now = bronze.current_objects(spark, bronze_dir, manifest_dir)
    newest = bronze.latest_object(now, RANKING_KEYWORD, ranking_extension)
    ranking = newest.first()
    if ranking is None or ranking.object_name is None:
        raise FileNotFoundError(f"no {ranking_extension} object named like '{RANKING_KEYWORD}' has been landed")

    def table(name: str, header_row: int = 0) -> DataFrame:
        return objects.read_objects(now.where(F.col("object_name") == name), header_row)

    def bound(df: DataFrame, names) -> DataFrame:
        return df.select(*[F.col(n) if n in df.columns else F.lit(None).cast("string").alias(n) for n in names])

    startups = table(STARTUPS_OBJECT)
    if not startups.columns:
        raise FileNotFoundError(f"{STARTUPS_OBJECT} has not been landed")
    profiles = table(PROFILES_OBJECT)
    profiles = bound(profiles, PROFILE_COLUMNS) if profiles.columns else spark.createDataFrame([], _strings(PROFILE_COLUMNS))
    _write_silver(silver.refine_startups(bound(startups, STARTUP_COLUMNS)), profiles,
                  table(ranking.object_name, RANKING_HEADER_ROW), silver_dir, fmt)
    return ranking.object_name


def run_footprint(spark: SparkSession, bronze_files: str, silver_dir: str) -> DataFrame:
    """The storage report of a folder of raw files and the two silver tables."""
    return bronze.layer_footprint(spark, bronze_files, {n: f"{silver_dir}/{n}" for n in ("unicorn_startups", "executive_profiles")})


def run_gold(spark: SparkSession, silver_dir: str, gold_dir: str, fmt: str = "parquet"):
    startups = spark.read.format(fmt).load(f"{silver_dir}/unicorn_startups")
    executives = spark.read.format(fmt).load(f"{silver_dir}/executive_profiles")
    return gold.build_gold(startups, executives, path=gold_dir)


def register_views(spark: SparkSession, gold_dir: str,
                   names=("fact_valuation_grit", "dim_company", "dim_executive")) -> None:
    """Expose the stored gold tables as temporary views for Spark SQL."""
    for name in names:
        spark.read.parquet(f"{gold_dir}/{name}").createOrReplaceTempView(name)


def run_analyses(spark: SparkSession, gold_dir: str, unit: float = 1e9) -> dict[str, DataFrame]:
    fact = spark.read.parquet(f"{gold_dir}/fact_valuation_grit")
    dc = spark.read.parquet(f"{gold_dir}/dim_company")
    de = spark.read.parquet(f"{gold_dir}/dim_executive")
    return {
        "company_age_and_grit_effect": analytics.age_effect(fact, unit),
        "grit_vs_university_tier": analytics.grit_by_tier(fact, de, unit),
        "industry_valuation_dominance": analytics.industry_dominance(fact, dc, unit),
        "qs_rank_correlation_with_valuation": analytics.rank_correlation(fact, de, unit),
        "valuation_by_university_tier": analytics.value_by_tier(fact, de, unit),
        "factor_dominance_comparison": analytics.factor_dominance(fact, dc, de),
    }


def main(argv=None) -> None:
    from .session import build_session
    p = argparse.ArgumentParser(prog="stratum.jobs")
    sub = p.add_subparsers(dest="stage", required=True)
    b = sub.add_parser("bronze")
    b.add_argument("--drop-zone", required=True)
    b.add_argument("--bronze", required=True)
    b.add_argument("--manifest", required=True)
    b.add_argument("--api-pattern")
    s = sub.add_parser("silver")
    s.add_argument("--startups")
    s.add_argument("--bronze")
    s.add_argument("--manifest")
    s.add_argument("--profiles")
    s.add_argument("--rankings")
    s.add_argument("--silver", required=True)
    g = sub.add_parser("gold")
    g.add_argument("--silver", required=True)
    g.add_argument("--gold", required=True)
    a = sub.add_parser("analyses")
    a.add_argument("--gold", required=True)
    a.add_argument("--out")
    f = sub.add_parser("footprint")
    f.add_argument("--bronze-files", required=True)
    f.add_argument("--silver", required=True)
    args = p.parse_args(argv)
    if args.stage == "silver" and not (args.startups or args.bronze and args.manifest):
        p.error("silver needs --startups, or --bronze and --manifest")
    spark = build_session(app=f"stratum-{args.stage}")
    if args.stage == "bronze":
        run_bronze(spark, args.drop_zone, args.bronze, args.manifest, args.api_pattern) \
            .groupBy("action").count().show()
    elif args.stage == "footprint":
        run_footprint(spark, args.bronze_files, args.silver).show(1000, truncate=False)
    elif args.stage == "silver" and args.bronze:
        run_silver_from_bronze(spark, args.bronze, args.manifest, args.silver)
    elif args.stage == "silver":
        run_silver(spark, args.startups, args.silver, args.profiles, args.rankings)
    elif args.stage == "gold":
        run_gold(spark, args.silver, args.gold)
    else:
        for name, df in run_analyses(spark, args.gold).items():
            if args.out:
                df.write.mode("overwrite").parquet(f"{args.out}/{name}")
            else:
                print(name)
                df.show(truncate=False)


if __name__ == "__main__":
    main()

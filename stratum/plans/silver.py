"""Silver layer: cleaning, typing and rank enrichment of the landed tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.buckets import DEGREE_UNKNOWN, rank_tier
from ..functions.numeric import coerce_numeric, numeric_types
from ..functions.text import find_column, first_number, name_key, normalize_missing
from ..operators.aliases import with_final_names
from ..operators.ordering import best_per_key
from ..schemas import check_contract

# --- fixed values that must equal the reference's --------------------------
STARTUP_NUMERIC = ("Rank", "Year_Founded", "Company_Age_Years")
PROFILE_REQUIRED = ("companyLabel", "executiveLabel", "universityLabel")
# ---------------------------------------------------------------------------


def refine_startups(raw: DataFrame, numeric=STARTUP_NUMERIC) -> DataFrame:
    """Trim text, markers to null, coerce the numeric columns that exist.

    A numeric column is bigint, or double if any of its values has a fraction: one aggregate over all these
    columns decides when this is called, so no number is lost.
    """
    df = normalize_missing(raw)
    types = numeric_types(df, [c for c in numeric if c in df.columns])
    return df.withColumns({c: coerce_numeric(c, t) for c, t in types.items()})


def clean_profiles(raw: DataFrame) -> DataFrame:
    """Distinct rows, drop rows missing a required label, degree defaults to Unknown."""
    df = normalize_missing(raw).dropDuplicates()
    df = df.na.drop(subset=list(PROFILE_REQUIRED))
    return df.withColumn("degreeLabel", F.coalesce(F.col("degreeLabel"), F.lit(DEGREE_UNKNOWN)))


def clean_rankings(raw: DataFrame) -> DataFrame:
    """Pick the institution and rank columns by name, key them, parse the rank."""
    df = normalize_missing(raw)
    inst = find_column(df, "institution", "name")
    rank = find_column(df, "rank")
    df = df.select(F.col(inst).cast("string").alias("universityLabel"),
                   F.col(rank).cast("string").alias("QS_Rank"))
    df = normalize_missing(df).na.drop(subset=["universityLabel"])
    return df.select(
        "universityLabel", "QS_Rank",
        name_key("universityLabel").alias("university_match_key"),
        first_number("QS_Rank").alias("QS_Rank_Num"),
    )


def best_rank_per_institution(rankings: DataFrame) -> DataFrame:
    """Lowest numeric rank per match key (null ranks last)."""
    slim = rankings.select("university_match_key", "QS_Rank_Num", "QS_Rank")
    return best_per_key(slim, "university_match_key", "QS_Rank_Num", tiebreak=["QS_Rank"])


def enrich_profiles(profiles: DataFrame, rankings: DataFrame, aliases: DataFrame | None = None) -> DataFrame:
    """Left-join each profile to its institution's best rank and flag the tier.

    The ranking side has one row per institution key, so the join never
    fans out; Catalyst/AQE broadcast it when its measured size allows.
    ``aliases(alias, name)`` is a table of further institution names, already keyed (``operators.aliases.resolve_aliases``);
    it is joined to both sides, so it may be of any size.
    """
    keyed = profiles.withColumn("university_match_key", name_key("universityLabel"))
    if aliases is not None:
        keyed = with_final_names(keyed, "university_match_key", aliases)
        rankings = with_final_names(rankings, "university_match_key", aliases)
    best = best_rank_per_institution(rankings).select("university_match_key", "QS_Rank_Num")
    out = keyed.join(best, "university_match_key", "left")
    out = out.withColumn("University_Tier_Flag", rank_tier("QS_Rank_Num"))
    return out.drop("university_match_key", "QS_Rank")


def executive_profiles(raw_profiles: DataFrame, raw_rankings: DataFrame, aliases: DataFrame | None = None) -> DataFrame:
    """The silver executive table: companyLabel, executiveLabel, universityLabel,
    degreeLabel, QS_Rank_Num, University_Tier_Flag."""
    out = enrich_profiles(clean_profiles(raw_profiles), clean_rankings(raw_rankings), aliases)
    return out.select("companyLabel", "executiveLabel", "universityLabel", "degreeLabel",
                      F.col("QS_Rank_Num").cast("double").alias("QS_Rank_Num"),
                      F.col("University_Tier_Flag").cast("string").alias("University_Tier_Flag"))


def write_table(df: DataFrame, path: str, fmt: str = "parquet", contract: str | None = None) -> None:
    """Overwrite sink; ``fmt='delta'`` when that source is on the classpath.

    With ``contract`` the schema is checked first (no job runs for that).
    """
    if contract:
        check_contract(df, contract)
    df.write.format(fmt).mode("overwrite").save(path)

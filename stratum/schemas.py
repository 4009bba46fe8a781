"""Column contracts of the stored tables, checked before every write."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import types as T

S, D, L = T.StringType(), T.DoubleType(), T.LongType()
N = (L, D)      # a number column: whole or, if its values have fractions, double

CONTRACTS = {
    "silver.unicorn_startups": [
        ("Rank", N), ("Company", S), ("Valuation_Formatted", S), ("Valuation_Tier", S), ("Industry", S),
        ("Country", S), ("Continent", S), ("City", S), ("Founders", S), ("Year_Founded", N),
        ("Company_Age_Years", N), ("Status", S), ("Data_Source", S), ("Collection_Date", S)],
    "silver.executive_profiles": [
        ("companyLabel", S), ("executiveLabel", S), ("universityLabel", S), ("degreeLabel", S),
        ("QS_Rank_Num", D), ("University_Tier_Flag", S)],
    "gold.dim_company": [
        ("company_key", L), ("company_id", S), ("company_name", S), ("industry", S),
        ("country", S), ("continent", S), ("city", S)],
    "gold.dim_executive": [
        ("executive_key", L), ("executive_id", S), ("executive_name", S),
        ("highest_education_institution", S), ("highest_degree", S),
        ("qs_world_ranking", D), ("tier_flag", S)],
    "gold.fact_valuation_grit": [
        ("fact_valuation_grit_key", L), ("company_key", L), ("executive_key", L),
        ("valuation_usd", D), ("valuation_tier", S), ("year_founded", N),
        ("company_age_years", N), ("experience_grit_index", D)],
}


def check_contract(df: DataFrame, table: str) -> DataFrame:
    """Fail before writing when columns, order or types differ from the contract.

    A column whose type could not be resolved (``NullType``, e.g. an
    all-null literal) is always rejected: stored tables need real types.
    Metadata only - no job runs.
    """
    fields = [(f.name, f.dataType) for f in df.schema.fields]
    for name, typ in fields:
        if isinstance(typ, T.NullType):
            raise ValueError(f"{table}: column {name} has no type (NullType)")
    want = CONTRACTS[table]
    fits = len(fields) == len(want) and all(
        n == m and t in (k if isinstance(k, tuple) else (k,)) for (n, t), (m, k) in zip(fields, want))
    if not fits:
        raise ValueError(f"{table}: schema {fields} does not match contract {want}")
    return df

"""The analyses over a (fact, dim_company, dim_executive) star schema.

Every function takes DataFrames and returns a lazy DataFrame.  Monetary
outputs are divided by ``unit`` (1e9 in production, hence the ``billion``
column names; the name follows the unit).  Rounding is ``round_half``.

Scale notes
* company-level pre-aggregation (two-level aggregate) is partial/final
  hash aggregation: a hot company is combined map-side;
* joins to dimensions are left to Catalyst/AQE: a dimension is broadcast
  only when its measured size is under the broadcast threshold, otherwise
  sort-merge with AQE skew splitting;
* distinct counts are bitmaps over the dense surrogate keys, merged per
  bucket of keys (no Expand, no shuffle of every distinct key);
* medians go through ``agg_with_median``: one pass for the aggregates and the
  brackets, one for the values inside them; company-level inputs (an
  aggregate behind a shuffle) are written once for both.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.buckets import TIER_UNKNOWN, TIER_UNRANKED, age_bucket, company_tier, grit_level
from ..functions.numeric import round_half, unit_word
from ..operators.distinct import distinct_counts
from ..operators.quantile import agg_with_median, null_safe_join
from ..operators.stats import factor_group_stats, guarded_corr, variance_decomposition

_MED = "_median"


def _names(unit: float):
    w = unit_word(unit)
    return (f"total_valuation_{w}_usd", f"avg_valuation_{w}_usd", f"median_valuation_{w}_usd")


def age_effect(fact: DataFrame, unit: float = 1e9) -> DataFrame:
    """Company age bucket vs valuation and grit (companies counted once)."""
    total, avg, med = _names(unit)
    v = F.col("valuation_usd")
    company = (fact.where(F.col("company_age_years").isNotNull() &
                          F.col("experience_grit_index").isNotNull() & (v > 0))
               .groupBy("company_key")
               .agg(F.max("valuation_usd").alias("valuation_usd"),
                    F.max("company_age_years").alias("company_age_years"),
                    F.avg("experience_grit_index").alias("experience_grit_index")))
    bucketed = company.withColumn("company_age_bucket", age_bucket("company_age_years"))
    out = agg_with_median(bucketed, ["company_age_bucket"], [
        F.count(F.lit(1)).alias("total_companies"),
        round_half(F.avg("company_age_years"), 2).alias("avg_company_age_years"),
        round_half(F.avg("experience_grit_index"), 2).alias("avg_grit_index"),
        round_half(F.sum(v) / unit, 2).alias(total),
        round_half(F.avg(v) / unit, 2).alias(avg),
    ], "valuation_usd", _MED, store=True)
    out = out.withColumn(med, round_half(F.col(_MED) / unit, 2))
    return out.select("company_age_bucket", "total_companies", "avg_company_age_years",
                      "avg_grit_index", total, avg, med) \
              .orderBy(F.desc_nulls_last(avg), "company_age_bucket")


def industry_dominance(fact: DataFrame, dim_company: DataFrame, unit: float = 1e9,
                       min_companies: int = 2, top: int = 10) -> DataFrame:
    """Top industries by average company valuation (industries with >= 2 companies)."""
    total, avg, med = _names(unit)
    v = F.col("valuation_usd")
    dims = dim_company.select("company_key", "industry").where(F.col("industry").isNotNull())
    company = (fact.where(v > 0).select("company_key", "valuation_usd", "experience_grit_index")
               .join(dims, "company_key")
               .groupBy("company_key", "industry")
               .agg(F.max("valuation_usd").alias("valuation_usd"),
                    F.avg("experience_grit_index").alias("experience_grit_index")))
    out = agg_with_median(company, ["industry"], [
        F.count(F.lit(1)).alias("total_companies"),
        round_half(F.sum(v) / unit, 2).alias(total),
        round_half(F.avg(v) / unit, 2).alias(avg),
        round_half(F.avg("experience_grit_index"), 2).alias("avg_grit_index"),
    ], "valuation_usd", _MED, store=True)
    out = (out.where(F.col("total_companies") >= min_companies)
              .withColumn(med, round_half(F.col(_MED) / unit, 2)))
    # top-k: TakeOrderedAndProject, industry breaks ties
    return out.select("industry", "total_companies", total, avg, med, "avg_grit_index") \
              .orderBy(F.desc_nulls_last(avg), F.asc_nulls_last("industry")).limit(top)


def grit_by_tier(fact: DataFrame, dim_executive: DataFrame, unit: float = 1e9) -> DataFrame:
    """Education tier x grit level cross-tab."""
    total, avg, med = _names(unit)
    v = F.col("valuation_usd")
    tiers = dim_executive.select("executive_key", F.col("tier_flag").alias("university_tier")) \
        .where(F.col("university_tier").isNotNull() & (F.col("university_tier") != TIER_UNKNOWN))
    base = (fact.where((v > 0) & F.col("experience_grit_index").isNotNull())
            .select("company_key", "executive_key", "valuation_usd", "company_age_years", "experience_grit_index")
            .join(tiers, "executive_key")
            .withColumn("grit_level", grit_level("experience_grit_index")))
    keys = ["university_tier", "grit_level"]
    out = agg_with_median(base, keys, [
        F.count(F.lit(1)).alias("executive_company_pairs"),
        round_half(F.avg("company_age_years"), 2).alias("avg_company_age_years"),
        round_half(F.avg("experience_grit_index"), 2).alias("avg_grit_index"),
        round_half(F.sum(v) / unit, 2).alias(total),
        round_half(F.avg(v) / unit, 2).alias(avg),
    ], "valuation_usd", _MED)
    out = null_safe_join(out, distinct_counts(base, keys, {"total_companies": "company_key"}), keys) \
        .withColumn(med, round_half(F.col(_MED) / unit, 2))
    return out.select("university_tier", "grit_level", "executive_company_pairs", "total_companies",
                      "avg_company_age_years", "avg_grit_index", total, avg, med) \
              .orderBy(F.desc_nulls_last(avg), "university_tier", "grit_level")


def rank_correlation(fact: DataFrame, dim_executive: DataFrame, unit: float = 1e9) -> DataFrame:
    """Correlation of founder rank (and 1/rank) with log valuation, one row."""
    _, avg, med = _names(unit)
    v = F.col("valuation_usd")
    q = F.col("qs_world_ranking")
    ranked = dim_executive.select("executive_key", "qs_world_ranking") \
        .where(q.isNotNull() & (q > 0))
    base = fact.where(v > 0).select("company_key", "executive_key", "valuation_usd") \
        .join(ranked, "executive_key")
    log_v = F.ln(v)
    out = agg_with_median(base, [], [
        F.count(F.lit(1)).alias("ranked_observations"),
        round_half(guarded_corr(q, log_v), 4).alias("corr_qs_rank_vs_log_valuation"),
        round_half(guarded_corr(F.lit(1.0) / q, log_v), 4).alias("corr_qs_quality_vs_log_valuation"),
        round_half(F.avg(q), 2).alias("avg_qs_rank"),
        round_half(F.avg(v) / unit, 2).alias(avg),
    ], "valuation_usd", _MED)
    out = null_safe_join(out, distinct_counts(base, [], {"ranked_companies": "company_key"}), [])
    return out.withColumn(med, round_half(F.col(_MED) / unit, 2)).select(
        "ranked_observations", "ranked_companies", "corr_qs_rank_vs_log_valuation", "corr_qs_quality_vs_log_valuation",
        "avg_qs_rank", avg, med)


def value_by_tier(fact: DataFrame, dim_executive: DataFrame, unit: float = 1e9) -> DataFrame:
    """Valuation summary per founder education tier."""
    total, avg, med = _names(unit)
    v = F.col("valuation_usd")
    tiers = dim_executive.select("executive_key", "tier_flag") \
        .where(F.col("tier_flag").isNotNull() & (F.col("tier_flag") != TIER_UNKNOWN))
    base = fact.where(v > 0).select("company_key", "executive_key", "valuation_usd") \
        .join(tiers, "executive_key")
    out = agg_with_median(base, ["tier_flag"], [
        F.count(F.lit(1)).alias("executive_company_pairs"),
        round_half(F.sum(v) / unit, 2).alias(total),
        round_half(F.avg(v) / unit, 2).alias(avg),
        round_half(F.avg(F.ln(v)), 4).alias("avg_log_valuation"),
    ], "valuation_usd", _MED)
    counts = distinct_counts(base, ["tier_flag"], {"total_companies": "company_key"})
    # executives of one name count once: the keys seen are no more than the dimension's rows, and only they meet their names
    seen = base.select("tier_flag", "executive_key").distinct().join(dim_executive.select("executive_key", "executive_name"), "executive_key")
    names = seen.groupBy("tier_flag").agg(F.count_distinct("executive_name").alias("total_executives"))
    out = null_safe_join(null_safe_join(out, counts, ["tier_flag"]), names, ["tier_flag"]).withColumn(med, round_half(F.col(_MED) / unit, 2))
    return out.select("tier_flag", "executive_company_pairs", "total_companies", "total_executives",
                      total, avg, med, "avg_log_valuation") \
              .orderBy(F.desc_nulls_last(avg), "tier_flag")


FACTORS = ["university_tier", "industry", "country", "company_age_bucket"]


def factor_model_data(fact: DataFrame, dim_company: DataFrame, dim_executive: DataFrame) -> DataFrame:
    """One row per (company, industry, country): log valuation and four factors."""
    v = F.col("valuation_usd")
    c = dim_company.select("company_key", "industry", "country") \
        .where(F.col("industry").isNotNull() & F.col("country").isNotNull())
    e = dim_executive.select("executive_key", "qs_world_ranking", "tier_flag")
    company = (fact.where((v > 0) & F.col("company_age_years").isNotNull())
               .select("company_key", "executive_key", "valuation_usd", "company_age_years")
               .join(c, "company_key").join(e, "executive_key")
               .groupBy("company_key", "industry", "country")
               .agg(F.max("valuation_usd").alias("valuation_usd"),
                    F.min("qs_world_ranking").alias("best_qs_rank"),
                    F.sum(F.when(F.col("tier_flag") == TIER_UNRANKED, 1).otherwise(0))
                     .alias("unranked_university_count"),
                    F.max("company_age_years").alias("company_age_years")))
    return company.select(
        "company_key",
        F.ln("valuation_usd").alias("log_valuation_usd"),
        company_tier("best_qs_rank", "unranked_university_count").alias("university_tier"),
        "industry", "country",
        age_bucket("company_age_years").alias("company_age_bucket"),
    )


def factor_dominance(fact: DataFrame, dim_company: DataFrame, dim_executive: DataFrame,
                     factors: list[str] = FACTORS) -> DataFrame:
    """Share of log-valuation variance explained by each factor (eta squared)."""
    model = factor_model_data(fact, dim_company, dim_executive)
    out = variance_decomposition(model, "log_valuation_usd", factors)
    return out.select(
        "factor_name", "group_count", "observation_count",
        round_half("between_group_sum_squares", 4).alias("between_group_sum_squares"),
        round_half("total_sum_squares", 4).alias("total_sum_squares"),
        round_half("variance_explained_ratio", 4).alias("variance_explained_ratio"),
    ).orderBy(F.desc_nulls_last("variance_explained_ratio"), "factor_name")


def factor_groups(fact: DataFrame, dim_company: DataFrame, dim_executive: DataFrame,
                  factors: list[str] = FACTORS) -> DataFrame:
    """Count and mean log valuation for every value of every factor, one pass."""
    model = factor_model_data(fact, dim_company, dim_executive)
    g = factor_group_stats(model, "log_valuation_usd", factors)
    return g.select("factor_name", "factor_value", "n",
                    round_half("group_mean", 4).alias("group_mean"))

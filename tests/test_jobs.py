"""Stage jobs end to end on generated files in the original layouts (14 startup columns, profiles, a ranking sheet)."""

import csv
import os
import tempfile

import pytest
from pyspark.sql import functions as F

from stratum import jobs

N = 60


@pytest.fixture(scope="module")
def inputs(tmp_path_factory):
    base = tmp_path_factory.mktemp("inputs")
    rows = [[k, f" Acme {k} ", f"${k}.5B", "Unicorn", "N/A" if k % 10 == 0 else f"Industry {k % 7}", f"Country {k % 4}", "X", "Y",
             "" if k % 6 == 0 else f"Ann {k % 9}, Bob \"B\" {k}", 2000 + k % 20, (k % 30) + 1, "Active", "list", "2026-01-01"]
            for k in range(1, N + 1)]
    with open(base / "startups.csv", "w", newline="") as f:
        out = csv.writer(f)
        out.writerow(jobs.STARTUP_COLUMNS)
        out.writerows(rows)
    with open(base / "profiles.csv", "w", newline="") as f:
        out = csv.writer(f)
        out.writerow(reversed(jobs.PROFILE_COLUMNS))         # another order: columns bind by name
        out.writerows([["", f"University of {k % 5}", f"Ann {k}", "Acme"] for k in range(9)])
    (base / "rankings.csv").write_text("Rankings\n\nInstitution Name,QS Rank 2026\n" + "".join(
        f"University of {k},={k * 40 + 1}\n" for k in range(4)))
    return base, rows


def test_silver_gold_analyses_on_generated_files(spark, inputs):
    files, rows = inputs
    base = tempfile.mkdtemp(prefix="jobs-")
    jobs.run_silver(spark, str(files / "startups.csv"), f"{base}/silver", str(files / "profiles.csv"), str(files / "rankings.csv"))
    s = spark.read.parquet(f"{base}/silver/unicorn_startups")
    assert s.count() == N and s.where("Industry IS NULL").count() == N // 10
    p = {r.executiveLabel: (r.QS_Rank_Num, r.degreeLabel) for r in spark.read.parquet(f"{base}/silver/executive_profiles").collect()}
    assert p == {f"Ann {k}": (None if k % 5 == 4 else k % 5 * 40 + 1.0, "Unknown") for k in range(9)}
    dc, de, fact = jobs.run_gold(spark, f"{base}/silver", f"{base}/gold")
    pairs = sum(1 if k % 6 == 0 else 2 for k in range(1, N + 1))
    assert (dc.count(), fact.count()) == (N, pairs)
    names = {x.strip() for r in rows for x in r[8].split(",") if x.strip()} | {"Unknown Founder"}
    assert {r[0] for r in de.select("executive_name").collect()} == names
    out = jobs.run_analyses(spark, f"{base}/gold")
    age = {r.company_age_bucket: r.total_companies for r in out["company_age_and_grit_effect"].collect()}
    ages = [r[10] for r in rows]
    assert age == {"0-5 Years": sum(a <= 5 for a in ages), "6-10 Years": sum(5 < a <= 10 for a in ages),
                   "11-20 Years": sum(10 < a <= 20 for a in ages), "20+ Years": sum(a > 20 for a in ages)}
    total = out["company_age_and_grit_effect"].agg(F.sum("total_valuation_billion_usd")).first()[0]
    assert abs(total - sum(k + 0.5 for k in range(1, N + 1))) < 0.05
    assert out["industry_valuation_dominance"].count() == 7 and out["factor_dominance_comparison"].count() == 4
    ranked = [r for r in rows if r[8] and (r[0] % 9) % 5 != 4]
    assert out["qs_rank_correlation_with_valuation"].first().ranked_observations == len(ranked)


def test_sql_over_registered_gold_views(spark, inputs):
    base = tempfile.mkdtemp(prefix="views-")
    jobs.run_silver(spark, str(inputs[0] / "startups.csv"), f"{base}/silver")
    jobs.run_gold(spark, f"{base}/silver", f"{base}/gold")
    jobs.register_views(spark, f"{base}/gold")
    sql = spark.sql("""
        SELECT c.industry, COUNT(DISTINCT f.company_key) AS n
        FROM fact_valuation_grit f JOIN dim_company c ON f.company_key = c.company_key
        WHERE f.valuation_usd > 0 AND c.industry IS NOT NULL GROUP BY c.industry HAVING COUNT(DISTINCT f.company_key) >= 2""")
    top = jobs.run_analyses(spark, f"{base}/gold")["industry_valuation_dominance"]
    assert {(r.industry, r.n) for r in sql.collect()} == \
        {(r.industry, r.total_companies) for r in top.collect()}


def test_cli_stages_end_to_end(spark):
    """bronze -> silver -> gold -> analyses through the command-line entry point."""
    from stratum.plans import fixtures
    from stratum.sources.tables import Tables
    from conftest import SF001
    base = tempfile.mkdtemp(prefix="cli-")
    zone = os.path.join(base, "zone")
    part = Tables(spark, SF001).part
    startups = fixtures.startups_from_part(part).select(
        F.col("Company_Age_Years").cast("string").alias("Rank"), "Company", "Valuation_Formatted",
        "Valuation_Tier", "Industry", "Country", "Continent", "City", "Founders",
        F.col("Year_Founded").cast("string").alias("Year_Founded"),
        F.col("Company_Age_Years").cast("string").alias("Company_Age_Years"),
        F.lit("Private").alias("Status"), F.lit("test").alias("Data_Source"),
        F.lit("2/12/2026").alias("Collection_Date"))
    startups.coalesce(1).write.option("header", True).csv(zone)
    csv_file = next(os.path.join(zone, f) for f in os.listdir(zone) if f.endswith(".csv"))
    jobs.main(["bronze", "--drop-zone", zone, "--bronze", f"{base}/bronze", "--manifest", f"{base}/manifest"])
    assert spark.read.parquet(f"{base}/manifest").count() == 1
    jobs.main(["silver", "--startups", csv_file, "--silver", f"{base}/silver"])
    jobs.main(["gold", "--silver", f"{base}/silver", "--gold", f"{base}/gold"])
    jobs.main(["analyses", "--gold", f"{base}/gold", "--out", f"{base}/out"])
    companies = spark.read.parquet(f"{base}/gold/dim_company").count()
    assert companies == part.count()
    ages = spark.read.parquet(f"{base}/out/company_age_and_grit_effect")
    assert ages.agg(F.sum("total_companies")).first()[0] == companies

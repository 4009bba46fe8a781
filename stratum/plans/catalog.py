"""Registry of named queries (spark, sf_dir) -> DataFrame and their SQL oracles."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import buckets, numeric, text
from ..operators.aliases import resolve_aliases, with_final_names
from ..operators.distinct import distinct_counts
from ..operators.ordering import assign_dense_keys
from ..operators.skew import spread_join
from ..session import scratch_path
from ..sources import files
from ..sources.tables import Tables
from . import analytics, bronze, fixtures, gold, silver, star_tables
from . import graph as graph_plans
from .fixtures import star
from .oracle import ANALYSES, BRONZE_GRAPH, MORE, SILVER_GOLD

# Tests run monetary values in thousands (the analogue prices are ~1e3..1e5).
UNIT = 1e3

QUERIES: dict = {}
ORACLE: dict = {}


def register(name: str, oracle: str | None = None):
    def deco(fn):
        QUERIES[name] = fn
        if oracle is not None:
            ORACLE[name] = oracle
        return fn
    return deco


@register("age_effect", ANALYSES["age_effect"])
def q_age_effect(spark, sf_dir):
    s = star(spark, sf_dir)
    return analytics.age_effect(s.fact, unit=UNIT)


@register("industry_dominance", ANALYSES["industry_dominance"])
def q_industry_dominance(spark, sf_dir):
    s = star(spark, sf_dir)
    return analytics.industry_dominance(s.fact, s.dim_company, unit=UNIT)


@register("grit_by_tier", ANALYSES["grit_by_tier"])
def q_grit_by_tier(spark, sf_dir):
    s = star(spark, sf_dir)
    return analytics.grit_by_tier(s.fact, s.dim_executive, unit=UNIT)


@register("rank_correlation", ANALYSES["rank_correlation"])
def q_rank_correlation(spark, sf_dir):
    s = star(spark, sf_dir)
    return analytics.rank_correlation(s.fact, s.dim_executive, unit=UNIT)


@register("value_by_tier", ANALYSES["value_by_tier"])
def q_value_by_tier(spark, sf_dir):
    s = star(spark, sf_dir)
    return analytics.value_by_tier(s.fact, s.dim_executive, unit=UNIT)


@register("factor_dominance", ANALYSES["factor_dominance"])
def q_factor_dominance(spark, sf_dir):
    s = star(spark, sf_dir)
    return analytics.factor_dominance(s.fact, s.dim_company, s.dim_executive)


@register("factor_grouping_sets", ANALYSES["factor_grouping_sets"])
def q_factor_grouping_sets(spark, sf_dir):
    s = star(spark, sf_dir)
    return analytics.factor_groups(s.fact, s.dim_company, s.dim_executive)


# --- functions, silver and gold ---------------------------------------------



def _sg(name):
    return register(name, SILVER_GOLD.get(name))


@_sg("missing_values")
def q_missing_values(spark, sf_dir):
    raw = fixtures.raw_orders_text(Tables(spark, sf_dir).orders)
    return raw.select("o_orderkey", F.col("Industry").alias("raw_text"),
                      text.missing_to_null("Industry").alias("cleaned"))


@_sg("try_numeric")
def q_try_numeric(spark, sf_dir):
    raw = fixtures.raw_orders_text(Tables(spark, sf_dir).orders)
    return raw.select("o_orderkey", F.col("Rank").alias("raw_text"),
                      numeric.coerce_numeric("Rank", "bigint").alias("as_bigint"),
                      numeric.coerce_numeric("Rank", "double").alias("as_double"))


@_sg("parse_money")
def q_parse_money(spark, sf_dir):
    raw = fixtures.raw_orders_text(Tables(spark, sf_dir).orders)
    return raw.select("o_orderkey", "Valuation_Formatted",
                      numeric.parse_money("Valuation_Formatted", 1e9).alias("valuation_usd"))


@_sg("silver_startups")
def q_silver_startups(spark, sf_dir):
    raw = fixtures.raw_orders_text(Tables(spark, sf_dir).orders)
    return silver.refine_startups(raw)


def _raw_profiles(spark, sf_dir):
    t = Tables(spark, sf_dir)
    return fixtures.raw_profiles(t.supplier, t.nation)


def _raw_rankings(spark, sf_dir):
    t = Tables(spark, sf_dir)
    return fixtures.raw_rankings(t.supplier, t.nation, t.region)


@_sg("clean_profiles")
def q_clean_profiles(spark, sf_dir):
    return silver.clean_profiles(_raw_profiles(spark, sf_dir))


@_sg("rank_clean")
def q_rank_clean(spark, sf_dir):
    return silver.clean_rankings(_raw_rankings(spark, sf_dir))


@_sg("rank_number")
def q_rank_number(spark, sf_dir):
    raw = _raw_rankings(spark, sf_dir)
    return raw.select(F.col("Row").alias("s_suppkey"), F.col("QS Rank 2026").alias("rank_text"),
                      text.first_number("QS Rank 2026").alias("QS_Rank_Num"))


@_sg("tier_flag")
def q_tier_flag(spark, sf_dir):
    raw = _raw_rankings(spark, sf_dir)
    r = text.first_number("QS Rank 2026")
    return raw.select(F.col("Row").alias("s_suppkey"), r.alias("QS_Rank_Num"),
                      buckets.rank_tier(r).alias("tier"))


@_sg("best_per_key")
def q_best_per_key(spark, sf_dir):
    return silver.best_rank_per_institution(silver.clean_rankings(_raw_rankings(spark, sf_dir)))


@_sg("rank_enrich")
def q_rank_enrich(spark, sf_dir):
    prof = silver.clean_profiles(_raw_profiles(spark, sf_dir))
    keyed = prof.withColumn("university_match_key", text.name_key("universityLabel"))
    best = silver.best_rank_per_institution(silver.clean_rankings(_raw_rankings(spark, sf_dir)))
    return keyed.join(best.select("university_match_key", "QS_Rank_Num"), "university_match_key", "left") \
        .select("companyLabel", "executiveLabel", "universityLabel", "degreeLabel",
                "university_match_key", "QS_Rank_Num")


@_sg("silver_executive_profiles")
def q_silver_executive_profiles(spark, sf_dir):
    return silver.executive_profiles(_raw_profiles(spark, sf_dir), _raw_rankings(spark, sf_dir))


def _gold_inputs(spark, sf_dir):
    """Silver inputs of the gold jobs, stored once per session and scale.

    Gold reads stored silver tables (as in the layered design), so the
    silver pipeline is not re-run inside every gold query.
    """
    def build():
        t = Tables(spark, sf_dir)
        startups = fixtures.startups_from_part(t.part)
        execs = silver.executive_profiles(fixtures.raw_profiles(t.supplier, t.nation),
                                          fixtures.raw_rankings(t.supplier, t.nation, t.region))
        return {"startups": startups, "executives": execs}
    stored = fixtures.stored_tables(spark, ("gold_inputs", sf_dir), build)
    return stored["startups"], stored["executives"]


def _gold_dims(spark, sf_dir):
    """Both dimensions, keyed and stored once per session and scale, as the gold job reads back what it has written."""
    def build():
        startups, execs = _gold_inputs(spark, sf_dir)
        return {"dim_company": gold.dim_company(startups), "dim_executive": gold.dim_executive(gold.explode_founders(startups), execs)}
    stored = fixtures.stored_tables(spark, ("gold_dims", sf_dir), build)
    return stored["dim_company"], stored["dim_executive"]


@_sg("explode_founders")
def q_explode_founders(spark, sf_dir):
    startups, _ = _gold_inputs(spark, sf_dir)
    return gold.explode_founders(startups)


@_sg("gold_dim_company")
def q_gold_dim_company(spark, sf_dir):
    startups, _ = _gold_inputs(spark, sf_dir)
    return gold.dim_company(startups)


@_sg("gold_dim_executive")
def q_gold_dim_executive(spark, sf_dir):
    startups, execs = _gold_inputs(spark, sf_dir)
    return gold.dim_executive(gold.explode_founders(startups), execs)


@_sg("gold_fact")
def q_gold_fact(spark, sf_dir):
    startups, _ = _gold_inputs(spark, sf_dir)
    dc, de = _gold_dims(spark, sf_dir)
    return gold.fact_valuation_grit(startups, gold.explode_founders(startups), dc, de)


@_sg("coverage_check")
def q_coverage_check(spark, sf_dir):
    startups, _ = _gold_inputs(spark, sf_dir)
    dc, de = _gold_dims(spark, sf_dir)
    fact = gold.fact_valuation_grit(startups, gold.explode_founders(startups), dc, de)
    # a fact that lost every fiftieth company: the check has to name exactly those
    return gold.coverage_check(startups, fact.where(F.col("company_key") % 50 != 0), dc)


@_sg("name_key")
def q_name_key(spark, sf_dir):
    docs = Tables(spark, sf_dir).documents
    return docs.select("doc_id", text.name_key("text").alias("name_key"))


@_sg("content_md5")
def q_content_md5(spark, sf_dir):
    docs = Tables(spark, sf_dir).documents
    return docs.select("doc_id", F.md5(F.col("text")).alias("content_md5"))


@_sg("slug_id")
def q_slug_id(spark, sf_dir):
    part = Tables(spark, sf_dir).part
    return part.select("p_partkey", text.slug("p_name").alias("slug"),
                       F.concat(text.slug("p_name"), F.lit("_"), text.slug("p_type")).alias("composite_id"))


@_sg("dense_keys")
def q_dense_keys(spark, sf_dir):
    part = Tables(spark, sf_dir).part.select("p_partkey", "p_name", "p_brand")
    return assign_dense_keys(part, ["p_name", "p_partkey"], key="key")


@_sg("grit_index")
def q_grit_index(spark, sf_dir):
    t = Tables(spark, sf_dir)
    de = fixtures.dim_executive(t.supplier).select("executive_key", "tier_flag")
    li = t.lineitem.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")
    j = li.join(t.part.select("p_partkey", "p_size"), li["l_partkey"] == F.col("p_partkey")) \
          .join(de, li["l_suppkey"] == de["executive_key"])
    return j.select("l_orderkey", "l_linenumber",
                    buckets.grit_index("p_size", "tier_flag").alias("experience_grit_index"))


# --- bronze and the graph pattern ---------------------------------------------


def _bg(name):
    return register(name, BRONZE_GRAPH.get(name))


@_bg("ingest_manifest")
def q_ingest_manifest(spark, sf_dir):
    docs = Tables(spark, sf_dir).documents
    listing = fixtures.document_listing(docs).where(bronze.extension_filter("object_name"))
    plan = bronze.plan_ingest(listing, fixtures.prior_manifest(docs))
    return plan.select("object_name", text.base_name("object_name").alias("file_name"),
                       "source_system", "content_md5", "size", "action")


@_bg("latest_object")
def q_latest_object(spark, sf_dir):
    listing = fixtures.document_listing(Tables(spark, sf_dir).documents)
    return bronze.latest_object(listing, "_ranking_", ".xlsx", group=["source"])


@_bg("storage_footprint")
def q_storage_footprint(spark, sf_dir):
    return bronze.storage_footprint(fixtures.footprint_sizes(Tables(spark, sf_dir).documents))


def _triples(spark, sf_dir):
    return graph_plans.triples_from_tables(Tables(spark, sf_dir))


@_bg("subclass_closure")
def q_subclass_closure(spark, sf_dir):
    triples, _ = _triples(spark, sf_dir)
    return graph_plans.subclass_closure(triples)


@_bg("class_closure")
def q_class_closure(spark, sf_dir):
    triples, _ = _triples(spark, sf_dir)
    return graph_plans.class_closure(triples).select("node", "anc")


@_bg("bgp_join")
def q_bgp_join(spark, sf_dir):
    triples, labels = _triples(spark, sf_dir)
    return graph_plans.bgp_join(triples, labels)


# --- file sources ---------------------------------------------------------------

CUSTOMER_SCHEMA = ("c_custkey BIGINT, c_name STRING, c_nationkey INT, c_acctbal DOUBLE, "
                   "c_mktsegment STRING")
# quotes, separators, padding, line ends and nulls that a delimited file must give back
NOTE_SQL = ("CASE c_custkey % 6 WHEN 0 THEN 'a\"b ' || c_name WHEN 1 THEN 'x,\"y\",' || c_name WHEN 2 THEN '  ' || c_name || ' ' "
            "WHEN 3 THEN c_name || chr(10) || 'next' WHEN 4 THEN '\"' END")
CUSTOMER_SQL = "SELECT c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment FROM customer"


@register("csv_roundtrip", CUSTOMER_SQL.replace(" FROM", f", {NOTE_SQL} AS c_note FROM"))
def q_csv_roundtrip(spark, sf_dir):
    """``customer`` with awkward notes, written as delimited text to the shared folder and read back."""
    path = scratch_path(spark, "csv")
    files.write_csv(Tables(spark, sf_dir).customer.withColumn("c_note", F.expr(NOTE_SQL)), path)
    return files.read_csv(spark, path, CUSTOMER_SCHEMA + ", c_note STRING", multi_line=True)


PREAMBLE = ["QS World University Rankings,", "exported from the ranking sheet,"]


@register("preamble_scan", CUSTOMER_SQL)
def q_preamble_scan(spark, sf_dir):
    """``customer`` written with two preamble lines before each header and read back."""
    path = scratch_path(spark, "preamble")
    fixtures.write_with_preamble(Tables(spark, sf_dir).customer, path, PREAMBLE)
    df = files.read_with_preamble(spark, path, header_row=len(PREAMBLE),
                                  types={"c_custkey": "bigint", "c_nationkey": "int",
                                         "c_acctbal": "double"})
    return df.select("c_custkey", "c_name", "c_nationkey", "c_acctbal", "c_mktsegment")


# --- operators and sinks on their own -----------------------------------------


def _more(name):
    return register(name, MORE[name])


@_more("numeric_types")
def q_numeric_types(spark, sf_dir):
    """A column with fractions becomes double, a whole one bigint; decided by the values."""
    raw = fixtures.raw_orders_text(Tables(spark, sf_dir).orders)
    halves = F.when((F.col("o_orderkey") % 3 == 0) & (F.col("Rank") != "n/a"), F.concat("Rank", F.lit(".5"))).otherwise(F.col("Rank"))
    return silver.refine_startups(raw.select("o_orderkey", halves.alias("Rank"), "Year_Founded"))


@_more("hot_key_join")
def q_hot_key_join(spark, sf_dir):
    """Half of all rows share one founder; the N:M join deals them over many tasks."""
    t = Tables(spark, sf_dir)
    founder = F.when(F.col("o_orderkey") % 2 == 0, F.lit(text.UNKNOWN_FOUNDER)).otherwise(F.concat(F.lit("Founder "), F.col("o_custkey").cast("string")))
    schools = t.customer.select(F.concat(F.lit("Founder "), F.col("c_custkey").cast("string")).alias("founder"), F.col("c_custkey").alias("school")) \
        .unionByName(t.region.select(F.lit(text.UNKNOWN_FOUNDER).alias("founder"), F.col("r_regionkey").cast("bigint").alias("school")))
    joined = spread_join(t.orders.select("o_orderkey", founder.alias("founder")), schools, "founder")
    return joined.select("o_orderkey", "founder", "school")


@_more("distinct_bitmaps")
def q_distinct_bitmaps(spark, sf_dir):
    items = Tables(spark, sf_dir).lineitem.select("l_returnflag", "l_linestatus", "l_orderkey", "l_partkey", "l_suppkey")
    return distinct_counts(items, ["l_returnflag", "l_linestatus"], {"orders": "l_orderkey", "parts": "l_partkey", "suppliers": "l_suppkey"})


@_more("alias_resolution")
def q_alias_resolution(spark, sf_dir):
    """Orders under the final name of their customer; every customer but each ninth is an alias of the next one."""
    t = Tables(spark, sf_dir)
    name = lambda k: F.concat(F.lit("Customer "), k.cast("string"))
    k = F.col("c_custkey")
    aliases = resolve_aliases(t.customer.where(k % 9 != 0).select(name(k).alias("alias"), name(k + 1).alias("name")))
    return with_final_names(t.orders.select("o_orderkey", name(F.col("o_custkey")).alias("customer")), "customer", aliases)


@_more("quarantine_scan")
def q_quarantine_scan(spark, sf_dir):
    """``customer`` with broken records: good rows, the records read back from the quarantine, and how many there are of each kind."""
    path, sink = scratch_path(spark, "broken"), scratch_path(spark, "quarantine")
    fixtures.write_broken_csv(Tables(spark, sf_dir).customer, path)
    checked = files.read_csv_checked(spark, path, "c_custkey BIGINT, c_name STRING, c_nationkey INT")
    good, counts = files.quarantine(checked, sink, "first")
    bad = spark.read.parquet(sink).select("problem", "record")
    rows = good.unionByName(bad, allowMissingColumns=True)
    named = counts.select(F.col("problem").alias("_problem"), "records")
    return rows.join(named, rows["problem"].eqNullSafe(named["_problem"])).drop("_problem")


@_bg("layer_footprint")
def q_layer_footprint(spark, sf_dir):
    """The footprint of folders that hold ``documents`` as text files, from listed sizes."""
    base = scratch_path(spark, "layers")
    tables = fixtures.write_layers(Tables(spark, sf_dir).documents, base)
    return bronze.layer_footprint(spark, f"{base}/bronze", tables)


@_bg("landing_run")
def q_landing_run(spark, sf_dir):
    """A drop zone of one file a supplier is landed, every third file changes, and it is landed again: all landed versions."""
    base, supplier = scratch_path(spark, "zone"), Tables(spark, sf_dir).supplier
    # between the runs only: written a third time, the changed files would hold the same bytes, which no run would read
    for run, files, suffix in (("one", supplier, ""), ("two", supplier.where(F.col("s_suppkey") % 3 == 0), "changed")):
        fixtures.write_drop_zone(files, f"{base}/drop", suffix)
        bronze.land(spark, f"{base}/drop", f"{base}/bronze", f"{base}/manifest", run=run)
    sizes = spark.read.parquet(f"{base}/bronze").select("object_name", F.col("content_md5").alias("original_md5"), "size")
    now = bronze.current_objects(spark, f"{base}/bronze", f"{base}/manifest").select(
        "object_name", F.col("content_md5").alias("original_md5"), F.lit(True).alias("_now"))
    rows = bronze.read_manifest(spark, f"{base}/manifest")
    stamped = F.col("ingestion_timestamp").between(F.current_timestamp() - F.expr("INTERVAL 1 DAY"), F.current_timestamp())
    return rows.join(sizes, ["object_name", "original_md5"]).join(now, ["object_name", "original_md5"], "left").select(
        "object_name", "original_md5", "size", "source_system", "operator_id", stamped.alias("stamped"),
        F.coalesce("_now", F.lit(False)).alias("is_current"))


@_more("bucketed_star")
def q_bucketed_star(spark, sf_dir):
    """The star written as bucketed catalog tables and read back for an analysis."""
    s = star(spark, sf_dir)
    path = scratch_path(spark, "star")
    tables = star_tables.save_star(s.fact, s.dim_company, s.dim_executive, path, "star_" + path.rsplit("-", 1)[-1],
                                   int(spark.conf.get("spark.sql.shuffle.partitions")))
    back = tables.read(spark)
    return analytics.value_by_tier(back["fact_by_executive"], back["dim_executive"], unit=UNIT)


def _written_gold(spark, sf_dir):
    startups, execs = _gold_inputs(spark, sf_dir)
    path = scratch_path(spark, "gold")
    return path, gold.write_gold(startups, execs, path)


@_more("gold_roundtrip")
def q_gold_roundtrip(spark, sf_dir):
    """The fact as written by the gold job, read back."""
    return spark.read.parquet(f"{_written_gold(spark, sf_dir)[0]}/fact_valuation_grit")


@_more("gold_write_metrics")
def q_gold_write_metrics(spark, sf_dir):
    """Rows and null keys that the three gold writes counted themselves."""
    rows = [(t, m["rows"], sum(v for k, v in m.items() if k.startswith("null_"))) for t, m in _written_gold(spark, sf_dir)[1].items()]
    return spark.createDataFrame(rows, "table_name string, rows bigint, null_keys bigint")


@_more("silver_roundtrip")
def q_silver_roundtrip(spark, sf_dir):
    path = scratch_path(spark, "silver")
    silver.write_table(silver.executive_profiles(_raw_profiles(spark, sf_dir), _raw_rankings(spark, sf_dir)), path,
                       contract="silver.executive_profiles")
    return spark.read.parquet(path)


@_more("registered_views")
def q_registered_views(spark, sf_dir):
    """SQL over the stored gold tables, registered as views."""
    from ..jobs import register_views
    register_views(spark, _written_gold(spark, sf_dir)[0])
    return spark.sql("""
        SELECT c.industry, COUNT(DISTINCT f.company_key) AS companies, COUNT(*) AS pairs, MAX(f.valuation_usd) AS highest
        FROM fact_valuation_grit f JOIN dim_company c ON f.company_key = c.company_key GROUP BY c.industry""")

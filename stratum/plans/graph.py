"""Graph-pattern extraction over triples (the profile extract as Spark work).

``triples_from_tables`` turns the driver's tables into ``(s, p, o)`` triples
and ``labels (id, lang, text)``:

* ``c:<customer> P31 n:<nation>`` (instance of), and class links
  ``n:<nation> P279 r:<region>``, ``r:<region> P279 root`` (subclass of);
* ``c:<customer> P169 o:<order>`` (company -> executive),
* ``o:<order> P69 s:<supplier>`` (executive -> university, from lineitem),
* ``s:<supplier> P31 t:<region>`` (university type),
* ``o:<order> P512 d:<priority>`` for finished orders (optional degree);
* labels for customers, suppliers and priorities (orders have none).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.graph import closure, instances_below, path_then_star
from ..session import materialize
from ..sources.tables import Tables, spread

# --- fixed values that must equal the reference's --------------------------
INSTANCE_OF, SUBCLASS_OF, EXECUTIVE, EDUCATED_AT, DEGREE = "P31", "P279", "P169", "P69", "P512"
# ---------------------------------------------------------------------------

# the four accepted institution kinds of the pattern (VALUES restriction)
UNIVERSITY_KINDS = ("t:0", "t:1", "t:2", "t:3")


def _id(prefix: str, col: str):
    return F.concat(F.lit(prefix), F.col(col).cast("string"))


def triples_from_tables(t: Tables) -> tuple[DataFrame, DataFrame]:
    cust, orders, nation, region = t.customer, t.orders, t.nation, t.region
    # building string ids is per-row work: spread an under-split scan
    li, supp = spread(t.lineitem.select("l_orderkey", "l_suppkey")), t.supplier
    tri = [
        cust.select(_id("c:", "c_custkey").alias("s"), F.lit(INSTANCE_OF).alias("p"),
                    _id("n:", "c_nationkey").alias("o")),
        nation.select(_id("n:", "n_nationkey").alias("s"), F.lit(SUBCLASS_OF).alias("p"),
                      _id("r:", "n_regionkey").alias("o")),
        region.select(_id("r:", "r_regionkey").alias("s"), F.lit(SUBCLASS_OF).alias("p"),
                      F.lit("root").alias("o")),
        orders.select(_id("c:", "o_custkey").alias("s"), F.lit(EXECUTIVE).alias("p"),
                      _id("o:", "o_orderkey").alias("o")),
        li.select(_id("o:", "l_orderkey").alias("s"), F.lit(EDUCATED_AT).alias("p"),
                  _id("s:", "l_suppkey").alias("o")),
        supp.join(nation, supp["s_nationkey"] == nation["n_nationkey"])
            .select(_id("s:", "s_suppkey").alias("s"), F.lit(INSTANCE_OF).alias("p"),
                    _id("t:", "n_regionkey").alias("o")),
        orders.where(F.col("o_orderstatus") == "F")
              .select(_id("o:", "o_orderkey").alias("s"), F.lit(DEGREE).alias("p"),
                      _id("d:", "o_orderpriority").alias("o")),
    ]
    triples = tri[0]
    for x in tri[1:]:
        triples = triples.unionByName(x)
    labels = (cust.select(_id("c:", "c_custkey").alias("id"), F.col("c_name").alias("text"))
              .unionByName(supp.select(_id("s:", "s_suppkey").alias("id"), F.col("s_name").alias("text")))
              .unionByName(orders.select(_id("d:", "o_orderpriority").alias("id"),
                                         F.col("o_orderpriority").alias("text")).distinct())
              .withColumn("lang", F.lit("en")))
    return triples, labels


def subclass_closure(triples: DataFrame) -> DataFrame:
    """``?x P31/P279* ?class`` for every instance."""
    return path_then_star(triples, INSTANCE_OF, SUBCLASS_OF)


def class_closure(triples: DataFrame) -> DataFrame:
    """Every node with all its ancestors over is-a edges (instance-of or
    subclass-of), zero steps included: ``?x (P31|P279)* ?y``."""
    isa = triples.where(F.col("p").isin(INSTANCE_OF, SUBCLASS_OF)).select("s", "o").distinct()
    return closure(isa)


def bgp_join(triples: DataFrame, labels: DataFrame, target_class: str = "root",
             kinds=UNIVERSITY_KINDS, lang: str = "en") -> DataFrame:
    """Company -> executive -> university pattern with labels, distinct.

    Inner joins of filtered triple sets, a semi join for the kinds list,
    a left join for the optional degree and left joins to the label table
    (an id without a label in ``lang`` is its own label).

    Every node gets its label where it has the fewest rows: universities, degrees and companies before they meet the
    executives, executives before they meet the largest input (executive -> university edges).  That input is
    dealt out once for the join and once for the distinct; repeated edges wait for the latter.
    """
    lab = labels.where(F.col("lang") == lang).select(F.col("id").alias("_id"), F.col("text").alias("_text"))

    def named(df, col):
        return (df.join(lab, F.col(col) == F.col("_id"), "left")
                .withColumn(f"{col}Label", F.coalesce("_text", col)).drop("_id", "_text"))

    def pairs(predicate, s, o):
        return triples.where(F.col("p") == predicate).select(F.col("s").alias(s), F.col("o").alias(o))

    # stored, so that their sizes are known before the large sides are dealt out
    universities = materialize(named(
        pairs(INSTANCE_OF, "university", "kind").where(F.col("kind").isin(*kinds)).select("university").distinct(), "university"), "universities")
    degrees = materialize(named(pairs(DEGREE, "_", "degree").select("degree").distinct(), "degree"), "degrees")
    companies = named(instances_below(triples, INSTANCE_OF, SUBCLASS_OF, target_class)
                      .select(F.col("entity").alias("company")), "company")
    # an absent optional degree has no label either
    degree = pairs(DEGREE, "_executive", "_degree").join(degrees, F.col("_degree").eqNullSafe(F.col("degree"))) \
        .select("_executive", "degreeLabel").repartition("_executive").distinct()
    execs = named(pairs(EXECUTIVE, "company", "executive").join(companies, "company").select("executive", "companyLabel"), "executive")
    execs = (execs.join(degree, F.col("executive") == F.col("_executive"), "left")
             .select("executive", "companyLabel", "executiveLabel", "degreeLabel").distinct())
    study = pairs(EDUCATED_AT, "executive", "university").join(universities, "university").select("executive", "universityLabel")
    return study.join(execs, "executive").select("companyLabel", "executiveLabel", "universityLabel", "degreeLabel").distinct()

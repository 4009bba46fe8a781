"""The corpus pipeline: documents through five training-text operators, stage by stage.

Every stage takes all rows its predecessor kept and, but for the last, returns the columns of ``documents``.
Stages that decide about documents give every row a number of its own first and decide by it, so rows with a null doc_id and rows
that share one are judged by their texts like any other.  An empty table passes through as one.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stratum.llm.chunks import remove_spans, repeated_spans
from stratum.llm.decontaminate import contaminated
from stratum.llm.minhash import near_duplicates
from stratum.llm.packing import packed
from stratum.llm.quality import filtered
from stratum.llm.store import free_name, store, unstore

# gear-hash chunking has no SQL form; tests compare the stages with brute-force versions
ORACLE_SQL = None


def _numbered(docs: DataFrame) -> tuple[DataFrame, str]:
    """``docs`` with a number for every row, and that column's name.

    A doc_id that one row has is its number; rows that share a doc_id or have none get numbers beyond the greatest doc_id, in a written table.
    """
    row = free_name(docs, "row_number")
    ids = docs.select(F.col("doc_id").cast("long").alias("shared")).groupBy("shared").agg(F.count(F.lit(1)).alias("n"))
    shared, _ = store(ids.where("n > 1 OR shared IS NULL").select("shared"), "shared-ids")
    if shared.isEmpty():
        return docs.withColumn(row, F.col("doc_id").cast("long")), row
    top = docs.agg(F.max(F.col("doc_id").cast("long"))).first()[0] or 0
    marked = docs.join(shared.select("shared", F.lit(True).alias(row)), F.col("doc_id").eqNullSafe(F.col("shared")), "left").drop("shared")
    number = F.when(F.col(row), F.monotonically_increasing_id() + (top + 1)).otherwise(F.col("doc_id").cast("long"))
    return store(marked.withColumn(row, number), "numbered")[0], row


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Quality rules: documents that the base rules or their group's adaptive thresholds reject go."""
    return filtered(docs)


def near_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """MinHash near-dedup on five-word shingles at 0.8: the row with the smallest doc_id of each group stays (null ids last)."""
    numbered, row = _numbered(docs)
    groups = near_duplicates(numbered, id_col=row, width=5, percent=80).select(row, "component_id")
    order = F.struct(F.col("doc_id").isNull().alias("absent"), "doc_id", row)
    keys = numbered.select(row, "doc_id").join(groups, row).withColumn("order", order)
    first = keys.groupBy("component_id").agg(F.min("order").alias("order")).select(F.col(f"order.{row}").alias(row))
    return numbered.join(first, row, "left_semi").select(*docs.columns)


def substring_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Substring dedup: stretches of 50 words or more that repeat an earlier one are cut out; n_chars follows."""
    numbered, row = _numbered(docs)
    out = remove_spans(numbered, repeated_spans(numbered, id_col=row), id_col=row).select(*docs.columns)
    return out.withColumn("n_chars", F.coalesce(F.length("text").cast("long"), F.col("n_chars")))


def decontamination_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Benchmark decontamination: documents that overlap a benchmark item go."""
    numbered, row = _numbered(docs)
    hit = contaminated(numbered, spark.read.parquet(f"{sf_dir}/benchmark.parquet"), id_col=row).select(row).distinct()
    return numbered.join(hit, row, "left_anti").select(*docs.columns)


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Packing: each document's length bucket, batch and place in it."""
    return packed(docs)


STAGES = [
    ("quality_rules", quality_stage),
    ("near_dedup", near_dedup_stage),
    ("substring_dedup", substring_stage),
    ("decontamination", decontamination_stage),
    ("packing", packing_stage),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows of the last stage for ``sf_dir``'s documents; each other stage's result is a written table, deleted once the next one is written."""
    docs, before = spark.read.parquet(f"{sf_dir}/documents.parquet"), None
    for k, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k + 1 < len(STAGES):
            docs, path = store(docs, name)
            if before:
                unstore(spark, before)
            before = path
    return docs

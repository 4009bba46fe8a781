"""Bronze layer: incremental landing tracked by content hash, object listings.

A drop zone is a file listing ``(object_name, content_md5, size, ...)``.
For real files it comes from the ``binaryFile`` source (executors read and
hash the bytes); for tables it can be any DataFrame with those columns.
"""

from __future__ import annotations

import re
import uuid

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.numeric import kb_text, safe_pct
from ..functions.text import base_name, year_in_name
from ..operators.checks import CheckFailed
from ..session import materialize
from ..sources import blocks
from ..sources.files import read_binary
from ..sources.listing import Prefix, assign_prefixes, list_objects, log_folders

# --- fixed values that must equal the reference's --------------------------
SUPPORTED_EXTENSIONS = (".csv", ".json", ".xml", ".xlsx", ".txt")
SOURCE_LOCAL = "local_file_system"
SOURCE_API = "wikidata_sparql_api"
# the report's summary rows: dataset, component, format
TOTAL_BRONZE = ("bronze_total", "raw_footprint", "raw")
TOTAL_SILVER_DATA = ("silver_data_total", "parquet_footprint", "parquet")
TOTAL_SILVER_LOG = ("silver_delta_log_total", "versioning_overhead", "delta_log")
TOTAL_SILVER = ("silver_total_with_delta_log", "delta_footprint", "delta/parquet")
DATA_REDUCTION = ("parquet_data_reduction_pct", "metric", "metric")
TOTAL_REDUCTION = ("delta_total_reduction_pct", "metric", "metric")
LOG_FORMAT = "json/checkpoint"
# ---------------------------------------------------------------------------

BIG = 1 << 30     # files above this many bytes are read by split

MANIFEST_SCHEMA = T.StructType([
    T.StructField("object_name", T.StringType(), False),
    T.StructField("original_md5", T.StringType(), False),
    T.StructField("source_system", T.StringType(), True),
    T.StructField("operator_id", T.StringType(), True),
    T.StructField("ingestion_timestamp", T.TimestampType(), True),
])


def extension_filter(col) -> "F.Column":
    """Object names with a supported extension (case-sensitive suffix)."""
    c = F.col(col) if isinstance(col, str) else col
    cond = None
    for ext in SUPPORTED_EXTENSIONS:
        e = c.endswith(ext)
        cond = e if cond is None else cond | e
    return cond


def list_files(spark: SparkSession, drop_zone: str, api_pattern: str | None = None, big: int = BIG) -> DataFrame:
    """Drop-zone listing, hashed on executors.

    Columns: path, uri, object_name (base name), content_md5, size,
    modification_time, source_system.  Files of up to ``big`` bytes are read whole (``binaryFile``) and have the MD5 of their bytes; larger ones are
    read by split and have a digest that merges over blocks, ``blocks-<size>-<sums>``, in the same column.
    """
    src = F.lit(SOURCE_LOCAL)
    if api_pattern:
        src = F.when(F.col("path").rlike(api_pattern), F.lit(SOURCE_API)).otherwise(src)

    def listed(files: DataFrame, digest) -> DataFrame:
        return files.select(
            "path", F.col("_metadata.file_path").alias("uri"), base_name("path").alias("object_name"),
            digest.alias("content_md5"), F.col("length").alias("size"),
            F.col("modificationTime").alias("modification_time"), src.alias("source_system"))

    files = read_binary(spark, drop_zone).where(extension_filter("path"))
    small = listed(files.where(F.col("length") <= big), F.md5("content"))
    large = listed(files.where(F.col("length") > big), F.lit(None).cast("string"))
    paths = [r[0] for r in large.select("path").collect()]
    if not paths:
        return small
    sums = blocks.file_digests(spark, _literal_paths(paths)).withColumnRenamed("path", "uri")
    named = large.drop("content_md5").join(sums, "uri").withColumn("content_md5", F.concat(
        F.lit("blocks-"), F.col("size").cast("string"), F.lit("-"), F.col("sums")))
    return small.unionByName(named.select(*small.columns))


def _literal_paths(paths: list[str]) -> list[str]:
    """Paths with the characters that Hadoop would read as patterns escaped."""
    return [re.sub(r"([\[\]{}*?\\])", r"\\\1", p) for p in paths]


def plan_ingest(listing: DataFrame, manifest: DataFrame) -> DataFrame:
    """Classify every listed object: ``new``, ``changed`` or ``unchanged``.

    A left join of the listing to the newest manifest row of each object
    (a partial aggregate; then both sides shuffle on the name, or the manifest is
    broadcast when AQE measures it small).  The manifest holds the content
    MD5 itself, so a multi-part upload never looks changed.
    """
    newest = F.max_by("original_md5", F.struct("ingestion_timestamp", "original_md5"))
    m = manifest.groupBy(F.col("object_name").alias("_name")).agg(newest.alias("_stored_md5"))
    j = listing.join(m, listing["object_name"] == m["_name"], "left")
    action = (F.when(F.col("_name").isNull(), F.lit("new"))
              .when(F.col("_stored_md5") != F.col("content_md5"), F.lit("changed"))
              .otherwise(F.lit("unchanged")))
    return j.withColumn("action", action).drop("_name", "_stored_md5")


def manifest_rows(plan: DataFrame, operator_id: str = "data_engineer") -> DataFrame:
    """Manifest entries for the objects that must be (re)landed."""
    return plan.where(F.col("action") != "unchanged").select(
        "object_name", F.col("content_md5").alias("original_md5"), "source_system",
        F.lit(operator_id).alias("operator_id"),
        F.current_timestamp().alias("ingestion_timestamp"))


def write_run(df: DataFrame, path: str, run: str, metrics: dict | None = None) -> dict:
    """Write ``df`` as partition ``run=<run>`` of ``path``, replacing only that partition; returns what ``metrics`` (aggregates) came to.

    Replaying the same run (a retried job, a re-executed micro-batch)
    overwrites its own output instead of appending a second copy.
    """
    seen = Observation()
    if metrics:
        df = df.observe(seen, *[c.alias(n) for n, c in metrics.items()])
    (df.withColumn("run", F.lit(run)).write.mode("overwrite")
       .option("partitionOverwriteMode", "dynamic").partitionBy("run").parquet(path))
    return seen.get if metrics else {}


def read_manifest(spark: SparkSession, manifest_path: str) -> DataFrame:
    """Stored manifest rows; empty before the first run, an error if what is there cannot be read."""
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(manifest_path)
    if not path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(path):
        return spark.createDataFrame([], MANIFEST_SCHEMA)
    return spark.read.parquet(manifest_path).select(*[f.name for f in MANIFEST_SCHEMA.fields])


def current_objects(spark: SparkSession, bronze_path: str, manifest_path: str) -> DataFrame:
    """The landed objects as they are now: of every object, the content of its newest manifest row; large ones have a row for each part."""
    newest = F.max_by("original_md5", F.struct("ingestion_timestamp", "original_md5"))
    now = read_manifest(spark, manifest_path).groupBy("object_name").agg(newest.alias("content_md5"))
    landed = spark.read.parquet(bronze_path)
    return landed.join(now, ["object_name", "content_md5"], "left_semi") \
        .dropDuplicates(["object_name", "content_md5", "part"])


def land(spark: SparkSession, drop_zone: str, bronze_path: str, manifest_path: str,
         operator_id: str = "data_engineer", api_pattern: str | None = None,
         run: str | None = None, big: int = BIG, metrics: dict | None = None) -> DataFrame:
    """Land new and changed files; returns the ingest plan.

    Contents are written before manifest rows, each into this run's own
    partition: a crash in between re-lands the files on the next run, and
    repeating a run id replaces its output.  Running twice lands nothing
    the second time.  Every file is read once to be hashed; once more are read those to land and any modified after the oldest of them.
    Files of more than ``big`` bytes are hashed and landed by split, in several rows numbered by ``part``; no task holds such a file.

    The write of the contents counts objects, bytes and whole files whose bytes are no longer those that were hashed.  If one has changed
    meanwhile or an object is missing, ``CheckFailed`` is raised and no manifest row is written, so the next run lands them again.
    ``metrics``, a dictionary, receives the counts of both writes.
    """
    listing = list_files(spark, drop_zone, api_pattern, big)
    plan = plan_ingest(listing, read_manifest(spark, manifest_path))
    # keep one fixed plan for both writes below
    plan = materialize(plan, "ingest-plan")
    run = run or f"batch-{uuid.uuid4().hex}"
    todo = plan.where(F.col("action") != "unchanged")
    columns = ["object_name", "part", "content", "content_md5", "source_system", "size", "modification_time"]
    small = F.col("size") <= big
    chosen, oldest = todo.agg(F.count(F.lit(1)), F.min(F.when(small, F.unix_micros("modification_time")))).first()
    parts = [r[0] for r in todo.where(~small).select("path").collect()]
    landed = None
    if oldest is not None:
        # by their times and lengths, which a listing tells, files that have not changed since the oldest of these stay closed
        recent = (F.col("modificationTime") >= F.timestamp_micros(F.lit(oldest))) & (F.col("length") <= big)
        contents = read_binary(spark, drop_zone).where(recent).select("path", "content", F.lit(0).cast("long").alias("part"))
        landed = todo.join(contents, "path").select(*columns)
    if parts:
        contents = blocks.file_parts(spark, _literal_paths(parts)).withColumnRenamed("path", "uri")
        more = todo.join(contents, "uri").select(*columns)
        landed = more if landed is None else landed.unionByName(more)
    if landed is not None:
        whole_file = (F.col("part") == 0) & ~F.col("content_md5").startswith("blocks-")
        got = write_run(landed, bronze_path, run, {
            "objects": F.count_if(F.col("part") == 0), "bytes": F.sum(F.octet_length("content")),
            "changed": F.count_if(whole_file & (F.md5("content") != F.col("content_md5")))})
        got["missing"] = chosen - got["objects"]
        if broken := [m for m in ("changed", "missing") if got[m]]:
            raise CheckFailed(bronze_path, got, broken)
        rows = write_run(manifest_rows(todo, operator_id), manifest_path, run, {"rows": F.count(F.lit(1))})
        if metrics is not None:
            metrics.update(contents=got, manifest=rows)
    return plan


def latest_object(listing: DataFrame, keyword: str, extension: str,
                  group: list[str] | None = None) -> DataFrame:
    """Newest object per group: greatest (year in name, modification time, name).

    ``max(struct(...))`` is a partial aggregate, so a group holding most
    objects is still reduced map-side.
    """
    cand = listing.where(F.col("object_name").contains(keyword) &
                         F.col("object_name").endswith(extension))
    packed = F.struct(year_in_name("object_name").alias("year"),
                      F.col("modification_time").alias("modification_time"),
                      F.col("object_name").alias("object_name"))
    grouped = cand.groupBy(*group) if group else cand.groupBy()
    best = grouped.agg(F.max(packed).alias("_b"))
    return best.select(*(group or []), F.col("_b.object_name").alias("object_name"),
                       F.col("_b.year").alias("year"),
                       F.col("_b.modification_time").alias("modification_time"))


def storage_footprint(sizes: DataFrame) -> DataFrame:
    """Footprint report from (layer, dataset, component, format, size) rows.

    Byte totals per component, layer totals and the two reduction
    percentages with a zero guard.  Columns: layer, dataset,
    component, format, value, unit, size_kb.
    """
    # one grouped pass; its output is bounded by the number of
    # (layer, dataset, component, format) combinations, the totals come from it
    detail = sizes.groupBy("layer", "dataset", "component", "format").agg(
        F.sum("size").cast("double").alias("value"))
    totals = detail.groupBy().agg(
        F.sum(F.when(F.col("layer") == "bronze", F.col("value"))).alias("bronze"),
        F.sum(F.when((F.col("layer") == "silver") & (F.col("component") != "delta_log"),
                     F.col("value"))).alias("silver_data"),
        F.sum(F.when((F.col("layer") == "silver") & (F.col("component") == "delta_log"),
                     F.col("value"))).alias("silver_log"))
    totals = totals.select(*[F.coalesce(F.col(c), F.lit(0.0)).alias(c)
                             for c in ("bronze", "silver_data", "silver_log")])

    def entry(labels, value, unit):
        dataset, component, fmt = labels
        return F.struct(F.lit(dataset).alias("dataset"), F.lit(component).alias("component"), F.lit(fmt).alias("format"),
                        value.cast("double").alias("value"), F.lit(unit).alias("unit"))

    b, sd, sl = F.col("bronze"), F.col("silver_data"), F.col("silver_log")
    summary = totals.select(F.inline(F.array(
        entry(TOTAL_BRONZE, b, "bytes"), entry(TOTAL_SILVER_DATA, sd, "bytes"), entry(TOTAL_SILVER_LOG, sl, "bytes"),
        entry(TOTAL_SILVER, sd + sl, "bytes"), entry(DATA_REDUCTION, safe_pct(b - sd, b), "percent"),
        entry(TOTAL_REDUCTION, safe_pct(b - sd - sl, b), "percent"),
    ))).select(F.lit("summary").alias("layer"), "dataset", "component", "format", "value", "unit")
    rows = detail.withColumn("unit", F.lit("bytes")).unionByName(summary)
    return rows.withColumn("size_kb", kb_text("value", "unit"))


def layer_footprint(spark: SparkSession, bronze_root: str, silver_tables: dict[str, str]) -> DataFrame:
    """The footprint report of real folders: a bronze root and silver tables (name to path), from listed sizes alone.

    Each object below the bronze root is a raw file of the dataset that its first folder (or its own name) gives; a silver table's
    files are its data, but for those in its log folder.
    """
    logs = log_folders(spark, *silver_tables.values())
    rules = [Prefix(bronze_root, "bronze", "raw_file")]
    for name, path in silver_tables.items():
        rules += [Prefix(path, "silver", "parquet_data", name), Prefix(f"{path.rstrip('/')}/_delta_log", "silver", "delta_log", name, LOG_FORMAT)]
    return storage_footprint(assign_prefixes(list_objects(spark, bronze_root, *silver_tables.values(), *logs), rules))

"""Listing stored objects and assigning them to the layers they belong to; no content is read."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Prefix:
    """What lies at or below ``path``: its layer, and optionally its dataset, component and format.

    Without a dataset the next part of the object's path names it; without a format the object's extension does.
    """

    path: str
    layer: str
    component: str
    dataset: str | None = None
    format: str | None = None


def list_objects(spark: SparkSession, *roots: str) -> DataFrame:
    """(path, size, modification_time) of all files at and below ``roots``, from file metadata alone.

    The ``binaryFile`` source lists folders (in parallel when there are many) and leaves files closed when ``content`` is not asked for.
    Spark's listings skip what lies in folders whose names begin with ``_`` or ``.``; give such a folder, a
    table's log for example, as a root of its own.  Empty files are not listed.
    """
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(list(roots))
    return files.select("path", F.col("length").alias("size"), F.col("modificationTime").alias("modification_time"))


def log_folders(spark: SparkSession, *tables: str, name: str = "_delta_log") -> list[str]:
    """The folders called ``name`` that exist directly below ``tables``."""
    hadoop, out = spark.sparkContext._jsc.hadoopConfiguration(), []
    for table in tables:
        path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{table.rstrip('/')}/{name}")
        if path.getFileSystem(hadoop).exists(path):
            out.append(path.toString())
    return out


def _plain(path):
    """A path without scheme and doubled slashes, so that differently written URIs compare."""
    c = F.col(path) if isinstance(path, str) else path
    return F.regexp_replace(F.regexp_replace(c, "^[a-zA-Z][a-zA-Z0-9+.-]*:", ""), "/+", "/")


def assign_prefixes(objects: DataFrame, prefixes: list[Prefix]) -> DataFrame:
    """(path, size, layer, dataset, component, format) of every object that lies below one of ``prefixes``; the longest one decides.

    Every object meets the rules by an equi-join on its own path and the folders above it, so the number of rules
    does not matter; then one row per object is kept by a partial aggregate.
    """
    spark = objects.sparkSession
    rules = spark.createDataFrame([(p.path.rstrip("/"), p.layer, p.dataset, p.component, p.format) for p in prefixes],
                                  "rule string, layer string, dataset string, component string, format string")
    rules = rules.withColumn("rule", _plain("rule")).withColumn("depth", F.size(F.split("rule", "/")))
    parts = F.split(_plain("path"), "/")
    above = F.transform(F.sequence(F.lit(1), F.size("parts")), lambda n: F.array_join(F.slice("parts", 1, n), "/"))
    met = objects.select("path", "size", parts.alias("parts")).withColumn("rule", F.explode(above)).join(rules, "rule")
    found = met.groupBy("path", "size", "parts").agg(F.max_by(
        F.struct("layer", "dataset", "component", "format", "depth"), F.col("depth")).alias("to"))
    name = F.element_at("parts", -1)
    extension = F.when(F.instr(name, ".") > 0, F.element_at(F.split(name, r"\."), -1)).otherwise(F.lit("none"))
    below = F.try_element_at("parts", F.col("to.depth") + 1)
    return found.select("path", "size", "to.layer", F.coalesce("to.dataset", below, name).alias("dataset"), "to.component",
                        F.coalesce("to.format", extension).alias("format"))

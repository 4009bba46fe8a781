"""File sources: delimited text with explicit schemas, preamble rows, binary files."""

from __future__ import annotations

import csv

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


# one dialect for both directions: doubled quotes inside quoted fields, white space kept, lines end at \n
_DIALECT = {"quote": '"', "escape": '"', "encoding": "UTF-8", "ignoreLeadingWhiteSpace": "false",
            "ignoreTrailingWhiteSpace": "false"}


def read_csv(spark: SparkSession, path: str, schema: T.StructType | str,
             header: bool = True, multi_line: bool = False) -> DataFrame:
    """Delimited text with quoted fields and an optional UTF-8 BOM.

    Columns are bound by header name: the file's header is read (the first
    line only), its columns are parsed as text under their own names, and the columns of ``schema``
    are picked and cast.  A column that the header lacks is an error.
    Without a header, columns bind by position.  ``multi_line`` lets quoted
    fields hold newlines; a file is then one task.  Without it files are split
    at line ends.
    """
    want = T.StructType.fromDDL(schema) if isinstance(schema, str) else schema
    reader = spark.read.options(**_DIALECT).option("multiLine", multi_line)
    if not header:
        return reader.schema(want).csv(path)
    top = spark.read.options(**_DIALECT).option("multiLine", multi_line).option("header", True).csv(path)
    names = [c.lstrip("\ufeff") for c in top.columns]
    missing = [f.name for f in want.fields if f.name not in names]
    if missing:
        raise ValueError(f"columns {missing} are not in the header {names}")
    text = T.StructType([T.StructField(n, T.StringType()) for n in names])
    rows = reader.option("header", True).option("enforceSchema", True).schema(text).csv(path)
    return rows.select(*[F.col(f"`{f.name}`").cast(f.dataType).alias(f.name) for f in want.fields])


def write_csv(df: DataFrame, path: str) -> None:
    """Delimited text that ``read_csv`` gives back, but for empty strings, which come back as null."""
    df.write.mode("overwrite").options(**_DIALECT).option("header", True).csv(path)


def _records(spark: SparkSession, path: str, header_row: int) -> tuple[list[str], DataFrame]:
    """The header's names, and (file, value) of every line after line ``header_row`` (0-based) of every file; blank lines are no records.

    The first lines go to the driver.  Executors drop a file's first lines by their position, one row a file.
    """
    head = [r[0] for r in spark.read.text(path).limit(header_row + 1).collect()]
    names = next(csv.reader([head[header_row].lstrip("\ufeff")]))
    names = [n.strip() or f"_c{i}" for i, n in enumerate(names)]
    lines = spark.read.text(path).select(
        "value", F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("at"))
    # a file's lines stand in order, and its first block starts with its first line: one row per file
    first = lines.where("block = 0").groupBy("file").agg(F.min("at").alias("first"))
    body = lines.join(first.withColumnRenamed("file", "of"), F.col("file") == F.col("of"), "left").where(
        (F.col("block") > 0) | (F.col("at") - F.col("first") > header_row)).where(F.trim("value") != "")
    return names, body.select("file", "value")


def read_with_preamble(spark: SparkSession, path: str, header_row: int = 2,
                       types: dict | None = None) -> DataFrame:
    """Delimited text whose header is on line ``header_row`` (0-based) of every file.

    The first ``header_row + 1`` lines are read on the driver to learn the
    column names.  Executors drop a file's first lines by their position, so
    a body line that looks like the preamble, or holds only empty fields, is
    kept; blank lines are not rows.  Fields follow the dialect of
    ``write_csv``, one line per record.  ``types`` casts columns.
    """
    names, body = _records(spark, path, header_row)
    options = {k: v for k, v in _DIALECT.items() if k != "encoding"}
    out = body.select(F.from_csv("value", _ddl(names), options).alias("row")).select("row.*")
    for name, typ in (types or {}).items():
        out = out.withColumn(name, F.col(name).cast(typ))
    return out


def read_csv_checked(spark: SparkSession, path: str, schema: T.StructType | str, header_row: int = 0) -> DataFrame:
    """Every record of delimited text: the columns of ``schema``, then ``_file``, ``_record`` and ``_problem``.

    ``_problem`` is null for a good record.  A record with too few or too many fields, or a quote that is not closed, is
    ``malformed`` and its columns are null; a field that does not fit its type is null and named: ``bad value in <column>`` (the first one).
    No record is dropped and none ends the job.  One line is one record, so files are split over many tasks; columns bind by
    header name, and a column that the header lacks is an error.
    """
    want = T.StructType.fromDDL(schema) if isinstance(schema, str) else schema
    names, body = _records(spark, path, header_row)
    if missing := [f.name for f in want.fields if f.name not in names]:
        raise ValueError(f"columns {missing} are not in the header {names}")
    broken = "_malformed"
    options = {k: v for k, v in _DIALECT.items() if k != "encoding"} | {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": broken}
    row = F.from_csv("value", f"{_ddl(names)}, {broken} string", options)
    parsed = body.select("file", "value", row.alias("row"))
    bad = F.col(f"row.{broken}").isNotNull()
    cast = {f.name: F.col(f"row.`{f.name}`").try_cast(f.dataType) for f in want.fields}
    unfit = [F.when(F.col(f"row.`{n}`").isNotNull() & c.isNull(), F.lit(f"bad value in {n}")) for n, c in cast.items()]
    return parsed.select(*[F.when(~bad, c).alias(n) for n, c in cast.items()], F.col("file").alias("_file"),
                         F.col("value").alias("_record"), F.when(bad, F.lit("malformed")).otherwise(F.coalesce(*unfit)).alias("_problem"))


def quarantine(checked: DataFrame, path: str, run: str) -> tuple[DataFrame, DataFrame]:
    """Write the bad records of ``read_csv_checked`` below ``path`` and return the good rows and the counts.

    The sink has file, record and problem of each bad record in a partition ``run=<run>`` that a repeated run replaces.  The
    counts are one row a problem, with null for good records; they and the good rows are lazy.
    """
    good = checked.where(F.col("_problem").isNull()).drop("_file", "_record", "_problem")
    bad = checked.where(F.col("_problem").isNotNull()).select(
        F.col("_file").alias("file"), F.col("_record").alias("record"), F.col("_problem").alias("problem"))
    bad.withColumn("run", F.lit(run)).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("run").parquet(path)
    return good, checked.groupBy(F.col("_problem").alias("problem")).agg(F.count(F.lit(1)).alias("records"))


def _ddl(names: list[str]) -> str:
    return ", ".join("`" + n.replace("`", "``") + "` string" for n in names)


def read_binary(spark: SparkSession, path: str, glob: str | None = None) -> DataFrame:
    reader = spark.read.format("binaryFile")
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    return reader.load(path)

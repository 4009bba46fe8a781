"""File landing as a Structured Streaming job.

The drop zone is read as a ``binaryFile`` stream; every micro-batch is
classified against the manifest with the same plan as the batch job
(``plans.bronze.plan_ingest``) and new or changed files are written, file
contents before manifest rows, into a partition named after the batch: a
micro-batch that is re-executed after a failure replaces its own output.  The stream's own checkpoint (in the shared
folder) records which files were seen, so a restart resumes without
re-landing; ``trigger(availableNow=True)`` processes what is there and stops.
"""

from __future__ import annotations

import hashlib

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.text import base_name
from ..plans.bronze import SOURCE_LOCAL, extension_filter, manifest_rows, plan_ingest, read_manifest, write_run
from ..session import scratch_path

BINARY_SCHEMA = "path STRING, modificationTime TIMESTAMP, length BIGINT, content BINARY"


def start_landing(spark: SparkSession, drop_zone: str, bronze_path: str, manifest_path: str,
                  checkpoint: str | None = None, operator_id: str = "data_engineer",
                  available_now: bool = True):
    stream = (spark.readStream.format("binaryFile").schema(BINARY_SCHEMA).load(drop_zone)
              .where(extension_filter("path")))

    checkpoint = checkpoint or scratch_path(spark, "landing-stream")
    # stable per checkpoint, so a restarted stream re-writes its own batches
    stream_tag = hashlib.sha1(checkpoint.encode()).hexdigest()[:12]

    def land_batch(batch: DataFrame, batch_id: int) -> None:
        s = batch.sparkSession
        manifest = read_manifest(s, manifest_path)
        listing = batch.select(
            "path", base_name("path").alias("object_name"), "content",
            F.md5("content").alias("content_md5"), F.col("length").alias("size"),
            F.col("modificationTime").alias("modification_time"), F.lit(SOURCE_LOCAL).alias("source_system"))
        todo = plan_ingest(listing, manifest).where(F.col("action") != "unchanged")
        run = f"stream-{stream_tag}-{batch_id}"
        # a re-executed micro-batch overwrites its own run partition
        write_run(todo.select("object_name", F.lit(0).cast("long").alias("part"), "content", "content_md5", "source_system", "size", "modification_time"),
                  bronze_path, run)
        # the manifest's rows come from what this batch has landed, so files are read and hashed once
        landed = s.read.parquet(bronze_path).where(F.col("run") == run)
        write_run(manifest_rows(landed.withColumn("action", F.lit("landed")), operator_id), manifest_path, run)

    writer = (stream.writeStream.foreachBatch(land_batch)
              .option("checkpointLocation", checkpoint))
    writer = writer.trigger(availableNow=True) if available_now else writer
    return writer.start()

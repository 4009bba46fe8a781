"""SparkSession construction and the shared checkpoint folder.

The library never assumes it owns the session: every operator takes the
DataFrames it is given and reads settings from ``df.sparkSession``.  The
builder here is for tests, the bench and command-line use.
"""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

# Settings the library is designed around.  AQE re-plans joins from runtime
# sizes (broadcast only when the materialised side is small), coalesces
# small shuffle partitions and splits skewed join partitions.
DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def build_session(master: str | None = None, app: str = "stratum",
                  shuffle_partitions: int | None = None,
                  extra: dict | None = None) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    conf = dict(DEFAULT_CONF)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def _is_local(spark: SparkSession) -> bool:
    return spark.sparkContext.master.startswith("local")


def shared_dir(spark: SparkSession) -> str:
    """The cluster-shared folder used for checkpoints and scratch tables.

    Taken from ``spark.checkpoint.dir`` (or a checkpoint folder already set
    on the context).  Only a local-mode session without that setting (tests,
    the bench) gets a private temporary folder; on a cluster an unset value
    is an error, never a machine-local fallback.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None) or \
        sc.getConf().get("spark.checkpoint.dir", None)
    if not configured:
        if not _is_local(spark):
            raise RuntimeError(
                "spark.checkpoint.dir must name a shared folder on a cluster")
        configured = tempfile.mkdtemp(prefix="stratum-ckpt-")
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir() or configured


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh sub-folder of the shared folder for written intermediate tables."""
    base = shared_dir(spark)
    return os.path.join(base, f"scratch-{name}-{uuid.uuid4().hex}")


def stored(df: DataFrame, name: str = "mat") -> tuple[DataFrame, str]:
    """Write ``df`` once as a parquet table in the shared folder; the table read back, and its path.

    Cuts the lineage like a reliable ``checkpoint()``, but computes the plan
    once (an eager RDD checkpoint runs it twice unless cached) and stores it
    columnar.  Values derived from the physical layout (partition ids) must
    be columns of ``df``: they are then fixed for every later use.  Reading
    the schema back costs no job.
    """
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.mode("overwrite").parquet(path)
    return spark.read.schema(df.schema).parquet(path), path


def discard(spark: SparkSession, path: str) -> None:
    """Delete a table that ``stored`` wrote and that no open DataFrame reads any more."""
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(target, True)


def materialize(df: DataFrame, name: str = "mat") -> DataFrame:
    """``stored`` for a table that the caller's result goes on reading."""
    return stored(df, name)[0]

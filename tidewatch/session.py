"""Session helpers: one place for the settings every job in the library assumes."""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

# Settings the library's semantics depend on (UTC day arithmetic, ANSI errors
# surfaced, AQE for runtime re-planning and skew splitting).
REQUIRED_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
}


def build_session(master: str = "local[8]", app: str = "tidewatch",
                  shuffle_partitions: int = 8, extra: dict | None = None) -> SparkSession:
    """Session for tests and the bench. On a cluster, use the cluster's session
    and call :func:`configure` on it instead."""
    builder = (
        SparkSession.builder.master(master).appName(app)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "16g")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
    )
    # The shared folder is chosen by checkpoint_dir, which takes a temporary one in local mode only.
    for k, v in {**REQUIRED_CONF, **(extra or {})}.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    configure(spark)
    return spark


def configure(spark: SparkSession) -> SparkSession:
    for k, v in REQUIRED_CONF.items():
        spark.conf.set(k, v)
    checkpoint_dir(spark)
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """Shared folder for checkpoints and intermediate tables.

    Read from ``spark.checkpoint.dir`` as the cluster names it. Only in local mode,
    where driver and tasks are one process, is a fresh folder chosen when it is
    unset; on a cluster that is an error, as executors would not see the folder.
    """
    sc = spark.sparkContext
    d = sc.getCheckpointDir() or sc.getConf().get("spark.checkpoint.dir", None)
    if not d:
        if not re.fullmatch(r"local(\[[^\]]*\])?", sc.master):
            raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
        d = tempfile.mkdtemp(prefix="tidewatch-ckpt-")
    if sc.getCheckpointDir() is None:
        sc.setCheckpointDir(d)
    return sc.getCheckpointDir() or d


def scratch_path(spark: SparkSession, name: str) -> str:
    """A unique path under the shared checkpoint folder for a written table."""
    base = checkpoint_dir(spark).rstrip("/")
    return f"{base}/{name}-{uuid.uuid4().hex[:12]}"


def saved(df: DataFrame, name: str) -> DataFrame:
    """``df`` written to the shared folder and read back: short lineage, and none of
    the plan's constraints, which grow from round to round of an iteration."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def exists(spark: SparkSession, path: str) -> bool:
    jvm = spark.sparkContext._jvm
    jpath = jvm.org.apache.hadoop.fs.Path(path)
    fs = jpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return bool(fs.exists(jpath))


def remove(spark: SparkSession, path: str) -> None:
    jvm = spark.sparkContext._jvm
    jpath = jvm.org.apache.hadoop.fs.Path(path)
    jpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(jpath, True)

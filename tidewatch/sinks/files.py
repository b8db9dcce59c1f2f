"""Sinks: parquet snapshots, report CSV, manifest, drift baselines."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def write_snapshot(df: DataFrame, path: str, partition_by: Sequence[str] = ()) -> str:
    """K1: overwrite a parquet snapshot (optionally partitioned, e.g. by
    snapshot_date so readers prune to the dates they need)."""
    w = df.write.mode("overwrite")
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(path)
    return path


def report_text(df: DataFrame, digits: int = 4) -> DataFrame:
    """K2 formatting: doubles as '%.{digits}f', NULL stays NULL (written empty)."""
    cols = []
    for f in df.schema.fields:
        if isinstance(f.dataType, (T.DoubleType, T.FloatType)):
            c = F.col(f.name)
            cols.append(F.when(c.isNotNull(), F.format_string(f"%.{digits}f", c)).alias(f.name))
        else:
            cols.append(F.col(f.name).cast("string").alias(f.name))
    return df.select(*cols)


def write_report_csv(df: DataFrame, path: str, digits: int = 4, single_file: bool = False) -> str:
    """K2: CSV with header, floats as %.4f, NULL as empty. ``single_file`` is for
    small, already-aggregated reports only."""
    out = report_text(df, digits)
    if single_file:
        out = out.coalesce(1)
    out.write.mode("overwrite").option("header", True).option("nullValue", "").option("emptyValue", "") \
        .csv(path)
    return path


def write_manifest(df: DataFrame, path: str) -> str:
    """K4: manifest rewritten sorted by (channel_id, stage), header first."""
    df.select("channel_id", "stage", "status", "fetched_at").orderBy("channel_id", "stage") \
        .write.mode("overwrite").option("header", True).csv(path)
    return path


def save_baseline(df: DataFrame, path: str) -> str:
    """Small baseline table (feature means or label counts), overwritten."""
    df.coalesce(1).write.mode("overwrite").parquet(path)
    return path

"""Monitoring: feature drift, cluster drift, new at-risk creators, freshness."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .eda import feature_means


def feature_drift(current: DataFrame, baseline: DataFrame | None, cols: Sequence[str] | None = None,
                  threshold: float = 2.0):
    """Relative change of each feature mean against the baseline
    (``|cur - prev| / max(|prev|, 0.001) > threshold`` with ``|prev| > 0``).
    Returns (report, new_baseline). No baseline: no alarms."""
    cur = feature_means(current, cols).withColumnRenamed("mean", "current_mean")
    if baseline is None:
        rep = cur.select("feature", F.lit(None).cast("double").alias("previous_mean"), "current_mean",
                         F.lit(None).cast("double").alias("change"), F.lit(False).alias("alarm"))
        return rep, cur.withColumnRenamed("current_mean", "mean")
    b = baseline.select("feature", F.col("mean").alias("previous_mean"))
    j = cur.join(F.broadcast(b), "feature", "left")   # one row per column: bounded
    prev = F.col("previous_mean")
    change = F.when(prev.isNotNull() & (F.abs(prev) > 0),
                    F.abs(F.col("current_mean") - prev) / F.greatest(F.abs(prev), F.lit(0.001)))
    rep = j.select("feature", "previous_mean", "current_mean", change.alias("change"),
                   F.coalesce(change > threshold, F.lit(False)).alias("alarm"))
    return rep, cur.withColumnRenamed("current_mean", "mean")


def cluster_drift(current: DataFrame, baseline: DataFrame | None, label_col: str = "cluster_label",
                  pct: float = 30.0):
    """For labels of the current run, ``|c - p| / (c + p) * 100 > pct`` with
    p = 0 when the label is new. A vanished label raises nothing.
    Returns (report, new_baseline of (label, n))."""
    cur = current.where(F.col(label_col).isNotNull()).groupBy(F.col(label_col).alias("label")) \
        .agg(F.count(F.lit(1)).alias("current_count"))
    if baseline is None:
        rep = cur.select("label", F.lit(None).cast("bigint").alias("previous_count"), "current_count",
                         F.lit(None).cast("double").alias("change_pct"), F.lit(False).alias("alarm"))
        return rep, cur.withColumnRenamed("current_count", "n")
    b = baseline.select("label", F.col("n").alias("previous_count"))
    j = cur.join(b, "label", "left")
    p = F.coalesce(F.col("previous_count"), F.lit(0))
    tot = F.col("current_count") + p
    change = F.when(tot > 0, F.abs(F.col("current_count") - p).cast("double") / tot.cast("double") * 100.0)
    rep = j.select("label", p.alias("previous_count"), "current_count", change.alias("change_pct"),
                   F.coalesce(change > pct, F.lit(False)).alias("alarm"))
    return rep, cur.withColumnRenamed("current_count", "n")


def new_at_risk(report: DataFrame, previous: DataFrame | None, key: str = "channel_id") -> DataFrame:
    """D3: creators At-Risk now and not At-Risk in the previous report
    (left anti join); alert rows with title, idle days and score."""
    cur = report.where(F.col("risk_flag") == "At-Risk")
    if previous is not None:
        prev = previous.where(F.col("risk_flag") == "At-Risk").select(key).distinct()
        cur = cur.join(prev, key, "left_anti")
    cols = [c for c in ["title", "days_since_last_upload", "risk_score"] if c in report.columns]
    return cur.select(key, *cols)


def freshness(a: DataFrame, b: DataFrame, key: str = "channel_id") -> DataFrame:
    """Distinct ids of both tables, their overlap, stale (overlap smaller
    than either side) and ok (some overlap; empty input -> not ok)."""
    ia = a.select(key).where(F.col(key).isNotNull()).distinct().withColumn("_a", F.lit(True))
    ib = b.select(key).where(F.col(key).isNotNull()).distinct().withColumn("_b", F.lit(True))
    j = ia.join(ib, key, "full_outer").agg(
        F.count("_a").alias("n_a"), F.count("_b").alias("n_b"),
        F.count_if(F.col("_a").isNotNull() & F.col("_b").isNotNull()).alias("n_overlap"))
    return j.select("n_a", "n_b", "n_overlap",
                    (F.col("n_overlap") < F.greatest("n_a", "n_b")).alias("stale"),
                    (F.col("n_overlap") > 0).alias("ok"))

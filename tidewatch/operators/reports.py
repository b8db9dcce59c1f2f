"""Reports and exports."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import rules as R
from .ordering import dedup_first

# ---- fixed values that must equal the reference's for the same results ----
REPORT_FLOATS = ["upload_freq_30d", "upload_freq_90d", "momentum_ratio", "avg_engagement_rate",
                 "upload_regularity", "duration_trend", "risk_score"]
REPORT_COLUMNS = ["channel_id", "title", "risk_flag", "risk_score", "cluster_label", "upload_freq_30d",
                  "upload_freq_90d", "momentum_ratio", "avg_engagement_rate", "days_since_last_upload",
                  "upload_regularity", "duration_trend", "distance_to_centroid", "recommended_action"]
STAR_FACT_METRICS = ["upload_freq_30d", "upload_freq_90d", "freq_trend_ratio", "momentum_ratio",
                     "avg_engagement_rate", "days_since_last_upload"]


def attach_features(clusters: DataFrame, features: DataFrame, key: str = "channel_id") -> DataFrame:
    """Drop the clusters' copies of feature columns, then left join the features."""
    overlap = [c for c in features.columns if c in clusters.columns and c != key]
    return clusters.drop(*overlap).join(features, key, "left")


def attach_title(df: DataFrame, channels: DataFrame | None, key: str = "channel_id") -> DataFrame:
    """Left join (id, title); a NULL title when no channels table is given."""
    if channels is None:
        return df.withColumn("title", F.lit(None).cast("string"))
    titles = dedup_first(channels.select(key, "title"), [key], ["title"])
    return df.drop("title").join(titles, key, "left")


def round_cols(df: DataFrame, cols: Sequence[str], digits: int = 4) -> DataFrame:
    """Round the given columns (half up)."""
    return df.select(*[F.round(F.col(c), digits).alias(c) if c in cols else F.col(c) for c in df.columns])


def report_order() -> list[Column]:
    """O1: tier text ascending, score and idle days descending, NULLs last;
    channel_id breaks remaining ties."""
    return [F.col("risk_flag").asc_nulls_last(), F.col("risk_score").desc_nulls_last(),
            F.col("days_since_last_upload").desc_nulls_last(), F.col("channel_id").asc_nulls_last()]


def at_risk_report(clusters: DataFrame, features: DataFrame, channels: DataFrame | None = None,
                   ordered: bool = True) -> DataFrame:
    """14-column at-risk report with recommended actions (P15), rounded."""
    m = attach_title(attach_features(clusters, features), channels)
    m = m.withColumn("recommended_action", R.recommended_action())
    m = round_cols(m, REPORT_FLOATS, 4).select(*REPORT_COLUMNS)
    return m.orderBy(*report_order()) if ordered else m


def top_at_risk(report: DataFrame, k: int = 10) -> DataFrame:
    """O3: first k rows of the report (TakeOrderedAndProject)."""
    return report.orderBy(*report_order()).limit(k)


def directory(channels: DataFrame, clusters: DataFrame, key: str = "channel_id") -> DataFrame:
    """Every channel with its scoring columns (NULL when not scored)."""
    overlap = [c for c in clusters.columns if c in channels.columns and c != key]
    return channels.join(clusters.drop(*overlap), key, "left")


def directory_report(directory_df: DataFrame) -> DataFrame:
    """R2: directory rows with the dashboard action (P16) and display text."""
    d = directory_df
    return d.select(
        "channel_id",
        R.short_title("title").alias("title"),
        R.thousands("subscriber_count").alias("subscribers"),
        R.fixed("upload_freq_30d", 2).alias("frequency"),
        R.fixed("momentum_ratio", 2).alias("momentum"),
        R.fixed("avg_engagement_rate", 2, 100.0, "%").alias("engagement"),
        R.int_text("days_since_last_upload").alias("days_idle"),
        R.fixed("risk_score", 3).alias("risk"),
        R.fixed("confidence", 0, 100.0, "%").alias("confidence"),
        F.coalesce(F.col("cluster_label"), F.lit("Unknown")).alias("cluster"),
        F.coalesce(F.col("risk_flag"), F.lit("Unknown")).alias("tier"),
        R.directory_action().alias("action"),
        F.coalesce(F.col("risk_score").cast("double"), F.lit(0.5)).alias("risk_value"),
    )


def directory_display(directory_df: DataFrame) -> DataFrame:
    """P18 columns whose text has no decimal ties (ids, counts, labels, actions)."""
    return directory_report(directory_df).select("channel_id", "title", "subscribers", "days_idle", "cluster",
                                                 "tier", "action", "risk_value")


def sort_directory(df: DataFrame, column: str = "risk_score", descending: bool = True) -> DataFrame:
    """O2: sort by any column, either way, NULLs last."""
    c = F.col(column)
    return df.orderBy(c.desc_nulls_last() if descending else c.asc_nulls_last(), F.col("channel_id"))


def search_title(df: DataFrame, text: str) -> DataFrame:
    """Case-insensitive literal substring match on the title."""
    if not text:
        return df
    return df.where(F.instr(F.lower(F.col("title")), text.lower()) > 0)


def filter_tier(df: DataFrame, tier: str = "All") -> DataFrame:
    """Tier equality, or everything for 'All'."""
    return df if tier in (None, "All") else df.where(F.col("risk_flag") == tier)


def scatter_points(directory_df: DataFrame) -> DataFrame:
    """Scored rows, frequency x momentum with hover columns."""
    scored = directory_df.where(~F.coalesce(F.col("insufficient_history"), F.lit(True)))
    return scored.select("channel_id", "title", "upload_freq_30d", "momentum_ratio", "risk_flag",
                         "avg_engagement_rate", "days_since_last_upload", "risk_score")


def export_star(clusters: DataFrame, features: DataFrame, scored_at: Column):
    """(dim, fact). dim: one row per channel; fact: six metrics and
    the export time, from the clusters joined to the features."""
    dim = dedup_first(clusters.select("channel_id", "risk_flag", "cluster_label", "model_version"),
                      ["channel_id"], ["risk_flag", "cluster_label", "model_version"])
    fact = clusters.select("channel_id").join(features.select("channel_id", *STAR_FACT_METRICS), "channel_id", "left")
    fact = fact.select("channel_id", *STAR_FACT_METRICS, scored_at.alias("scored_at"))
    return dim, fact


def extraction_budget(channels: DataFrame, per_call: int = 50, daily_quota: int = 10000,
                      count_col: str = "video_count") -> DataFrame:
    """API calls and units to list every channel (ids per call) and to page
    through every channel's uploads and video details; days at the daily quota."""
    pages = F.ceil(F.coalesce(F.col(count_col), F.lit(0)) / F.lit(float(per_call)))
    a = channels.agg(F.count(F.lit(1)).alias("n_channels"), F.sum(pages).alias("_pages"))
    channel_calls = F.ceil(F.col("n_channels") / F.lit(float(per_call))).cast("bigint")
    pl = F.coalesce(F.col("_pages"), F.lit(0)).cast("bigint")
    total = channel_calls + 2 * pl
    return a.select("n_channels", channel_calls.alias("channel_calls"), pl.alias("playlist_calls"),
                    pl.alias("video_calls"), total.alias("total_units"),
                    F.ceil(total / F.lit(float(daily_quota))).cast("bigint").alias("days_needed"))


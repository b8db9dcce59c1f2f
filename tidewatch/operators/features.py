"""Per-channel features over trailing windows.

Plan shape (see ``compute_features``):

1. per-video columns (window flags, whole days, views/day, engagement) —
   narrow projections, pushed into the scan;
2. ``rank_in_groups`` on (channel, published_at, video_id): one exchange by
   channel (a hot one is cut into blocks of that order), then one window pass
   per block gives rank, channel size and the previous upload time;
3. one ``groupBy(channel)`` with partial aggregation computes every metric;
4. a left join from the distinct channel ids attaches channels without videos.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import scalar as S
from .ordering import rank_in_groups

FEATURE_OUTPUT = [
    "channel_id", "computed_at", "upload_freq_30d", "upload_freq_90d", "freq_trend_ratio",
    "momentum_ratio", "avg_engagement_rate", "days_since_last_upload", "upload_regularity",
    "duration_trend", "insufficient_history",
]


@dataclass(frozen=True)
class VideoCols:
    """Column names of the videos frame (the library is generic over them)."""
    channel_id: str = "channel_id"
    video_id: str = "video_id"
    published_at: str = "published_at"
    view_count: str = "view_count"
    like_count: str = "like_count"
    comment_count: str = "comment_count"
    duration_seconds: str = "duration_seconds"


def video_metrics(videos: DataFrame, ref, short: int = 30, long: int = 90,
                  cols: VideoCols = VideoCols()) -> DataFrame:
    """Per-video columns used by every feature: flags (P8), days, views/day (P10),
    engagement (P11), minutes."""
    c = cols
    flags = S.window_flags(c.published_at, ref, short, long)
    return videos.select(
        F.col(c.channel_id).alias("channel_id"),
        F.col(c.video_id).alias("video_id"),
        F.col(c.published_at).alias("published_at"),
        flags["in_short"].alias("in_short"),
        flags["in_long"].alias("in_long"),
        flags["in_between"].alias("in_between"),
        S.whole_days_between(ref, c.published_at).alias("days_old"),
        S.views_per_day(c.view_count, c.published_at, ref).alias("vpd"),
        S.engagement_rate(c.like_count, c.comment_count, c.view_count).alias("eng"),
        (F.col(c.duration_seconds).cast("double") / 60.0).alias("dur_min"),
    )


def ordered_videos(metrics: DataFrame, blocks: int | None = None) -> DataFrame:
    """W1 + W2 input: rank inside the channel (time ascending, NULL times last,
    video_id as tie-break), channel size, previous upload time."""
    return rank_in_groups(metrics.where(F.col("channel_id").isNotNull()), ["channel_id"],
                          ["published_at", "video_id"], nulls_last=True, carry=["published_at"], blocks=blocks, rank_col="rank", size_col="n_videos",
                          prev_prefix="prev_")


def upload_gaps(ordered: DataFrame) -> DataFrame:
    """Whole-day gap to the previous upload of the same channel."""
    return ordered.withColumn(
        "gap_days",
        F.floor((F.unix_micros("published_at") - F.unix_micros("prev_published_at")) / F.lit(S.MICROS_PER_DAY))
        .cast("bigint"))


def half_split_flag(ordered: DataFrame) -> DataFrame:
    """Older half = first floor(n/2) videos in time order."""
    return ordered.withColumn("older_half", F.col("rank") <= F.floor(F.col("n_videos") / 2))


def channel_aggregates(ordered: DataFrame) -> DataFrame:
    """A1-A7 inputs in one ``groupBy`` (partial aggregation before the shuffle)."""
    g = half_split_flag(upload_gaps(ordered))
    return g.groupBy("channel_id").agg(
        F.count(F.lit(1)).alias("n_all"),
        F.sum(F.col("in_short").cast("int")).alias("n_short"),
        F.sum(F.col("in_long").cast("int")).alias("n_long"),
        F.max("published_at").alias("last_upload"),
        F.avg(F.when(F.col("in_short"), F.col("vpd"))).alias("vpd_recent"),
        F.avg(F.when(F.col("in_between"), F.col("vpd"))).alias("vpd_older"),
        F.avg(F.when(F.col("older_half"), F.col("vpd"))).alias("vpd_half_older"),
        F.avg(F.when(~F.col("older_half"), F.col("vpd"))).alias("vpd_half_recent"),
        F.avg("eng").alias("eng"),
        F.stddev_samp("gap_days").alias("gap_std"),
        F.avg(F.when(F.col("in_short"), F.col("dur_min"))).alias("dur_recent"),
        F.avg("dur_min").alias("dur_all"),
    )


def features_from_aggregates(agg: DataFrame, ref, short: int, long: int, min_videos: int) -> DataFrame:
    """A1-A8 final expressions over per-channel aggregates."""
    has = F.col("n_long") > 0
    f_s = F.col("n_short") / F.lit(float(short))
    f_l = F.col("n_long") / F.lit(float(long))
    momentum = (
        F.when(F.col("vpd_recent").isNotNull() & F.col("vpd_older").isNotNull() & (F.col("vpd_older") > 0),
               S.safe_ratio("vpd_recent", "vpd_older"))
        .when(F.col("n_all") >= 4, S.safe_ratio("vpd_half_recent", "vpd_half_older"))
    )
    days_since = F.greatest(S.whole_days_between(ref, "last_upload"), F.lit(0))
    return agg.select(
        "channel_id",
        S.ts_lit(ref).alias("computed_at"),
        F.when(has, f_s).alias("upload_freq_30d"),
        F.when(has, f_l).alias("upload_freq_90d"),
        F.when(has, S.safe_ratio(f_s, f_l)).alias("freq_trend_ratio"),
        F.when(has, momentum).alias("momentum_ratio"),
        F.when(has, F.col("eng")).alias("avg_engagement_rate"),
        F.when(has & F.col("last_upload").isNotNull(), days_since).cast("bigint").alias("days_since_last_upload"),
        F.when(has & (F.col("n_all") >= 3), F.col("gap_std")).alias("upload_regularity"),
        F.when(has, F.when(F.col("n_short") > 0, F.col("dur_recent")).otherwise(F.col("dur_all")))
        .alias("duration_trend"),
        (~has | ((F.col("n_short") < min_videos) & (F.col("n_long") < min_videos))).alias("insufficient_history"),
    )


def compute_features(channels: DataFrame, videos: DataFrame, ref, short: int = 30, long: int = 90,
                     min_videos: int = 2, channel_col: str = "channel_id",
                     cols: VideoCols = VideoCols(), blocks: int | None = None) -> DataFrame:
    """One feature row per distinct channel id of ``channels``.

    Channels without a video in the long window get NULL metrics and
    ``insufficient_history`` true. Empty ``channels`` or ``videos`` give an
    empty frame (N5b).
    """
    metrics = video_metrics(videos, ref, short, long, cols)
    agg = channel_aggregates(ordered_videos(metrics, blocks))
    ids = channels.select(F.col(channel_col).alias("channel_id")).where(F.col("channel_id").isNotNull()).distinct()
    # No videos at all -> no rows (an EXISTS subquery reading one row).
    ids = ids.where(videos.exists())
    joined = ids.join(agg, "channel_id", "left").fillna(0, ["n_all", "n_short", "n_long"])
    return features_from_aggregates(joined, ref, short, long, min_videos).select(*FEATURE_OUTPUT)

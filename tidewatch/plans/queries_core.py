"""Feature-stage queries: bindings, per-video metrics, windows, features."""

from __future__ import annotations

from functools import lru_cache

from pyspark.sql import functions as F

from ..operators import features as FE
from ..session import scratch_path
from ..sinks import files as SK
from ..sources import bindings as BD
from . import oracle as O
from .catalog import register


def features_for(spark, sf_dir, name="b1"):
    """Features of a binding, computed for this query and written once (K1), as a
    real run reuses its features table. No query reads another one's."""
    b, ch, vi = BD.channels_videos(spark, sf_dir, name)
    feats = FE.compute_features(ch, vi, b.ref, b.short, b.long)
    return spark.read.parquet(SK.write_snapshot(feats, scratch_path(spark, f"features-{name}")))


@lru_cache(maxsize=None)
def feat_sql(name="b1") -> str:
    return O.binding_features_sql(name)


@register("creator_features", O.binding_features_sql("b1"))
def q_creator_features(spark, sf_dir):
    """A9 flagship: features of B1 (suppliers as channels, line items as videos)."""
    return features_for(spark, sf_dir, "b1")


@register("creator_features_b2", O.binding_features_sql("b2"))
def q_creator_features_b2(spark, sf_dir):
    """A9 on sparse B2: zero-video, insufficient and fallback channels."""
    return features_for(spark, sf_dir, "b2")


@register("creator_features_b3", O.binding_features_sql("b3"))
def q_creator_features_b3(spark, sf_dir):
    """A9 on B3 with sub-day times and 7/21-day windows."""
    return features_for(spark, sf_dir, "b3")


_B3_30_90 = O.features_sql(O.B3_CHANNELS, O.B3_VIDEOS, BD.B3.ref, 30, 90)


@register("momentum_ratio", _B3_30_90)
def q_momentum_b3_30_90(spark, sf_dir):
    """A7 with every event in the recent window: forces the half-split fallback (B3, 30/90)."""
    b, ch, vi = BD.channels_videos(spark, sf_dir, "b3")
    return FE.compute_features(ch, vi, b.ref, 30, 90)


# ---- per-video and per-channel pieces of the feature job ---------------------

def _b1_metrics(spark, sf_dir):
    b, _, vi = BD.channels_videos(spark, sf_dir, "b1")
    return FE.video_metrics(vi, b.ref, b.short, b.long)


_B1M = O.video_metrics_sql(O.B1_VIDEOS, BD.B1.ref, 30, 90)
_B1A = O.channel_aggregates_sql(_B1M)


@register("window_flags", f"SELECT video_id, channel_id, in_short, in_long, in_between FROM ({_B1M}) m")
def q_window_flags(spark, sf_dir):
    """Short / long / between window flags per video (B1)."""
    return _b1_metrics(spark, sf_dir).select("video_id", "channel_id", "in_short", "in_long", "in_between")


@register("views_per_day", f"SELECT video_id, days_old, vpd FROM ({_B1M}) m")
def q_views_per_day(spark, sf_dir):
    """P10: views / max(whole days, 1) per video (B1)."""
    return _b1_metrics(spark, sf_dir).select("video_id", "days_old", "vpd")


@register("engagement_rate_row", f"SELECT video_id, eng FROM ({_B1M}) m")
def q_engagement_rate_row(spark, sf_dir):
    """Clipped (likes + comments) / views per video (B1)."""
    return _b1_metrics(spark, sf_dir).select("video_id", "eng")


@register("safe_ratio", f"""
SELECT video_id, CASE WHEN like_count IS NOT NULL AND view_count IS NOT NULL AND view_count > 0
                      THEN like_count / view_count END AS like_ratio FROM ({O.B1_VIDEOS}) v""")
def q_safe_ratio(spark, sf_dir):
    """NULL-safe ratio (likes per view) per video (B1)."""
    from ..functions import scalar as S
    return BD.b1_videos(spark, sf_dir).select("video_id", S.safe_ratio(F.col("like_count").cast("double"),
                                                                       F.col("view_count").cast("double")).alias("like_ratio"))


def _feat_cols(name, cols, sql_name=None):
    f = O.binding_features_sql(sql_name or name)
    return f"SELECT channel_id, {', '.join(cols)} FROM ({f}) f"


@register("upload_frequency", _feat_cols("b1", ["upload_freq_30d", "upload_freq_90d", "freq_trend_ratio"]))
def q_upload_frequency(spark, sf_dir):
    """A1: uploads per day in the short and long windows (B1)."""
    return features_for(spark, sf_dir, "b1").select("channel_id", "upload_freq_30d", "upload_freq_90d", "freq_trend_ratio")


@register("days_since_last", _feat_cols("b2", ["days_since_last_upload"]))
def q_days_since_last(spark, sf_dir):
    """A2: whole days since the last upload, floored at 0 (B2)."""
    return features_for(spark, sf_dir, "b2").select("channel_id", "days_since_last_upload")


@register("avg_vpd_windows", f"SELECT channel_id, vpd_recent, vpd_older FROM ({_B1A}) a")
def q_avg_vpd_windows(spark, sf_dir):
    """A3: mean views/day in the recent and the older window (B1)."""
    return FE.channel_aggregates(FE.ordered_videos(_b1_metrics(spark, sf_dir))).select("channel_id", "vpd_recent", "vpd_older")


@register("avg_engagement", _feat_cols("b1", ["avg_engagement_rate"]))
def q_avg_engagement(spark, sf_dir):
    """A4: mean engagement over all the channel's videos (B1)."""
    return features_for(spark, sf_dir, "b1").select("channel_id", "avg_engagement_rate")


@register("upload_regularity", _feat_cols("b1", ["upload_regularity"]))
def q_upload_regularity(spark, sf_dir):
    """A5: sample stddev of whole-day gaps, >= 3 videos (B1)."""
    return features_for(spark, sf_dir, "b1").select("channel_id", "upload_regularity")


@register("duration_trend", _feat_cols("b1", ["duration_trend"]))
def q_duration_trend(spark, sf_dir):
    """Mean minutes of recent videos, else of all (B1)."""
    return features_for(spark, sf_dir, "b1").select("channel_id", "duration_trend")


@register("insufficient_history", _feat_cols("b2", ["insufficient_history"]))
def q_insufficient_history(spark, sf_dir):
    """Both window counts below the minimum (B2)."""
    return features_for(spark, sf_dir, "b2").select("channel_id", "insufficient_history")


@register("features_left", _feat_cols("b2", ["upload_freq_90d", "momentum_ratio", "insufficient_history"]))
def q_features_left(spark, sf_dir):
    """Every channel gets a row, with NULL metrics when it has no recent video (B2)."""
    return features_for(spark, sf_dir, "b2").select("channel_id", "upload_freq_90d", "momentum_ratio", "insufficient_history")


_B3M = O.video_metrics_sql(O.B3_VIDEOS, BD.B3.ref, 7, 21)


@register("half_split_momentum", f"""
SELECT channel_id, max(n_videos) AS n_videos,
       avg(CASE WHEN rank <= floor(n_videos / 2) THEN vpd END) AS vpd_half_older,
       avg(CASE WHEN rank > floor(n_videos / 2) THEN vpd END) AS vpd_half_recent
FROM ({_B3M}) m GROUP BY channel_id""")
def q_half_split_momentum(spark, sf_dir):
    """views/day of the older and recent halves of each channel's uploads."""
    b, _, vi = BD.channels_videos(spark, sf_dir, "b3")
    o = FE.half_split_flag(FE.ordered_videos(FE.video_metrics(vi, b.ref, b.short, b.long)))
    return o.groupBy("channel_id").agg(
        F.max("n_videos").alias("n_videos"),
        F.avg(F.when(F.col("older_half"), F.col("vpd"))).alias("vpd_half_older"),
        F.avg(F.when(~F.col("older_half"), F.col("vpd"))).alias("vpd_half_recent"))


@register("upload_gaps", f"""
SELECT channel_id, video_id, rank,
       CAST(floor((epoch_us(published_at) - epoch_us(prev_published_at)) / {O.MICROS_PER_DAY}) AS BIGINT) AS gap_days
FROM ({_B1M}) m""")
def q_upload_gaps(spark, sf_dir):
    """Rank and whole-day gap to the previous upload of the channel (B1)."""
    g = FE.upload_gaps(FE.ordered_videos(_b1_metrics(spark, sf_dir)))
    return g.select("channel_id", "video_id", "rank", "gap_days")

"""Explicit schemas: raw landing JSON and the keyed tables. No inference anywhere."""

from __future__ import annotations

from pyspark.sql import types as T

S, L, D, B, TS, I = T.StringType(), T.LongType(), T.DoubleType(), T.BooleanType(), T.TimestampType(), T.IntegerType()


def _f(name, t, nullable=True):
    return T.StructField(name, t, nullable)


# Raw channel item: counters arrive as strings, hidden flag as a JSON boolean.
CHANNEL_ITEM = T.StructType([
    _f("id", S),
    _f("snippet", T.StructType([_f("title", S), _f("description", S), _f("publishedAt", S), _f("country", S)])),
    _f("statistics", T.StructType([_f("viewCount", S), _f("subscriberCount", S),
                                   _f("hiddenSubscriberCount", B), _f("videoCount", S)])),
    _f("contentDetails", T.StructType([_f("relatedPlaylists", T.StructType([_f("uploads", S), _f("likes", S)]))])),
])

# Raw video item: statistics as a map so that a *missing* key can be told apart
# from a null value (comments disabled, P6).
VIDEO_ITEM = T.StructType([
    _f("id", S),
    _f("snippet", T.StructType([_f("channelId", S), _f("publishedAt", S)])),
    _f("statistics", T.MapType(S, S)),
    _f("contentDetails", T.StructType([_f("duration", S)])),
])

CORRUPT_COL = "_corrupt_record"

CHANNELS = T.StructType([_f("channel_id", S, False), _f("title", S), _f("description", S), _f("country", S),
                         _f("published_at", TS), _f("uploads_playlist_id", S), _f("fetched_at", TS)])
CHANNEL_SNAPSHOTS = T.StructType([_f("channel_id", S, False), _f("snapshot_date", T.DateType(), False),
                                  _f("subscriber_count", L), _f("subscriber_hidden", B),
                                  _f("view_count_total", L), _f("video_count", L)])
VIDEOS = T.StructType([_f("video_id", S, False), _f("channel_id", S), _f("published_at", TS),
                       _f("duration_seconds", L), _f("view_count", L), _f("like_count", L), _f("comment_count", L),
                       _f("comments_disabled", B), _f("fetched_at", TS)])
SEED = T.StructType([_f("channel_id", S), _f("name", S), _f("niche", S)])
MANIFEST = T.StructType([_f("channel_id", S), _f("stage", S), _f("status", S), _f("fetched_at", S)])
MANIFEST_HEADER = ["channel_id", "stage", "status", "fetched_at"]
REPORT_CSV = T.StructType([_f("channel_id", S), _f("title", S), _f("risk_flag", S), _f("risk_score", S),
                           _f("cluster_label", S), _f("upload_freq_30d", S), _f("upload_freq_90d", S),
                           _f("momentum_ratio", S), _f("avg_engagement_rate", S), _f("days_since_last_upload", S),
                           _f("upload_regularity", S), _f("duration_trend", S), _f("distance_to_centroid", S),
                           _f("recommended_action", S)])

"""Source / sink queries over the B4 landing zone and written files
(S1-S7, P3-P6, P19, P20, P22, J5, W7, K1, K2, K4, K11)."""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import functions as F

from .. import schemas as SCH
from ..functions import scalar as S
from ..operators import clean as CL
from ..operators import ordering as OR
from ..operators import scoring as SC
from ..session import scratch_path
from ..sinks import files as SK
from ..sources import bindings as BD
from ..sources import landing as LD
from ..sources import landing_fixture as LF
from . import oracle as O
from . import raw_run as RR
from .catalog import register
from .queries_core import features_for
from .queries_ops import report_for, report_sql

AS_OF = _dt.datetime(2000, 1, 1)

# ---- SQL twins of the landing fixture ----------------------------------------

UC_SQL = ("CASE WHEN c_mktsegment = 'HOUSEHOLD' THEN 'UC' || lpad(CAST(c_custkey AS VARCHAR), 20, 'A') || '!' "
          "ELSE 'UC' || lpad(CAST(c_custkey AS VARCHAR), 22, 'A') END")

CH_ITEMS_SQL = f"""
WITH c AS (SELECT cu.*, n.n_name, coalesce(o.n_orders, 0) AS n_orders
           FROM customer cu LEFT JOIN nation n ON n.n_nationkey = cu.c_nationkey
           LEFT JOIN (SELECT o_custkey, count(*) AS n_orders FROM orders GROUP BY o_custkey) o ON o.o_custkey = cu.c_custkey)
SELECT *, {UC_SQL} AS id, 0 AS bump, 0 AS grp FROM c
UNION ALL
SELECT *, {UC_SQL} AS id, 1 AS bump, 1 AS grp FROM c WHERE c_mktsegment = 'MACHINERY'"""


_ITEM_ORDER_SQL = ", ".join(BD.B1_DEDUP_ORDER)


def _vid_items_sql():
    return f"""
SELECT CAST(l_orderkey AS VARCHAR) || '-' || CAST(l_linenumber AS VARCHAR) AS video_id,
       'UC' || lpad(CAST(l_suppkey AS VARCHAR), 22, 'A') AS channel_id, l_shipdate AS published_at,
       strftime(l_shipdate, '%Y-%m-%dT%H:%M:%SZ') AS published_text,
       CAST(floor(l_extendedprice) AS BIGINT) AS view_count, CAST(floor(l_quantity) AS BIGINT) AS like_count,
       CASE WHEN l_returnflag <> 'N' THEN CAST(round(l_tax * 100) AS BIGINT) END AS comment_count,
       coalesce(l_returnflag = 'N', true) AS comments_disabled,
       CAST(floor(l_quantity * 37) AS BIGINT) AS duration_seconds,
       'PT' || CAST(CAST(floor(l_quantity * 37) AS BIGINT) // 60 AS VARCHAR) || 'M'
            || CAST(CAST(floor(l_quantity * 37) AS BIGINT) % 60 AS VARCHAR) || 'S' AS duration_text,
       l_shipdate >= {O.ts(LF.VIDEO_SPLIT)} AS in_batch_2, {_ITEM_ORDER_SQL}
FROM lineitem"""


VID_ITEMS_SQL = _vid_items_sql()


def landing(spark, sf_dir, *kinds):
    return LF.build_landing(spark, sf_dir, kinds or LF.KINDS)


def _raw_channels(spark, sf_dir):
    return LD.read_landing(spark, f"{landing(spark, sf_dir, 'channels')}/channels", SCH.CHANNEL_ITEM)


def _raw_videos(spark, sf_dir):
    return LD.read_landing(spark, f"{landing(spark, sf_dir, 'videos')}/videos", SCH.VIDEO_ITEM)


@register("src_channels_json", f"""
SELECT id AS channel_id, CASE WHEN c_nationkey = 0 THEN NULL ELSE c_name END AS title,
       CAST(CASE WHEN c_nationkey <> 0 AND c_acctbal >= 0 THEN CAST(floor(c_acctbal * 100) AS BIGINT) + bump END AS DOUBLE) AS subscriber_count,
       CAST(CASE WHEN c_nationkey <> 0 AND c_mktsegment <> 'FURNITURE' THEN CAST(floor(c_acctbal * 1000) AS BIGINT) END AS DOUBLE) AS view_count_total,
       CAST(CASE WHEN c_nationkey <> 0 THEN n_orders END AS DOUBLE) AS video_count,
       CASE WHEN c_nationkey <> 0 THEN c_acctbal < 0 END AS hidden_subscriber
FROM ({CH_ITEMS_SQL}) i""")
def q_src_channels_json(spark, sf_dir):
    """Nested channel JSON pages -> flat cleaning rows (broken file skipped)."""
    return LD.read_channels_json(spark, f"{landing(spark, sf_dir, 'channels')}/channels")


@register("src_videos_json", f"""
SELECT video_id, channel_id, published_at, view_count, like_count, comment_count, comments_disabled, duration_seconds
FROM ({VID_ITEMS_SQL}) v""")
def q_src_videos_json(spark, sf_dir):
    """Nested video JSON -> flat rows (P4 durations, P5 times, P6 disabled comments)."""
    return LD.read_videos_json(spark, f"{landing(spark, sf_dir, 'videos')}/videos")


@register("src_corrupt_files", f"""
SELECT 'channels' AS kind, 1 AS n_corrupt_files, 1 AS n_corrupt_records, (SELECT count(*) FROM ({CH_ITEMS_SQL}) a) AS n_good_items
UNION ALL
SELECT 'videos', 1, 1, (SELECT count(*) FROM ({VID_ITEMS_SQL}) b)""")
def q_src_corrupt_files(spark, sf_dir):
    """S3: unreadable landing files are split off whole; good items continue."""
    out = None
    for kind, raw in (("channels", _raw_channels(spark, sf_dir)), ("videos", _raw_videos(spark, sf_dir))):
        good, bad = LD.split_corrupt(raw)
        tagged = bad.select("_source_file", F.lit(1).alias("_bad")).unionByName(
            good.select(F.lit(None).cast("string").alias("_source_file"), F.lit(0).alias("_bad")))
        part = tagged.agg(F.countDistinct("_source_file").cast("int").alias("n_corrupt_files"),
                          F.sum("_bad").cast("int").alias("n_corrupt_records"),
                          F.count_if(F.col("_bad") == 0).alias("n_good_items")) \
            .select(F.lit(kind).alias("kind"), "n_corrupt_files", "n_corrupt_records", "n_good_items")
        out = part if out is None else out.unionByName(part)
    return out


def _dim_snap(spark, sf_dir):
    good, _ = LD.split_corrupt(_raw_channels(spark, sf_dir))
    return LD.channel_dim_and_snapshots(good, AS_OF)


@register("src_snapshot_rows", f"""
SELECT id AS channel_id, DATE '{AS_OF.date().isoformat()}'::TIMESTAMP AS snapshot_date,
       CASE WHEN c_nationkey <> 0 AND c_acctbal >= 0 THEN CAST(floor(c_acctbal * 100) AS BIGINT) + bump END AS subscriber_count,
       CASE WHEN c_nationkey <> 0 THEN c_acctbal < 0 END AS subscriber_hidden,
       CASE WHEN c_nationkey <> 0 AND c_mktsegment <> 'FURNITURE' THEN CAST(floor(c_acctbal * 1000) AS BIGINT) END AS view_count_total,
       CASE WHEN c_nationkey <> 0 THEN CAST(n_orders AS BIGINT) END AS video_count
FROM ({CH_ITEMS_SQL}) i""")
def q_src_snapshot_rows(spark, sf_dir):
    """Dated snapshot row per channel item (safe ints and booleans)."""
    return _dim_snap(spark, sf_dir)[1]


@register("src_channel_dim", f"""
SELECT id AS channel_id, CASE WHEN c_nationkey = 0 THEN '' ELSE c_name END AS title,
       CASE WHEN c_nationkey <> 0 AND c_mktsegment <> 'AUTOMOBILE' THEN 'Segment ' || c_mktsegment END AS description,
       CASE WHEN c_nationkey <> 0 THEN n_name END AS country,
       CASE WHEN c_nationkey <> 0 THEN TIMESTAMP '2015-01-01' + INTERVAL (c_custkey % 365) DAY END AS published_at,
       CASE WHEN c_nationkey NOT IN (0, 2) THEN 'UU' || substr(id, 3, 100) END AS uploads_playlist_id,
       {O.ts(AS_OF)} AS fetched_at
FROM ({CH_ITEMS_SQL}) i""")
def q_src_channel_dim(spark, sf_dir):
    """Dimension row per channel item (defaults for missing structs)."""
    return _dim_snap(spark, sf_dir)[0]


_RAW_CHANNELS_SQL = f"SELECT DISTINCT id AS channel_id FROM ({CH_ITEMS_SQL}) i"
_RAW_VIDEOS_SQL = f"""
SELECT * EXCLUDE (rn) FROM (
  SELECT video_id, channel_id, published_at, view_count, like_count, comment_count, comments_disabled, duration_seconds,
         row_number() OVER (PARTITION BY video_id ORDER BY in_batch_2, {_ITEM_ORDER_SQL}) AS rn FROM ({VID_ITEMS_SQL}) v) d
WHERE rn = 1"""
_RAW_FEATURES_SQL = O.features_sql(_RAW_CHANNELS_SQL, _RAW_VIDEOS_SQL, BD.B1.ref, 30, 90)


@register("raw_to_features", _RAW_FEATURES_SQL)
def q_raw_to_features(spark, sf_dir):
    """Landing pages (B4) -> cast, cap, first of repeated videos -> features, as one call."""
    return RR.raw_to_features(spark, landing(spark, sf_dir), BD.B1.ref)


@register("load_all", f"""
SELECT table_name, actual, expected, actual - expected AS delta, actual = expected AS match FROM (
  SELECT 'channels' AS table_name, count(DISTINCT id) AS actual, count(*) AS expected FROM ({CH_ITEMS_SQL}) a
  UNION ALL SELECT 'channel_snapshots', count(DISTINCT id), count(*) FROM ({CH_ITEMS_SQL}) b
  UNION ALL SELECT 'videos', count(DISTINCT video_id), count(*) FROM ({VID_ITEMS_SQL}) c
  UNION ALL SELECT 'creator_features', count(DISTINCT id), count(DISTINCT id) FROM ({CH_ITEMS_SQL}) d
  UNION ALL SELECT 'creator_clusters', count(DISTINCT id), count(DISTINCT id) FROM ({CH_ITEMS_SQL}) e) r""")
def q_load_all(spark, sf_dir):
    """Landing rows, features and clusters merged into the five keyed
    tables; rows of each table against the rows that came in."""
    root = landing(spark, sf_dir)
    items = RR.landed(spark, root)
    feats = spark.read.parquet(SK.write_snapshot(RR.raw_to_features(spark, root, BD.B1.ref, items=items), scratch_path(spark, "load-features")))
    clusters = SC.score_with_fixed_clusters(feats, F.length("channel_id") % 3, S.ts_lit(BD.B1.ref))
    return RR.load_all(spark, root, feats, clusters, scratch_path(spark, "tables"), AS_OF, items=items)


@register("src_parquet", """
SELECT 'supplier' AS table_name, count(*) AS n_rows FROM supplier
UNION ALL SELECT 'missing', 0""")
def q_src_parquet(spark, sf_dir):
    """Parquet source; a missing path reads as an empty table."""
    sup = LD.read_table(spark, f"{sf_dir}/supplier.parquet")
    miss = LD.read_table(spark, f"{sf_dir}/no_such_table.parquet", schema=sup.schema, missing="empty")
    return sup.agg(F.count(F.lit(1)).alias("n_rows")).select(F.lit("supplier").alias("table_name"), "n_rows") \
        .unionByName(miss.agg(F.count(F.lit(1)).alias("n_rows")).select(F.lit("missing").alias("table_name"), "n_rows"))


@register("src_sql_view", """
SELECT s_nationkey, count(*) AS n_suppliers, avg(s_acctbal) AS avg_acctbal FROM supplier GROUP BY s_nationkey""")
def q_src_sql_view(spark, sf_dir):
    """SQL over a named view of a parquet table."""
    LD.register_views(spark, {"tw_supplier": BD.table(spark, sf_dir, "supplier")})
    return spark.sql("SELECT s_nationkey, count(*) AS n_suppliers, avg(s_acctbal) AS avg_acctbal "
                     "FROM tw_supplier GROUP BY s_nationkey")


# ---- seeds, manifest, resume ----------------------------------------------------

def seed_path(spark, sf_dir):
    cus = BD.table(spark, sf_dir, "customer")
    base = cus.select(LF.uc_id(F.col("c_custkey"), F.col("c_mktsegment") == "HOUSEHOLD").alias("channel_id"),
                      F.col("c_name").alias("name"), F.col("c_mktsegment").alias("niche"),
                      F.lit(0).alias("_g"), F.col("c_custkey").alias("_k"))
    rep = base.where(F.col("niche") == "MACHINERY").withColumn("_g", F.lit(1))
    path = scratch_path(spark, "seed")
    base.unionByName(rep).orderBy("_g", "_k").drop("_g", "_k").write.option("header", True).csv(path)
    return path


SEED_SQL = f"""
SELECT {UC_SQL} AS channel_id, c_name AS name, c_mktsegment AS niche, 0 AS grp, c_custkey FROM customer
UNION ALL
SELECT {UC_SQL}, c_name, c_mktsegment, 1, c_custkey FROM customer WHERE c_mktsegment = 'MACHINERY'"""


@register("src_seed_csv", f"SELECT channel_id, name, niche FROM ({SEED_SQL}) s")
def q_src_seed_csv(spark, sf_dir):
    """Seed CSV with header (ids, names, niches), in file order."""
    return LD.read_seed_csv(spark, seed_path(spark, sf_dir)).drop("_ordinal")


@register("src_seed_first_n", f"SELECT channel_id, name, niche FROM ({SEED_SQL}) s ORDER BY grp, c_custkey LIMIT 25")
def q_src_seed_first_n(spark, sf_dir):
    """The first 25 seeds in file order (a limit is the feature)."""
    return LD.read_seed_csv(spark, seed_path(spark, sf_dir), n=25).drop("_ordinal")


@register("seed_list", f"""
SELECT channel_id, name, niche FROM (
  SELECT *, row_number() OVER (PARTITION BY channel_id ORDER BY grp, c_custkey) AS rn FROM ({SEED_SQL}) s) d
WHERE rn = 1 AND regexp_full_match(channel_id, 'UC[A-Za-z0-9_-]{{22}}')""")
def q_seed_list(spark, sf_dir):
    """P20: first occurrence per id in file order, invalid ids dropped."""
    return CL.build_seed(LD.read_seed_csv(spark, seed_path(spark, sf_dir)), ordinal="_ordinal").drop("_ordinal")


@register("valid_id", f"SELECT id AS channel_id, regexp_full_match(id, 'UC[A-Za-z0-9_-]{{22}}') AS is_valid FROM ({CH_ITEMS_SQL}) i")
def q_valid_id(spark, sf_dir):
    """Channel id format check over the landed channel items."""
    good, _ = LD.split_corrupt(_raw_channels(spark, sf_dir))
    return good.select(S.text_or_empty("id").alias("channel_id"), S.valid_channel_id("id").alias("is_valid"))


@register("uploads_pairs", f"""
SELECT id AS channel_id, CASE WHEN c_nationkey NOT IN (0, 2) THEN 'UU' || substr(id, 3, 100) END AS uploads_playlist_id,
       c_nationkey NOT IN (0, 2) AS has_uploads FROM ({CH_ITEMS_SQL}) i""")
def q_uploads_pairs(spark, sf_dir):
    """Channels with an id and an uploads playlist vs the rest."""
    dim, _ = _dim_snap(spark, sf_dir)
    ok, rest = CL.channels_with_uploads(dim)
    return ok.select("channel_id", "uploads_playlist_id", F.lit(True).alias("has_uploads")).unionByName(
        rest.select("channel_id", "uploads_playlist_id", F.lit(False).alias("has_uploads")))


MANIFEST_ROWS_SQL = """
SELECT 'UC' || lpad(CAST(user_id AS VARCHAR), 22, 'A') AS channel_id, event_type AS stage,
       CASE event_id % 3 WHEN 0 THEN 'done' WHEN 1 THEN 'empty' ELSE 'failed' END AS status,
       strftime(ts, '%Y-%m-%d %H:%M:%S') AS fetched_at, event_id FROM events"""

LATEST_SQL = f"""
SELECT channel_id, stage, status, fetched_at FROM (
  SELECT *, row_number() OVER (PARTITION BY channel_id, stage ORDER BY event_id DESC) AS rn FROM ({MANIFEST_ROWS_SQL}) m) d
WHERE rn = 1"""


def manifest_path(spark, sf_dir):
    ev = BD.table(spark, sf_dir, "events")
    rows = ev.select(LF.uc_id(F.col("user_id")).alias("channel_id"), F.col("event_type").alias("stage"),
                     F.when(F.col("event_id") % 3 == 0, "done").when(F.col("event_id") % 3 == 1, "empty")
                     .otherwise("failed").alias("status"),
                     F.date_format(S.ts_utc("ts"), "yyyy-MM-dd HH:mm:ss").alias("fetched_at"), "event_id")
    path = scratch_path(spark, "manifest")
    rows.orderBy("event_id").drop("event_id").write.option("header", True).csv(path)
    return path


@register("src_manifest_latest", LATEST_SQL)
def q_src_manifest_latest(spark, sf_dir):
    """Checkpoint manifest, last row per (channel, stage) in file order."""
    return LD.read_manifest(spark, manifest_path(spark, sf_dir))


@register("sink_manifest", LATEST_SQL)
def q_sink_manifest(spark, sf_dir):
    """K4: manifest rewritten sorted by (channel_id, stage) and read back."""
    latest = LD.read_manifest(spark, manifest_path(spark, sf_dir))
    out = scratch_path(spark, "manifest-out")
    SK.write_manifest(latest, out)
    return spark.read.option("header", True).schema(SCH.MANIFEST).csv(out)


@register("resume_remaining", f"""
SELECT DISTINCT 'UC' || lpad(CAST(user_id AS VARCHAR), 22, 'A') AS channel_id FROM events
EXCEPT
SELECT channel_id FROM ({LATEST_SQL}) l WHERE stage = 'view' AND status = 'done'""")
def q_resume_remaining(spark, sf_dir):
    """Ids whose 'view' stage is not done yet (empty / failed are retried)."""
    ids = BD.table(spark, sf_dir, "events").select(LF.uc_id(F.col("user_id")).alias("channel_id")).distinct()
    done = LD.read_manifest(spark, manifest_path(spark, sf_dir)) \
        .where((F.col("stage") == "view") & (F.col("status") == "done")).select("channel_id")
    return ids.join(done, "channel_id", "left_anti")


@register("id_batches", f"""
SELECT CAST((rn - 1) // 50 AS BIGINT) AS batch, list(channel_id ORDER BY rn) AS ids, CAST(count(*) AS INTEGER) AS n FROM (
  SELECT channel_id, row_number() OVER (ORDER BY channel_id) AS rn FROM ({O.B2_CHANNELS}) c) r GROUP BY 1""")
def q_id_batches(spark, sf_dir):
    """Ordered ids cut into numbered batches of 50 (B2)."""
    ch = BD.b2_channels(spark, sf_dir).select("channel_id")
    return OR.batch_ids(ch, "channel_id", ["channel_id"], 50)


# ---- per-field parsing over the landing ----------------------------------------

@register("iso_duration", f"SELECT video_id, duration_text, duration_seconds FROM ({VID_ITEMS_SQL}) v")
def q_iso_duration(spark, sf_dir):
    """ISO-8601 duration text -> seconds."""
    good, _ = LD.split_corrupt(_raw_videos(spark, sf_dir))
    return good.select(S.text_or_empty("id").alias("video_id"), F.col("contentDetails.duration").alias("duration_text"),
                       S.iso8601_duration_seconds("contentDetails.duration").alias("duration_seconds"))


@register("parse_ts", f"SELECT video_id, published_text, published_at FROM ({VID_ITEMS_SQL}) v")
def q_parse_ts(spark, sf_dir):
    """P5: ISO timestamp text with 'Z' -> UTC timestamp."""
    good, _ = LD.split_corrupt(_raw_videos(spark, sf_dir))
    return good.select(S.text_or_empty("id").alias("video_id"), F.col("snippet.publishedAt").alias("published_text"),
                       S.parse_ts("snippet.publishedAt").alias("published_at"))


@register("comments_disabled", f"SELECT video_id, comment_count, comments_disabled FROM ({VID_ITEMS_SQL}) v")
def q_comments_disabled(spark, sf_dir):
    """Comments disabled = commentCount key absent from the statistics map."""
    good, _ = LD.split_corrupt(_raw_videos(spark, sf_dir))
    return LD.flatten_videos(good).select("video_id", "comment_count", "comments_disabled")


@register("safe_bool", f"SELECT id AS channel_id, CASE WHEN c_nationkey <> 0 THEN c_acctbal < 0 END AS hidden FROM ({CH_ITEMS_SQL}) i")
def q_safe_bool(spark, sf_dir):
    """JSON booleans kept, anything else NULL."""
    good, _ = LD.split_corrupt(_raw_channels(spark, sf_dir))
    return good.select(S.text_or_empty("id").alias("channel_id"), S.safe_bool("statistics.hiddenSubscriberCount").alias("hidden"))


# ---- sinks ------------------------------------------------------------------------

@register("sink_parquet_roundtrip", O.binding_features_sql("b1"))
def q_sink_parquet_roundtrip(spark, sf_dir):
    """K1: features written as a parquet snapshot and read back."""
    path = scratch_path(spark, "features")
    SK.write_snapshot(features_for(spark, sf_dir, "b1"), path)
    return spark.read.parquet(path)


def _fmt4(c):
    return f"CASE WHEN {c} IS NOT NULL THEN printf('%.4f', {c}) END AS {c}"


@register("sink_report_csv", f"""
SELECT CAST(channel_id AS VARCHAR) AS channel_id, title, risk_flag, {_fmt4('risk_score')}, cluster_label,
       {_fmt4('upload_freq_30d')}, {_fmt4('upload_freq_90d')}, {_fmt4('momentum_ratio')}, {_fmt4('avg_engagement_rate')},
       CAST(days_since_last_upload AS VARCHAR) AS days_since_last_upload, {_fmt4('upload_regularity')},
       {_fmt4('duration_trend')}, {_fmt4('distance_to_centroid')}, recommended_action
FROM ({report_sql('b2')}) r""")
def q_sink_report_csv(spark, sf_dir):
    """K2: report as CSV (floats %.4f after rounding, NULL empty), read back as text."""
    path = scratch_path(spark, "report")
    SK.write_report_csv(report_for(spark, sf_dir, "b2"), path)
    return spark.read.option("header", True).schema(SCH.REPORT_CSV).csv(path)


@register("sink_landing_json", f"""
SELECT 'channels' AS kind, CASE WHEN grp = 0 THEN 'batch=1' ELSE 'batch=2' END AS batch, count(*) AS n_items
FROM ({CH_ITEMS_SQL}) c GROUP BY 2
UNION ALL
SELECT 'videos', CASE WHEN in_batch_2 THEN 'batch=2' ELSE 'batch=1' END, count(*) FROM ({VID_ITEMS_SQL}) v GROUP BY 2""")
def q_sink_landing_json(spark, sf_dir):
    """Items landed per batch directory (one page array per line)."""
    out = None
    for kind, raw in (("channels", _raw_channels(spark, sf_dir)), ("videos", _raw_videos(spark, sf_dir))):
        good, _ = LD.split_corrupt(raw)
        b = good.withColumn("batch", F.regexp_extract("_source_file", r"/(batch=\d+)/", 1)) \
            .where(F.col("batch") != "").groupBy("batch").agg(F.count(F.lit(1)).alias("n_items")) \
            .select(F.lit(kind).alias("kind"), "batch", "n_items")
        out = b if out is None else out.unionByName(b)
    return out


# ---- key checks and the previous report ----------------------------------------

@register("key_violations", f"""
SELECT 'videos' AS table_name, 'primary_key' AS check_name, 'video_id' AS columns,
       CAST(coalesce(sum(c - 1), 0) AS BIGINT) AS n
FROM (SELECT video_id, count(*) AS c FROM ({O.B1_VIDEOS_RAW}) r GROUP BY video_id HAVING count(*) > 1) d
UNION ALL SELECT 'videos', 'not_null', 'video_id', count_if(video_id IS NULL) FROM ({O.B1_VIDEOS_RAW}) r
UNION ALL SELECT 'videos', 'not_null', 'published_at', count_if(published_at IS NULL) FROM ({O.B1_VIDEOS_RAW}) r
UNION ALL SELECT 'videos', 'foreign_key', 'channel_id', count(*) FROM ({O.B1_VIDEOS_RAW}) r
          WHERE channel_id IS NOT NULL AND channel_id NOT IN (SELECT channel_id FROM ({O.B1_CHANNELS}) c)""")
def q_key_violations(spark, sf_dir):
    """Primary-key duplicates, NULLs in required columns, orphan foreign keys (raw B1 videos)."""
    raw = BD.b1_videos_raw(spark, sf_dir)
    return CL.key_violations(raw, "videos", ["video_id"], ["published_at"],
                             fk=("channel_id", BD.b1_channels(spark, sf_dir), "channel_id"))


@register("previous_report_ids", f"""
SELECT CAST(channel_id AS VARCHAR) AS channel_id, risk_flag FROM ({report_sql('b2')}) r WHERE risk_flag = 'At-Risk'""")
def q_previous_report_ids(spark, sf_dir):
    """At-Risk ids of a previously written report CSV (missing file -> empty)."""
    path = scratch_path(spark, "previous-report")
    SK.write_report_csv(report_for(spark, sf_dir, "b2"), path)
    missing = LD.read_previous_report(spark, f"{path}-missing")
    return LD.read_previous_report(spark, path).unionByName(missing)

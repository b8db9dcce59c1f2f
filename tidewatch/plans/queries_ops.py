"""Report, directory, monitoring and merge queries (R1-R3, O2, O3, P15-P18, P21,
J3, A23, D1-D5, K5-K9)."""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import functions as F

from ..functions import rules as R
from ..functions import scalar as S
from ..operators import features as FE
from ..operators import merge as MG
from ..operators import monitor as MO
from ..operators import reports as RP
from ..operators import scoring as SC
from ..session import scratch_path
from ..sinks import files as SK
from ..sources import bindings as BD
from . import oracle as O
from .catalog import register
from .queries_core import features_for
from .queries_scoring import DIR_CLUSTER_COLS, clusters_for, clusters_sql, directory_for, directory_sql

EARLIER = _dt.datetime(1999, 10, 1)


# ---- SQL fragments -------------------------------------------------------------

def action_sql() -> str:
    d = "coalesce(CAST(days_since_last_upload AS DOUBLE), 0.0)"
    m = "coalesce(CAST(momentum_ratio AS DOUBLE), 1.0)"
    return ("CASE WHEN coalesce(risk_flag, '') = 'Unscored' THEN 'Insufficient data — collect more upload history' "
            f"WHEN risk_flag = 'At-Risk' THEN CASE WHEN {d} > 21 THEN 'Reach out — momentum declining, no upload in 21+ days' "
            f"WHEN {m} < 0.5 THEN 'Reach out — momentum sharply declining' ELSE 'Monitor — declining engagement trend' END "
            f"WHEN risk_flag = 'Watch' THEN CASE WHEN {d} > 14 THEN 'Check in — upload gap widening' "
            "ELSE 'Monitor — mid-range metrics' END ELSE 'No action needed' END")


def dir_action_sql() -> str:
    d = "CAST(days_since_last_upload AS DOUBLE)"
    m = "CASE WHEN CAST(momentum_ratio AS DOUBLE) = 0 THEN 1.0 ELSE CAST(momentum_ratio AS DOUBLE) END"
    r = "CASE WHEN CAST(risk_score AS DOUBLE) = 0 THEN 0.5 ELSE CAST(risk_score AS DOUBLE) END"
    return (f"CASE WHEN {d} >= 30 THEN 'Urgent outreach' WHEN {d} >= 14 THEN 'Check in with creator' "
            f"WHEN ({m}) < 0.5 AND ({r}) > 0.5 THEN 'Priority review' WHEN {d} >= 7 THEN 'Monitor closely' "
            "ELSE 'Auto-email check-in' END")


def report_sql(name="b2") -> str:
    c, f, ch = clusters_sql(name), O.binding_features_sql(name), O.BINDING_SQL[name][1]
    r4 = lambda x: f"round(m.{x}, 4) AS {x}"
    return f"""
SELECT m.channel_id, m.title, m.risk_flag, {r4('risk_score')}, m.cluster_label, {r4('upload_freq_30d')},
       {r4('upload_freq_90d')}, {r4('momentum_ratio')}, {r4('avg_engagement_rate')}, m.days_since_last_upload,
       {r4('upload_regularity')}, {r4('duration_trend')}, m.distance_to_centroid, m.recommended_action
FROM (SELECT j.*, {action_sql()} AS recommended_action FROM (
        SELECT c.channel_id, c.risk_flag, c.risk_score, c.cluster_label, c.distance_to_centroid,
               f.upload_freq_30d, f.upload_freq_90d, f.momentum_ratio, f.avg_engagement_rate, f.days_since_last_upload,
               f.upload_regularity, f.duration_trend, t.title
        FROM ({c}) c LEFT JOIN ({f}) f ON f.channel_id = c.channel_id
        LEFT JOIN (SELECT channel_id, title FROM ({ch}) x) t ON t.channel_id = c.channel_id) j) m"""


def report_for(spark, sf_dir, name="b2", ordered=True):
    ch = BD.BINDINGS[name][1](spark, sf_dir)
    return RP.at_risk_report(clusters_for(spark, sf_dir, name), features_for(spark, sf_dir, name), ch, ordered)


@register("at_risk_report", report_sql("b2"))
def q_at_risk_report(spark, sf_dir):
    """14-column report with actions, rounded, ordered (B2)."""
    return report_for(spark, sf_dir, "b2")


@register("recommended_action", f"SELECT channel_id, recommended_action FROM ({report_sql('b2')}) r")
def q_recommended_action(spark, sf_dir):
    """7-way report action rule (B2)."""
    return report_for(spark, sf_dir, "b2", ordered=False).select("channel_id", "recommended_action")


@register("top_at_risk", f"""
SELECT * FROM ({report_sql('b2')}) r
ORDER BY risk_flag ASC NULLS LAST, risk_score DESC NULLS LAST, days_since_last_upload DESC NULLS LAST, channel_id
LIMIT 10""")
def q_top_at_risk(spark, sf_dir):
    """O3: the first 10 report rows (top-k, a report feature)."""
    return RP.top_at_risk(report_for(spark, sf_dir, "b2", ordered=False), 10)


@register("directory", directory_sql("b2"))
def q_directory(spark, sf_dir):
    """Every channel left-joined to its scoring row (B2)."""
    return directory_for(spark, sf_dir, "b2")


def _fixed_sql(c, digits, scale=1.0, suffix=""):
    return (f"coalesce(CAST(round(CAST(CAST({c} AS DOUBLE) * {scale} AS DECIMAL(38,12)), {digits}) AS VARCHAR) || '{suffix}', 'N/A')")


_DECIMAL_TEXT_SQL = f""",
       {_fixed_sql("upload_freq_30d", 2)} AS frequency, {_fixed_sql("momentum_ratio", 2)} AS momentum,
       {_fixed_sql("avg_engagement_rate", 2, 100.0, "%")} AS engagement, {_fixed_sql("risk_score", 3)} AS risk,
       {_fixed_sql("confidence", 0, 100.0, "%")} AS confidence"""


def _display_sql(d, more=""):
    return f"""
SELECT channel_id, substr(coalesce(CAST(title AS VARCHAR), 'Unknown'), 1, 60) AS title,
       coalesce(format('{{:,}}', CAST(subscriber_count AS BIGINT)), 'N/A') AS subscribers,
       coalesce(CAST(CAST(days_since_last_upload AS BIGINT) AS VARCHAR), 'N/A') AS days_idle,
       coalesce(cluster_label, 'Unknown') AS cluster, coalesce(risk_flag, 'Unknown') AS tier,
       {dir_action_sql()} AS action, coalesce(CAST(risk_score AS DOUBLE), 0.5) AS risk_value{more}
FROM ({d}) d"""


@register("directory_display", _display_sql(directory_sql("b2")))
def q_directory_display(spark, sf_dir):
    """P16 + P18: directory action and display text without decimal ties (B2)."""
    return RP.directory_display(directory_for(spark, sf_dir, "b2"))


@register("directory_action", f"SELECT channel_id, {dir_action_sql()} AS action FROM ({directory_sql('b2')}) d")
def q_directory_action(spark, sf_dir):
    """5-way directory action rule (B2)."""
    return directory_for(spark, sf_dir, "b2").select("channel_id", R.directory_action().alias("action"))


@register("directory_report", _display_sql(directory_sql("b2"), _DECIMAL_TEXT_SQL))
def q_directory_report(spark, sf_dir):
    """R2: directory with all display columns."""
    return RP.sort_directory(RP.directory_report(directory_for(spark, sf_dir, "b2")), "risk_value")


@register("directory_sorted", f"SELECT * FROM ({directory_sql('b2')}) d ORDER BY momentum_ratio ASC NULLS LAST, channel_id")
def q_directory_sorted(spark, sf_dir):
    """O2: directory sorted by a chosen column (momentum, ascending)."""
    return RP.sort_directory(directory_for(spark, sf_dir, "b2"), "momentum_ratio", descending=False)


@register("directory_filter", f"""
SELECT * FROM ({directory_sql('b2')}) d WHERE instr(lower(title), 'customer#0000001') > 0 AND risk_flag = 'Watch'""")
def q_directory_filter(spark, sf_dir):
    """Case-insensitive title search plus tier filter."""
    d = directory_for(spark, sf_dir, "b2")
    return RP.filter_tier(RP.search_title(d, "CUSTOMER#0000001"), "Watch")


@register("scatter_points", f"""
SELECT channel_id, title, upload_freq_30d, momentum_ratio, risk_flag, avg_engagement_rate, days_since_last_upload,
       risk_score FROM ({directory_sql('b2')}) d WHERE NOT coalesce(insufficient_history, true)""")
def q_scatter_points(spark, sf_dir):
    """Scored rows for the frequency x momentum chart (B2)."""
    return RP.scatter_points(directory_for(spark, sf_dir, "b2"))


@register("extraction_budget", f"""
SELECT n_channels, channel_calls, pages AS playlist_calls, pages AS video_calls,
       channel_calls + 2 * pages AS total_units, CAST(ceil((channel_calls + 2 * pages) / 10000.0) AS BIGINT) AS days_needed
FROM (SELECT count(*) AS n_channels, CAST(ceil(count(*) / 50.0) AS BIGINT) AS channel_calls,
             CAST(coalesce(sum(ceil(coalesce(video_count, 0) / 50.0)), 0) AS BIGINT) AS pages
      FROM ({O.B2_CHANNELS}) c) a""")
def q_extraction_budget(spark, sf_dir):
    """API calls / units / days to crawl every channel and its uploads (B2)."""
    return RP.extraction_budget(BD.b2_channels(spark, sf_dir))


# ---- monitoring ------------------------------------------------------------------

def _features_at(spark, sf_dir, name, ref):
    b = BD.BINDINGS[name][0]
    ch = BD.BINDINGS[name][1](spark, sf_dir)
    vi = BD.b1_videos(spark, sf_dir, ref) if name == "b1" else BD.b2_videos(spark, sf_dir, ref)
    return FE.compute_features(ch, vi, ref, b.short, b.long)


def _features_at_sql(name, ref):
    ch = O.BINDING_SQL[name][1]
    vi = O.b1_videos_sql(ref) if name == "b1" else O.b2_videos_sql(ref)
    b = BD.BINDINGS[name][0]
    return O.features_sql(ch, vi, ref, b.short, b.long)


MEAN_COLS = ["upload_freq_30d", "upload_freq_90d", "freq_trend_ratio", "momentum_ratio", "avg_engagement_rate",
             "days_since_last_upload", "upload_regularity", "duration_trend"]


def _means_sql(f):
    return " UNION ALL ".join(f"SELECT '{c}' AS feature, avg(CAST({c} AS DOUBLE)) AS mean FROM ({f}) f" for c in MEAN_COLS)


_DRIFT_SQL = f"""
SELECT c.feature, p.mean AS previous_mean, c.mean AS current_mean, ch.change, coalesce(ch.change > 2.0, false) AS alarm
FROM ({_means_sql(O.binding_features_sql('b2'))}) c
LEFT JOIN ({_means_sql(_features_at_sql('b2', EARLIER))}) p ON p.feature = c.feature
CROSS JOIN LATERAL (SELECT CASE WHEN p.mean IS NOT NULL AND abs(p.mean) > 0
                               THEN abs(c.mean - p.mean) / greatest(abs(p.mean), 0.001) END AS change) ch"""


@register("feature_drift", _DRIFT_SQL)
def q_feature_drift(spark, sf_dir):
    """Feature means now vs an earlier run (B2 at 1999-10-01 vs all rows)."""
    prev = _features_at(spark, sf_dir, "b2", EARLIER)
    _, baseline = MO.feature_drift(prev, None, MEAN_COLS)
    path = SK.save_baseline(baseline, scratch_path(spark, "feature-baseline"))   # K12
    rep, _ = MO.feature_drift(features_for(spark, sf_dir, "b2"), spark.read.parquet(path), MEAN_COLS)
    return rep


def _clusters_at_sql(name, ref):
    return O.fixed_clusters_sql(_features_at_sql(name, ref), "channel_id % 3", ref)


def _clusters_at(spark, sf_dir, name, ref):
    return SC.score_with_fixed_clusters(_features_at(spark, sf_dir, name, ref), F.col("channel_id") % 3, S.ts_lit(ref))


_CDRIFT_SQL = f"""
SELECT c.label, coalesce(p.n, 0) AS previous_count, c.n AS current_count,
       CASE WHEN c.n + coalesce(p.n, 0) > 0
            THEN CAST(abs(c.n - coalesce(p.n, 0)) AS DOUBLE) / CAST(c.n + coalesce(p.n, 0) AS DOUBLE) * 100.0 END AS change_pct,
       coalesce(CAST(abs(c.n - coalesce(p.n, 0)) AS DOUBLE) / CAST(c.n + coalesce(p.n, 0) AS DOUBLE) * 100.0 > 30.0, false) AS alarm
FROM (SELECT cluster_label AS label, count(*) AS n FROM ({clusters_sql('b2')}) x WHERE cluster_label IS NOT NULL GROUP BY 1) c
LEFT JOIN (SELECT cluster_label AS label, count(*) AS n FROM ({_clusters_at_sql('b2', EARLIER)}) y
           WHERE cluster_label IS NOT NULL GROUP BY 1) p ON p.label = c.label"""


@register("cluster_drift", _CDRIFT_SQL)
def q_cluster_drift(spark, sf_dir):
    """Label counts now vs an earlier run, > 30% change alarms (B2)."""
    _, base = MO.cluster_drift(_clusters_at(spark, sf_dir, "b2", EARLIER), None)
    rep, _ = MO.cluster_drift(clusters_for(spark, sf_dir, "b2"), base)
    return rep


@register("new_at_risk", f"""
SELECT r.channel_id, r.title, r.days_since_last_upload, r.risk_score FROM ({report_sql('b2')}) r
WHERE r.risk_flag = 'At-Risk' AND r.channel_id NOT IN (
  SELECT channel_id FROM ({_clusters_at_sql('b2', EARLIER)}) p WHERE risk_flag = 'At-Risk')""")
def q_new_at_risk(spark, sf_dir):
    """D3: At-Risk now, not At-Risk in the earlier run (B2)."""
    prev = _clusters_at(spark, sf_dir, "b2", EARLIER)
    return MO.new_at_risk(report_for(spark, sf_dir, "b2", ordered=False), prev)


@register("freshness", f"""
SELECT n_a, n_b, n_overlap, n_overlap < greatest(n_a, n_b) AS stale, n_overlap > 0 AS ok FROM
  (SELECT count(DISTINCT channel_id) AS n_a FROM ({clusters_sql('b1')}) a) x,
  (SELECT count(DISTINCT channel_id) AS n_b FROM ({O.binding_features_sql('b2')}) b) y,
  (SELECT count(*) AS n_overlap FROM (SELECT DISTINCT channel_id FROM ({clusters_sql('b1')}) a
      INTERSECT SELECT DISTINCT channel_id FROM ({O.binding_features_sql('b2')}) b) i) z""")
def q_freshness(spark, sf_dir):
    """Id overlap of a clusters table (B1) and a features table (B2)."""
    return MO.freshness(clusters_for(spark, sf_dir, "b1"), features_for(spark, sf_dir, "b2"))


@register("reconcile", """
SELECT table_name, actual, expected, actual - expected AS delta, coalesce(actual = expected, false) AS match FROM (
  SELECT 'channels' AS table_name, (SELECT count(*) FROM customer) AS actual, (SELECT count(*) FROM customer) AS expected
  UNION ALL SELECT 'videos', (SELECT count(*) FROM orders),
                   (SELECT count(*) FROM orders)
  UNION ALL SELECT 'creator_clusters', CAST(NULL AS BIGINT), 0) r""")
def q_reconcile(spark, sf_dir):
    """Loaded rows vs source rows; unknown table -> no match (B2)."""
    tables = {"channels": BD.b2_channels(spark, sf_dir), "videos": BD.b2_videos(spark, sf_dir)}
    expected = {"channels": BD.table(spark, sf_dir, "customer"), "videos": BD.table(spark, sf_dir, "orders"),
                "creator_clusters": 0}
    return MG.reconcile(tables, expected)


# ---- merges --------------------------------------------------------------------

LATER = _dt.datetime(1998, 1, 1)
SNAP_1 = _dt.date(1999, 12, 31)
SNAP_2 = _dt.date(2000, 1, 1)


def _b2_channels_at(spark, sf_dir, ref):
    cus = BD.table(spark, sf_dir, "customer")
    cnt = BD.table(spark, sf_dir, "orders").where(F.col("o_orderdate") < S.ntz_lit(ref)) \
        .groupBy(F.col("o_custkey").alias("c_custkey")).agg(F.count(F.lit(1)).alias("video_count"))
    return cus.join(cnt, "c_custkey", "inner").select(
        F.col("c_custkey").alias("channel_id"), F.col("c_name").alias("title"),
        F.when(F.col("c_acctbal") >= 0, F.floor(F.col("c_acctbal") * 100).cast("bigint")).alias("subscriber_count"),
        F.col("video_count").cast("bigint"))


def _b2_channels_at_sql(ref):
    return f"""
SELECT c.c_custkey AS channel_id, c.c_name AS title,
       CASE WHEN c.c_acctbal >= 0 THEN CAST(floor(c.c_acctbal * 100) AS BIGINT) END AS subscriber_count,
       CAST(o.video_count AS BIGINT) AS video_count
FROM customer c JOIN (SELECT o_custkey, count(*) AS video_count FROM orders WHERE o_orderdate < {O.ts(ref)}
                      GROUP BY o_custkey) o ON o.o_custkey = c.c_custkey"""


def _channel_updates(spark, sf_dir):
    ch = BD.b2_channels(spark, sf_dir).withColumn("seq", F.lit(1))
    seg = BD.table(spark, sf_dir, "customer").where(F.col("c_mktsegment") == "BUILDING") \
        .select(F.col("c_custkey").alias("channel_id"))
    v2 = ch.join(seg, "channel_id", "left_semi").withColumn("title", F.concat(F.col("title"), F.lit(" v2"))) \
        .withColumn("seq", F.lit(2))
    return ch.unionByName(v2)


_CH_UPD_SQL = f"""
SELECT *, 1 AS seq FROM ({O.B2_CHANNELS}) a
UNION ALL
SELECT channel_id, title || ' v2' AS title, subscriber_count, video_count, 2 AS seq FROM ({O.B2_CHANNELS}) b
WHERE channel_id IN (SELECT c_custkey FROM customer WHERE c_mktsegment = 'BUILDING')"""


def _upsert_sql(target: str, updates: str, keys: list[str], cols: list[str], update_cols: list[str], seq: str) -> str:
    on = " AND ".join(f"t.{k} = u.{k}" for k in keys)
    part = ", ".join(keys)
    sel = [f"coalesce(u.{k}, t.{k}) AS {k}" for k in keys]
    mark_u = f"u.{keys[0]} IS NOT NULL"
    mark_t = f"t.{keys[0]} IS NOT NULL"
    for c in cols:
        if c in keys:
            continue
        if c in update_cols:
            sel.append(f"CASE WHEN {mark_u} THEN u.{c} ELSE t.{c} END AS {c}")
        else:
            sel.append(f"CASE WHEN {mark_t} THEN t.{c} ELSE u.{c} END AS {c}")
    return f"""
SELECT {', '.join(sel)} FROM ({target}) t FULL OUTER JOIN (
  SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY {part} ORDER BY {seq} DESC) AS _rn FROM ({updates}) x) y
  WHERE _rn = 1) u ON {on}"""


_CH_COLS = ["channel_id", "title", "subscriber_count", "video_count"]


@register("upsert_channels", _upsert_sql(_b2_channels_at_sql(LATER), _CH_UPD_SQL, ["channel_id"], _CH_COLS,
                                         _CH_COLS, "seq"))
def q_upsert_channels(spark, sf_dir):
    """K5: insert-or-update all columns; repeated keys in the batch: last wins (B2)."""
    return MG.upsert(_b2_channels_at(spark, sf_dir, LATER), _channel_updates(spark, sf_dir), ["channel_id"], seq_col="seq")


def _snapshots(spark, sf_dir, day, bump_segment=None):
    ch = _b2_channels_at(spark, sf_dir, _dt.datetime.combine(day, _dt.time()))
    s = ch.select("channel_id", F.lit(day).alias("snapshot_date"), "subscriber_count", "video_count")
    if bump_segment:
        seg = BD.table(spark, sf_dir, "customer").where(F.col("c_mktsegment") == bump_segment) \
            .select(F.col("c_custkey").alias("channel_id"))
        s = s.join(seg, "channel_id", "left_semi").withColumn("subscriber_count", F.col("subscriber_count") + 1)
    return s


def _snapshots_sql(day, bump_segment=None):
    base = _b2_channels_at_sql(_dt.datetime.combine(day, _dt.time()))
    sub = "subscriber_count + 1" if bump_segment else "subscriber_count"
    where = (f" WHERE channel_id IN (SELECT c_custkey FROM customer WHERE c_mktsegment = '{bump_segment}')"
             if bump_segment else "")
    return (f"SELECT channel_id, CAST(DATE '{day.isoformat()}' AS TIMESTAMP) AS snapshot_date, {sub} AS subscriber_count, video_count "
            f"FROM ({base}) b{where}")


_SNAP_COLS = ["channel_id", "snapshot_date", "subscriber_count", "video_count"]
_SNAP_UPD_SQL = (f"SELECT *, 1 AS seq FROM ({_snapshots_sql(SNAP_1, 'MACHINERY')}) a "
                 f"UNION ALL SELECT *, 1 AS seq FROM ({_snapshots_sql(SNAP_2)}) b")


@register("upsert_snapshots", _upsert_sql(_snapshots_sql(SNAP_1), _SNAP_UPD_SQL, ["channel_id", "snapshot_date"],
                                          _SNAP_COLS, _SNAP_COLS, "seq"))
def q_upsert_snapshots(spark, sf_dir):
    """K6: composite key; a same-day rerun replaces, a new day appends (B2)."""
    target = _snapshots(spark, sf_dir, SNAP_1)
    upd = _snapshots(spark, sf_dir, SNAP_1, "MACHINERY").unionByName(_snapshots(spark, sf_dir, SNAP_2))
    return MG.upsert(target, upd.withColumn("seq", F.lit(1)), ["channel_id", "snapshot_date"], seq_col="seq")


VIDEO_TARGET_REF = _dt.datetime(1999, 7, 1)
_V_COLS = ["video_id", "channel_id", "published_at", "view_count", "like_count", "comment_count",
           "comments_disabled", "duration_seconds", "fetched_at"]
_V_UPDATE = ["view_count", "like_count", "comment_count", "comments_disabled", "fetched_at"]


def _videos_target(spark, sf_dir):
    return BD.b1_videos(spark, sf_dir, VIDEO_TARGET_REF).withColumn("fetched_at", S.ts_lit(VIDEO_TARGET_REF))


def _videos_updates(spark, sf_dir):
    v = BD.b1_videos(spark, sf_dir)
    return v.select("video_id", "channel_id",
                    (F.col("published_at") + F.make_interval(days=F.lit(1))).alias("published_at"),
                    (F.col("view_count") * 2).alias("view_count"), (F.col("like_count") + 1).alias("like_count"),
                    "comment_count", "comments_disabled", (F.col("duration_seconds") + 1).alias("duration_seconds"),
                    S.ts_lit(BD.B1.ref).alias("fetched_at"), F.lit(1).alias("seq"))


_VT_SQL = f"SELECT *, {O.ts(VIDEO_TARGET_REF)} AS fetched_at FROM ({O.b1_videos_sql(VIDEO_TARGET_REF)}) v"
_VU_SQL = (f"SELECT video_id, channel_id, published_at + INTERVAL 1 DAY AS published_at, view_count * 2 AS view_count, "
           f"like_count + 1 AS like_count, comment_count, comments_disabled, duration_seconds + 1 AS duration_seconds, "
           f"{O.ts(BD.B1.ref)} AS fetched_at, 1 AS seq FROM ({O.B1_VIDEOS}) v")


@register("upsert_videos_partial", _upsert_sql(_VT_SQL, _VU_SQL, ["video_id"], _V_COLS, _V_UPDATE, "seq"))
def q_upsert_videos_partial(spark, sf_dir):
    """K7: counters and fetch time update; channel, publish time, duration are insert-only (B1)."""
    return MG.upsert(_videos_target(spark, sf_dir), _videos_updates(spark, sf_dir), ["video_id"],
                     update_cols=_V_UPDATE, seq_col="seq")


FEAT_TARGET_REF = _dt.datetime(1999, 12, 1)


@register("upsert_features", _upsert_sql(
    _features_at_sql("b1", FEAT_TARGET_REF),
    f"SELECT * EXCLUDE (freq_trend_ratio), CAST(NULL AS DOUBLE) AS freq_trend_ratio, 1 AS seq "
    f"FROM ({O.binding_features_sql('b1')}) f",
    ["channel_id"], FE.FEATURE_OUTPUT, FE.FEATURE_OUTPUT, "seq"))
def q_upsert_features(spark, sf_dir):
    """K8: merge a features batch that lacks freq_trend_ratio (schema aligned, NULL) (B1)."""
    target = _features_at(spark, sf_dir, "b1", FEAT_TARGET_REF)
    upd = features_for(spark, sf_dir, "b1").drop("freq_trend_ratio").withColumn("seq", F.lit(1))
    return MG.upsert(target, upd, ["channel_id"], seq_col="seq")


_CL_COLS = ["channel_id", "model_version", "algorithm", "cluster_id", "cluster_label", "risk_flag", "risk_score",
            "confidence", "distance_to_centroid", "scored_at"]


def _alg_sql(mv):
    return f"coalesce(split_part({mv}, '_', 1), 'kmeans')"


@register("upsert_clusters", _upsert_sql(
    f"SELECT channel_id, 'kmeans_v1' AS model_version, {_alg_sql(repr('kmeans_v1'))} AS algorithm, cluster_id, "
    f"cluster_label, risk_flag, risk_score, confidence, distance_to_centroid, scored_at FROM ({clusters_sql('b1')}) c",
    f"SELECT channel_id, mv AS model_version, {_alg_sql('mv')} AS algorithm, cluster_id, cluster_label, risk_flag, "
    f"risk_score, confidence, distance_to_centroid, scored_at, 1 AS seq FROM "
    f"(SELECT *, CASE WHEN risk_flag = 'Unscored' THEN NULL ELSE 'gmm_v1' END AS mv FROM ({clusters_sql('b2')}) c) x",
    ["channel_id"], _CL_COLS, _CL_COLS, "seq"))
def q_upsert_clusters(spark, sf_dir):
    """K9: clusters merge with algorithm derived from model_version (NULL -> kmeans)."""
    t = MG.with_algorithm(clusters_for(spark, sf_dir, "b1").withColumn("model_version", F.lit("kmeans_v1")))
    u = clusters_for(spark, sf_dir, "b2").withColumn(
        "model_version", F.when(F.col("risk_flag") != "Unscored", F.lit("gmm_v1")))
    u = MG.with_algorithm(u).withColumn("seq", F.lit(1))
    return MG.upsert(t.select(*_CL_COLS), u.select(*_CL_COLS, "seq"), ["channel_id"], seq_col="seq")

"""SQL text (DuckDB dialect) that computes the same frames as the Spark jobs,
for the side-by-side correctness check. Built from small fragments so every
query states its full derivation from the base tables."""

from __future__ import annotations

from ..sources.bindings import B1, B2, B3

MICROS_PER_DAY = 86400000000


def ts(ref) -> str:
    return f"TIMESTAMP '{ref.strftime('%Y-%m-%d %H:%M:%S')}'"


def days_between(ref_sql: str, t: str) -> str:
    return f"CAST(floor((epoch_us({ref_sql}) - epoch_us({t})) / {MICROS_PER_DAY}) AS BIGINT)"


# ---- bindings --------------------------------------------------------------

B1_CHANNELS = """
SELECT s.s_suppkey AS channel_id, s.s_name AS title,
       CASE WHEN s.s_acctbal >= 0 THEN CAST(floor(s.s_acctbal * 100) AS BIGINT) END AS subscriber_count,
       CAST(coalesce(c.video_count, 0) AS BIGINT) AS video_count
FROM supplier s
LEFT JOIN (SELECT l_suppkey, count(*) AS video_count FROM lineitem GROUP BY l_suppkey) c
       ON c.l_suppkey = s.s_suppkey"""

def b1_videos_raw_sql(before=None) -> str:
    where = f" WHERE l_shipdate < {ts(before)}" if before else ""
    return f"""
SELECT CAST(l_orderkey AS VARCHAR) || '-' || CAST(l_linenumber AS VARCHAR) AS video_id,
       l_suppkey AS channel_id, l_shipdate AS published_at,
       CAST(floor(l_extendedprice) AS BIGINT) AS view_count,
       CAST(floor(l_quantity) AS BIGINT) AS like_count,
       CASE WHEN l_returnflag <> 'N' THEN CAST(round(l_tax * 100) AS BIGINT) END AS comment_count,
       l_returnflag = 'N' AS comments_disabled,
       CAST(floor(l_quantity * 37) AS INTEGER) AS duration_seconds,
       l_shipdate, l_suppkey, l_partkey, l_extendedprice, l_quantity, l_discount, l_tax, l_returnflag, l_linestatus
FROM lineitem{where}"""


B1_VIDEOS_RAW = b1_videos_raw_sql()

VIDEO_COLS = ("video_id, channel_id, published_at, view_count, like_count, comment_count, "
              "comments_disabled, duration_seconds")

def b1_videos_sql(before=None) -> str:
    return f"""
SELECT {VIDEO_COLS} FROM (
  SELECT *, row_number() OVER (PARTITION BY video_id ORDER BY l_shipdate NULLS FIRST, l_suppkey NULLS FIRST,
         l_partkey NULLS FIRST, l_extendedprice NULLS FIRST, l_quantity NULLS FIRST, l_discount NULLS FIRST,
         l_tax NULLS FIRST, l_returnflag NULLS FIRST, l_linestatus NULLS FIRST) AS _rn
  FROM ({b1_videos_raw_sql(before)}) r) d
WHERE _rn = 1"""


B1_VIDEOS = b1_videos_sql()

B2_CHANNELS = """
SELECT c.c_custkey AS channel_id, c.c_name AS title,
       CASE WHEN c.c_acctbal >= 0 THEN CAST(floor(c.c_acctbal * 100) AS BIGINT) END AS subscriber_count,
       CAST(coalesce(o.video_count, 0) AS BIGINT) AS video_count
FROM customer c
LEFT JOIN (SELECT o_custkey, count(*) AS video_count FROM orders GROUP BY o_custkey) o
       ON o.o_custkey = c.c_custkey"""

def b2_videos_sql(before=None) -> str:
    where = f" WHERE o_orderdate < {ts(before)}" if before else ""
    return f"""
SELECT CAST(o_orderkey AS VARCHAR) AS video_id, o_custkey AS channel_id, o_orderdate AS published_at,
       CAST(floor(o_totalprice) AS BIGINT) AS view_count,
       CAST(o_orderkey % 97 AS BIGINT) AS like_count,
       CASE WHEN o_orderpriority <> '5-LOW' THEN CAST(o_orderkey % 7 AS BIGINT) END AS comment_count,
       o_orderpriority = '5-LOW' AS comments_disabled,
       CAST((o_orderkey % 50) * 30 AS INTEGER) AS duration_seconds
FROM orders{where}"""


B2_VIDEOS = b2_videos_sql()

B3_CHANNELS = """
SELECT user_id AS channel_id, 'user-' || CAST(user_id AS VARCHAR) AS title,
       CAST(NULL AS BIGINT) AS subscriber_count, CAST(count(*) AS BIGINT) AS video_count
FROM events GROUP BY user_id"""

B3_VIDEOS = """
SELECT CAST(event_id AS VARCHAR) AS video_id, user_id AS channel_id, ts AS published_at,
       CAST(floor(value) AS BIGINT) AS view_count,
       TRY_CAST(json_extract_string(props, '$.k') AS BIGINT) AS like_count,
       CASE WHEN event_type <> 'error' THEN CAST(event_id % 5 AS BIGINT) END AS comment_count,
       event_type = 'error' AS comments_disabled,
       CAST(event_id % 600 AS INTEGER) AS duration_seconds
FROM events"""

BINDING_SQL = {
    "b1": (B1, B1_CHANNELS, B1_VIDEOS),
    "b2": (B2, B2_CHANNELS, B2_VIDEOS),
    "b3": (B3, B3_CHANNELS, B3_VIDEOS),
}


# ---- features ----------------------------------------------------------------

def video_metrics_sql(videos_sql: str, ref, short: int, long: int) -> str:
    r = ts(ref)
    d = days_between(r, "published_at")
    order = "ORDER BY published_at ASC NULLS LAST, video_id ASC NULLS LAST"
    return f"""
SELECT channel_id, video_id, published_at,
       coalesce(published_at >= {r} - INTERVAL {short} DAY, false) AS in_short,
       coalesce(published_at >= {r} - INTERVAL {long} DAY, false) AS in_long,
       coalesce(published_at >= {r} - INTERVAL {long} DAY, false)
         AND NOT coalesce(published_at >= {r} - INTERVAL {short} DAY, false) AS in_between,
       {d} AS days_old,
       CASE WHEN published_at IS NOT NULL AND view_count IS NOT NULL
            THEN CAST(view_count AS DOUBLE) / CAST(greatest({d}, 1) AS DOUBLE) END AS vpd,
       CASE WHEN view_count IS NOT NULL AND view_count <> 0
            THEN least(greatest((coalesce(CAST(like_count AS DOUBLE), 0) + coalesce(CAST(comment_count AS DOUBLE), 0))
                                / CAST(view_count AS DOUBLE), 0.0), 1.0) END AS eng,
       CAST(duration_seconds AS DOUBLE) / 60.0 AS dur_min,
       row_number() OVER (PARTITION BY channel_id {order}) AS rank,
       count(*) OVER (PARTITION BY channel_id) AS n_videos,
       lag(published_at) OVER (PARTITION BY channel_id {order}) AS prev_published_at
FROM ({videos_sql}) v WHERE channel_id IS NOT NULL"""


def channel_aggregates_sql(metrics_sql: str) -> str:
    gap = f"CAST(floor((epoch_us(published_at) - epoch_us(prev_published_at)) / {MICROS_PER_DAY}) AS BIGINT)"
    older = "rank <= floor(n_videos / 2)"
    return f"""
SELECT channel_id, count(*) AS n_all,
       sum(CAST(in_short AS INTEGER)) AS n_short, sum(CAST(in_long AS INTEGER)) AS n_long,
       max(published_at) AS last_upload,
       avg(CASE WHEN in_short THEN vpd END) AS vpd_recent,
       avg(CASE WHEN in_between THEN vpd END) AS vpd_older,
       avg(CASE WHEN {older} THEN vpd END) AS vpd_half_older,
       avg(CASE WHEN NOT ({older}) THEN vpd END) AS vpd_half_recent,
       avg(eng) AS eng,
       stddev_samp({gap}) AS gap_std,
       avg(CASE WHEN in_short THEN dur_min END) AS dur_recent,
       avg(dur_min) AS dur_all
FROM ({metrics_sql}) m GROUP BY channel_id"""


def features_sql(channels_sql: str, videos_sql: str, ref, short: int = 30, long: int = 90,
                 min_videos: int = 2) -> str:
    agg = channel_aggregates_sql(video_metrics_sql(videos_sql, ref, short, long))
    r = ts(ref)
    f_s = f"(a.n_short / {float(short)})"
    f_l = f"(a.n_long / {float(long)})"
    has = "coalesce(a.n_long, 0) > 0"
    mom = ("CASE WHEN vpd_recent IS NOT NULL AND vpd_older IS NOT NULL AND vpd_older > 0 THEN vpd_recent / vpd_older "
           "WHEN n_all >= 4 THEN CASE WHEN vpd_half_recent IS NOT NULL AND vpd_half_older IS NOT NULL "
           "AND vpd_half_older > 0 THEN vpd_half_recent / vpd_half_older END END")
    return f"""
SELECT i.channel_id, CAST({r} AS TIMESTAMP) AS computed_at,
       CASE WHEN {has} THEN {f_s} END AS upload_freq_30d,
       CASE WHEN {has} THEN {f_l} END AS upload_freq_90d,
       CASE WHEN {has} AND {f_l} > 0 THEN {f_s} / {f_l} END AS freq_trend_ratio,
       CASE WHEN {has} THEN {mom} END AS momentum_ratio,
       CASE WHEN {has} THEN a.eng END AS avg_engagement_rate,
       CASE WHEN {has} AND a.last_upload IS NOT NULL
            THEN CAST(greatest({days_between(r, 'a.last_upload')}, 0) AS BIGINT) END AS days_since_last_upload,
       CASE WHEN {has} AND a.n_all >= 3 THEN a.gap_std END AS upload_regularity,
       CASE WHEN {has} THEN (CASE WHEN a.n_short > 0 THEN a.dur_recent ELSE a.dur_all END) END AS duration_trend,
       (NOT ({has}) OR (a.n_short < {min_videos} AND a.n_long < {min_videos})) AS insufficient_history
FROM (SELECT DISTINCT channel_id FROM ({channels_sql}) c
      WHERE channel_id IS NOT NULL AND EXISTS (SELECT 1 FROM ({videos_sql}) v0)) i
LEFT JOIN ({agg}) a ON a.channel_id = i.channel_id"""


def binding_features_sql(name: str) -> str:
    b, ch, vi = BINDING_SQL[name]
    return features_sql(ch, vi, b.ref, b.short, b.long)


# ---- scoring -----------------------------------------------------------------

# Literal values, so that a wrong value in the library shows as a difference.
WEIGHTS = {"upload_freq_30d": 0.20, "upload_freq_90d": 0.1, "freq_trend_ratio": 0.10, "momentum_ratio": 0.30,
           "avg_engagement_rate": 0.15, "days_since_last_upload": 0.15, "upload_regularity": 0.10}
LABELS = ["Low Momentum — Declining Engagement", "Mid-Low Momentum — Occasional Uploaders",
          "Mid Momentum — Regular Creators", "Mid-High Momentum — Active Creators", "High Momentum — Frequent Uploaders"]

def dbl(x: float) -> str:
    return f"CAST('{x!r}' AS DOUBLE)"


def risk_component_sql(name: str, v: str) -> str:
    if name == "days_since_last_upload":
        return f"({v} / ({v} + 30.0))"
    if name in ("upload_freq_30d", "upload_freq_90d", "momentum_ratio", "freq_trend_ratio"):
        return f"(1.0 / (1.0 + {v}))"
    if name == "avg_engagement_rate":
        return f"(1.0 / (1.0 + {v} * 100.0))"
    if name == "upload_regularity":
        return f"({v} / ({v} + 14.0))"
    return f"({v} / ({v} + 1.0))"


def risk_score_sql() -> str:
    total, weight = "0.0", sum(WEIGHTS.values())
    for c, w in WEIGHTS.items():
        w = w / weight
        v = f"coalesce(CAST({c} AS DOUBLE), 0.0)"
        total = f"({total} + {dbl(w)} * {risk_component_sql(c, v)})"
    return f"least(greatest({total}, 0.0), 1.0)"


def label_sql(i: str, n: str) -> str:
    t = [f"'{x}'" for x in LABELS]
    return (f"CASE WHEN {n} = 1 THEN 'Single Cluster — All Creators' "
            f"WHEN {n} = 2 THEN CASE WHEN {i} = 0 THEN {t[0]} ELSE {t[4]} END "
            f"WHEN {n} = 3 THEN CASE WHEN {i} = 0 THEN {t[0]} WHEN {i} = {n} - 1 THEN {t[4]} ELSE {t[2]} END "
            f"WHEN {n} = 4 THEN CASE {i} WHEN 0 THEN {t[0]} WHEN 1 THEN {t[1]} WHEN 2 THEN {t[3]} ELSE {t[4]} END "
            f"ELSE CASE WHEN {i} = 0 THEN {t[0]} WHEN {i} = 1 THEN {t[1]} WHEN {i} = 2 THEN {t[2]} "
            f"WHEN {i} = 3 THEN {t[3]} ELSE {t[4]} END END")


def thresholds_sql(scored_sql: str) -> str:
    """(lo, hi) tier thresholds (N8) over a frame with risk_score."""
    return f"""
SELECT CASE WHEN lo >= hi THEN med * 0.95 ELSE lo END AS lo,
       CASE WHEN lo >= hi THEN med * 1.05 ELSE hi END AS hi
FROM (SELECT max(CASE WHEN i = greatest(CAST(floor(n * CAST(0.3 AS DOUBLE)) AS BIGINT) - 1, 0) THEN risk_score END) AS lo,
             max(CASE WHEN i = least(CAST(ceil(n * CAST(0.7 AS DOUBLE)) AS BIGINT), n - 1) THEN risk_score END) AS hi,
             (max(CASE WHEN i = (n - 1) // 2 THEN risk_score END) + max(CASE WHEN i = n // 2 THEN risk_score END)) / 2.0 AS med
      FROM (SELECT risk_score, row_number() OVER (ORDER BY risk_score) - 1 AS i, count(*) OVER () AS n
            FROM ({scored_sql}) q WHERE risk_score IS NOT NULL) o) t"""


def tier_sql(score: str = "risk_score") -> str:
    return f"CASE WHEN {score} <= th.lo THEN 'Healthy' WHEN {score} >= th.hi THEN 'At-Risk' ELSE 'Watch' END"


FEATURE_NAMES = ("channel_id, computed_at, upload_freq_30d, upload_freq_90d, freq_trend_ratio, momentum_ratio, "
                 "avg_engagement_rate, days_since_last_upload, upload_regularity, duration_trend, insufficient_history")


def fixed_clusters_sql(features: str, cluster_expr: str, ref, model_version: str = "fixed_v1") -> str:
    """Scoring with a given cluster id: P14 -> P12 -> W4 -> W3 -> U1."""
    s = (f"SELECT {FEATURE_NAMES}, {risk_score_sql()} AS risk_score, CAST({cluster_expr} AS INTEGER) AS cluster_id "
         f"FROM ({features}) f WHERE NOT coalesce(insufficient_history, true)")
    return f"""
WITH s AS ({s}),
lab AS (SELECT cluster_id, {label_sql('i', 'n')} AS cluster_label FROM (
          SELECT cluster_id, row_number() OVER (ORDER BY avg(risk_score) DESC NULLS LAST, cluster_id) - 1 AS i,
                 count(*) OVER () AS n FROM s GROUP BY cluster_id) c),
th AS ({thresholds_sql('SELECT risk_score FROM s')})
SELECT s.*, lab.cluster_label, CASE WHEN s.risk_score IS NOT NULL THEN {tier_sql('s.risk_score')} END AS risk_flag,
       '{model_version}' AS model_version, {ts(ref)} AS scored_at,
       CAST(NULL AS DOUBLE) AS distance_to_centroid, CAST(NULL AS DOUBLE) AS confidence
FROM s LEFT JOIN lab ON lab.cluster_id = s.cluster_id LEFT JOIN th ON true
UNION ALL
SELECT {FEATURE_NAMES}, CAST(NULL AS DOUBLE) AS risk_score, CAST(-1 AS INTEGER) AS cluster_id,
       'Unscored' AS cluster_label, 'Unscored' AS risk_flag, '{model_version}' AS model_version, {ts(ref)} AS scored_at,
       CAST(NULL AS DOUBLE) AS distance_to_centroid, CAST(NULL AS DOUBLE) AS confidence
FROM ({features}) f WHERE coalesce(insufficient_history, true)"""

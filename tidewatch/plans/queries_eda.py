"""EDA queries (A11-A15, A20, A24, R4) and cleaning queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import rules as R
from ..operators import clean as CL
from ..operators import eda as ED
from ..sources import bindings as BD
from . import oracle as O
from .catalog import register
from .queries_core import features_for


def feats_sql(name):
    return O.binding_features_sql(name)


def _counts_sql(f):
    return (f"SELECT count(*) AS row_count, count_if(insufficient_history = TRUE) AS insufficient_count, "
            f"count_if(NOT insufficient_history) AS scored_count FROM ({f}) f")


def _profile_sql(f, kind):
    cols = ED.NULL_FEATURES if kind == "null" else ED.ZERO_FEATURES
    parts = []
    for c in cols:
        cond = f"{c} IS NULL" if kind == "null" else f"CAST({c} AS DOUBLE) = 0"
        parts.append(f"SELECT '{c}' AS feature, count_if({cond}) AS n, count(*) AS _rows FROM s")
    return (f"WITH s AS (SELECT * FROM ({f}) f WHERE NOT insufficient_history) "
            f"SELECT feature, n, CASE WHEN _rows <> 0 THEN CAST(n AS DOUBLE) * 100.0 / CAST(_rows AS DOUBLE) END AS pct "
            f"FROM ({' UNION ALL '.join(parts)}) u WHERE _rows > 0")


def _summary_sql(f, cols=ED.SUMMARY_FEATURES):
    parts = []
    for c in cols:
        x = "x"
        parts.append(
            f"SELECT '{c}' AS feature, count(*) AS n, round(avg({x}), 4) AS mean, round(stddev_samp({x}), 4) AS std, "
            f"round(min({x}), 4) AS min, round(quantile_cont({x}, 0.25), 4) AS p25, "
            f"round(quantile_cont({x}, 0.5), 4) AS median, round(quantile_cont({x}, 0.75), 4) AS p75, "
            f"round(max({x}), 4) AS max FROM (SELECT CAST({c} AS DOUBLE) AS x FROM ({f}) f WHERE {c} IS NOT NULL) v "
            f"HAVING count(*) > 0")
    return " UNION ALL ".join(parts)


def _pair_corr_sql(a, b):
    flt = f"FILTER (WHERE {a} IS NOT NULL AND {b} IS NOT NULL)"
    return (f"covar_pop({a}, {b}) {flt} / nullif(sqrt(var_pop({a}) {flt}) * sqrt(var_pop({b}) {flt}), 0)")


def _corr_sql(f):
    cols = ", ".join(f"round({_pair_corr_sql(a, b)}, 4) AS {n}" for n, a, b in ED.CORR_PAIRS)
    src = ", ".join(f"CAST({c} AS DOUBLE) AS {c}" for c in ED.SUMMARY_FEATURES)
    return (f"SELECT {cols} FROM (SELECT {src} FROM ({f}) f WHERE upload_freq_30d IS NOT NULL "
            f"AND momentum_ratio IS NOT NULL AND avg_engagement_rate IS NOT NULL) s")


@register("eda_counts", _counts_sql(feats_sql("b2")))
def q_eda_counts(spark, sf_dir):
    """Total / insufficient / scored rows (B2)."""
    return ED.eda_counts(features_for(spark, sf_dir, "b2"))


@register("eda_null_counts", _profile_sql(feats_sql("b2"), "null"))
def q_eda_null_counts(spark, sf_dir):
    """NULL counts per feature over scored rows (B2)."""
    return ED.null_zero_profile(features_for(spark, sf_dir, "b2"), "null")


@register("eda_zero_counts", _profile_sql(feats_sql("b2"), "zero"))
def q_eda_zero_counts(spark, sf_dir):
    """Zero counts per feature over scored rows (B2)."""
    return ED.null_zero_profile(features_for(spark, sf_dir, "b2"), "zero")


@register("eda_feature_summary", _summary_sql(feats_sql("b1")))
def q_eda_feature_summary(spark, sf_dir):
    """N, mean, std, min, quartiles, max per feature (B1), exact quantiles."""
    return ED.feature_summary(features_for(spark, sf_dir, "b1"))


@register("eda_feature_summary_b2", _summary_sql(feats_sql("b2")))
def q_eda_feature_summary_b2(spark, sf_dir):
    """A13 on B2 (many NULL features)."""
    return ED.feature_summary(features_for(spark, sf_dir, "b2"))


@register("eda_correlations", _corr_sql(feats_sql("b1")))
def q_eda_correlations(spark, sf_dir):
    """The seven fixed Pearson pairs (B1)."""
    return ED.correlations(features_for(spark, sf_dir, "b1"))


def _matrix_sql(f, cols):
    parts = [f"SELECT '{a}' AS row_feature, '{b}' AS col_feature, {_pair_corr_sql(a, b)} AS corr FROM s"
             for a in cols for b in cols]
    src = ", ".join(f"CAST({c} AS DOUBLE) AS {c}" for c in cols)
    return (f"WITH s AS (SELECT {src} FROM ({f}) f WHERE NOT coalesce(insufficient_history, true)) "
            + " UNION ALL ".join(parts))


@register("correlation_matrix", _matrix_sql(feats_sql("b2"), R.FEATURE_COLUMNS))
def q_correlation_matrix(spark, sf_dir):
    """7x7 pairwise-complete Pearson matrix over scored rows (B2)."""
    f = features_for(spark, sf_dir, "b2").where(~F.coalesce(F.col("insufficient_history"), F.lit(True)))
    return ED.correlation_matrix(f, R.FEATURE_COLUMNS)


HIST_COLS = ["upload_freq_30d", "upload_freq_90d", "freq_trend_ratio", "momentum_ratio", "avg_engagement_rate",
             "days_since_last_upload", "upload_regularity", "duration_trend"]


def _hist_sql(f, cols, bins=50):
    parts = []
    for c in cols:
        parts.append(f"SELECT '{c}' AS feature, CAST({c} AS DOUBLE) AS value FROM ({f}) f WHERE {c} IS NOT NULL")
    lf = " UNION ALL ".join(parts)
    return f"""
WITH lf AS ({lf}),
r AS (SELECT feature, CASE WHEN max(value) > min(value) THEN min(value) ELSE min(value) - 0.5 END AS lo,
             CASE WHEN max(value) > min(value) THEN max(value) ELSE max(value) + 0.5 END AS hi FROM lf GROUP BY feature)
SELECT feature, bin, lo + bin * ((hi - lo) / {float(bins)}) AS bin_lo, lo + (bin + 1) * ((hi - lo) / {float(bins)}) AS bin_hi,
       count(*) AS n
FROM (SELECT lf.feature, r.lo, r.hi,
             CAST(least(floor((lf.value - r.lo) / ((r.hi - r.lo) / {float(bins)})), {bins - 1}) AS INTEGER) AS bin
      FROM lf JOIN r ON r.feature = lf.feature) b
GROUP BY feature, bin, lo, hi"""


@register("feature_histogram", _hist_sql(feats_sql("b1"), HIST_COLS))
def q_feature_histogram(spark, sf_dir):
    """50 equal-width bins per feature (B1)."""
    return ED.feature_histogram(features_for(spark, sf_dir, "b1"), HIST_COLS)


MEAN_COLS = ["upload_freq_30d", "upload_freq_90d", "freq_trend_ratio", "momentum_ratio", "avg_engagement_rate",
             "days_since_last_upload", "upload_regularity", "duration_trend"]


def _means_sql(f, cols):
    return " UNION ALL ".join(f"SELECT '{c}' AS feature, avg(CAST({c} AS DOUBLE)) AS mean FROM ({f}) f" for c in cols)


@register("feature_means", _means_sql(feats_sql("b2"), MEAN_COLS))
def q_feature_means(spark, sf_dir):
    """Mean of every numeric feature column (B2)."""
    return ED.feature_means(features_for(spark, sf_dir, "b2"), MEAN_COLS)


def _report_sql(f):
    counts = (f"SELECT 'counts' AS section, name, 'n' AS stat, CAST(value AS DOUBLE) AS value FROM "
              f"(UNPIVOT ({_counts_sql(f)}) ON row_count, insufficient_count, scored_count INTO NAME name VALUE value) u")
    nulls = f"SELECT 'nulls' AS section, feature AS name, 'n' AS stat, CAST(n AS DOUBLE) AS value FROM ({_profile_sql(f, 'null')}) a"
    zeros = f"SELECT 'zeros' AS section, feature AS name, 'n' AS stat, CAST(n AS DOUBLE) AS value FROM ({_profile_sql(f, 'zero')}) a"
    summ = (f"SELECT 'summary' AS section, feature AS name, stat, value FROM (UNPIVOT (SELECT feature, CAST(n AS DOUBLE) AS n, "
            f"mean, std, min, p25, median, p75, max FROM ({_summary_sql(f)}) s0) ON n, mean, std, min, p25, median, p75, max "
            f"INTO NAME stat VALUE value) s")
    # Pair by pair: UNPIVOT would drop the NULL of a constant column.
    corr = " UNION ALL ".join(f"SELECT 'correlation' AS section, '{n}' AS name, 'pearson' AS stat, {n} AS value FROM ({_corr_sql(f)}) c"
                              for n, _, _ in ED.CORR_PAIRS)
    return " UNION ALL ".join([counts, nulls, zeros, summ, corr])


@register("eda_report", _report_sql(feats_sql("b1")))
def q_eda_report(spark, sf_dir):
    """The EDA as one tidy (section, name, stat, value) table (B1)."""
    return ED.eda_report(features_for(spark, sf_dir, "b1"))


# ---- cleaning ------------------------------------------------------------------

_AUDIT_SQL = """
SELECT column_name, n_input, n_coerced, n_input > 0 AND n_coerced = n_input AS all_coerced FROM (
  SELECT 'props_k' AS column_name, count(k) AS n_input,
         count_if(k IS NOT NULL AND (TRY_CAST(k AS DOUBLE) IS NULL OR isnan(TRY_CAST(k AS DOUBLE)))) AS n_coerced
  FROM (SELECT json_extract_string(props, '$.k') AS k FROM events) e
  UNION ALL
  SELECT 'event_type' AS column_name, count(event_type), count_if(event_type IS NOT NULL AND TRY_CAST(event_type AS DOUBLE) IS NULL)
  FROM events) a"""


@register("cast_numeric_audit", _AUDIT_SQL)
def q_cast_numeric_audit(spark, sf_dir):
    """P1 audit: text casts to double, values coerced to NULL (B3 props and a text column)."""
    ev = BD.table(spark, sf_dir, "events").select(F.get_json_object("props", "$.k").alias("props_k"), "event_type")
    return CL.cast_numeric_audit(ev, ["props_k", "event_type"])


@register("cast_numeric", """
SELECT event_id, CASE WHEN isnan(TRY_CAST(json_extract_string(props, '$.k') AS DOUBLE)) THEN NULL
                      ELSE TRY_CAST(json_extract_string(props, '$.k') AS DOUBLE) END AS k,
       TRY_CAST(event_type AS DOUBLE) AS event_type_num FROM events""")
def q_cast_numeric(spark, sf_dir):
    """Text -> double, unparsable -> NULL."""
    from ..functions import scalar as S
    ev = BD.table(spark, sf_dir, "events")
    return ev.select("event_id", S.cast_numeric(F.get_json_object("props", "$.k")).alias("k"),
                     S.cast_numeric("event_type").alias("event_type_num"))


@register("safe_int", """
SELECT event_id,
       CASE WHEN regexp_full_match(trim(json_extract_string(props, '$.k')), '[+-]?[0-9]+')
            THEN TRY_CAST(trim(json_extract_string(props, '$.k')) AS BIGINT) END AS k_int,
       CASE WHEN regexp_full_match(trim(CAST(value AS VARCHAR)), '[+-]?[0-9]+')
            THEN TRY_CAST(trim(CAST(value AS VARCHAR)) AS BIGINT) END AS value_int FROM events""")
def q_safe_int(spark, sf_dir):
    """Text -> bigint; '12.5' and garbage -> NULL (B3 props and values as text)."""
    from ..functions import scalar as S
    ev = BD.table(spark, sf_dir, "events")
    return ev.select("event_id", S.safe_int(F.get_json_object("props", "$.k")).alias("k_int"),
                     S.safe_int(F.col("value").cast("string")).alias("value_int"))


_CAP_SQL = f"""
WITH ch AS ({O.B2_CHANNELS}),
q AS (SELECT quantile_cont(CAST(subscriber_count AS DOUBLE), 0.99) AS cap FROM ch WHERE subscriber_count IS NOT NULL)
SELECT channel_id, title,
       CASE WHEN CAST(subscriber_count AS DOUBLE) > q.cap THEN q.cap ELSE CAST(subscriber_count AS DOUBLE) END AS subscriber_count,
       video_count, coalesce(CAST(subscriber_count AS DOUBLE) > q.cap, false) AS subscriber_count_capped
FROM ch CROSS JOIN q"""


@register("cap_outliers", _CAP_SQL)
def q_cap_outliers(spark, sf_dir):
    """A10: subscriber counts clipped at the exact interpolated p99 (B2)."""
    return CL.cap_outliers(BD.b2_channels(spark, sf_dir), "subscriber_count", 0.99)


@register("dedup_videos", O.B1_VIDEOS)
def q_dedup_videos(spark, sf_dir):
    """First row per video_id under the binding's order (B1)."""
    return BD.b1_videos(spark, sf_dir)


@register("dedup_dropped", f"""
SELECT rows_in, rows_out, rows_in - rows_out AS dropped FROM
  (SELECT count(*) AS rows_in FROM ({O.B1_VIDEOS_RAW}) r) a CROSS JOIN (SELECT count(*) AS rows_out FROM ({O.B1_VIDEOS}) d) b""")
def q_dedup_dropped(spark, sf_dir):
    """Rows in, kept and dropped by the dedup."""
    raw = BD.b1_videos_raw(spark, sf_dir)
    return CL.dedup_with_count(raw, ["video_id"], BD.B1_DEDUP_ORDER)[1]

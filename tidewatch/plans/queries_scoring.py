"""Scoring-stage queries with a fixed, SQL-checkable cluster id (channel_id % 3):
P12, P14, W3, W4, U1, A16-A19, A21, A22, P25."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import rules as R
from ..functions import scalar as S
from ..operators import reports as RP
from ..operators import scoring as SC
from ..sources import bindings as BD
from . import oracle as O
from .catalog import register
from .queries_core import features_for

FIXED_CLUSTER = "channel_id % 3"


def clusters_for(spark, sf_dir, name="b1"):
    b = BD.BINDINGS[name][0]
    feats = features_for(spark, sf_dir, name)
    return SC.score_with_fixed_clusters(feats, F.col("channel_id") % 3, S.ts_lit(b.ref))


def feats_sql(name):
    return O.binding_features_sql(name)


def clusters_sql(name="b1"):
    b = BD.BINDINGS[name][0]
    return O.fixed_clusters_sql(feats_sql(name), FIXED_CLUSTER, b.ref)


SCORED = "WHERE risk_flag <> 'Unscored'"


@register("risk_score", f"SELECT channel_id, {O.risk_score_sql()} AS risk_score FROM ({feats_sql('b1')}) f "
                        "WHERE NOT coalesce(insufficient_history, true)")
def q_risk_score(spark, sf_dir):
    """Direct risk score of every scored channel (B1)."""
    scored, _ = SC.split_scored(features_for(spark, sf_dir, "b1"))
    return SC.with_risk_score(scored).select("channel_id", "risk_score")


@register("scored_only", f"SELECT * FROM ({feats_sql('b2')}) f WHERE NOT coalesce(insufficient_history, true)")
def q_scored_only(spark, sf_dir):
    """Rows with enough history (B2 has both kinds)."""
    return SC.split_scored(features_for(spark, sf_dir, "b2"))[0]


@register("risk_tiers", f"SELECT channel_id, risk_score, risk_flag FROM ({clusters_sql('b1')}) c {SCORED}")
def q_risk_tiers(spark, sf_dir):
    """Healthy / Watch / At-Risk from score order statistics (B1)."""
    return clusters_for(spark, sf_dir, "b1").where(F.col("risk_flag") != "Unscored") \
        .select("channel_id", "risk_score", "risk_flag")


@register("risk_tiers_b2", f"SELECT channel_id, risk_score, risk_flag FROM ({clusters_sql('b2')}) c")
def q_risk_tiers_b2(spark, sf_dir):
    """W3 on B2, unscored rows included."""
    return clusters_for(spark, sf_dir, "b2").select("channel_id", "risk_score", "risk_flag")


@register("label_clusters", f"SELECT channel_id, cluster_id, cluster_label FROM ({clusters_sql('b1')}) c {SCORED}")
def q_label_clusters(spark, sf_dir):
    """Cluster labels ranked by mean risk."""
    return clusters_for(spark, sf_dir, "b1").where(F.col("risk_flag") != "Unscored") \
        .select("channel_id", "cluster_id", "cluster_label")


@register("all_scored_union", clusters_sql("b2"))
def q_all_scored_union(spark, sf_dir):
    """Scored + unscored rows with all scoring columns (B2)."""
    return clusters_for(spark, sf_dir, "b2")


def _mode_sql(src: str, group: str, out: str) -> str:
    return (f"SELECT {group}, arg_min(risk_flag, struct_pack(c := -cnt, f := risk_flag)) AS {out} FROM "
            f"(SELECT {group}, risk_flag, count(*) AS cnt FROM ({src}) z GROUP BY {group}, risk_flag) m GROUP BY {group}")


_CP_SQL = f"""
WITH s AS (SELECT * FROM ({clusters_sql('b1')}) c {SCORED})
SELECT p.*, d.risk_flag FROM (
  SELECT cluster_id, min(cluster_label) AS cluster_label, count(*) AS size, avg(risk_score) AS mean_risk_score,
         {', '.join(f'coalesce(avg({c}), 0.0) AS mean_{c}' for c in R.FEATURE_COLUMNS)}
  FROM s GROUP BY cluster_id) p
LEFT JOIN ({_mode_sql('SELECT * FROM s', 'cluster_id', 'risk_flag')}) d ON d.cluster_id = p.cluster_id"""


@register("cluster_profile", _CP_SQL)
def q_cluster_profile(spark, sf_dir):
    """Mean features, size, mean risk and dominant tier per cluster."""
    c = clusters_for(spark, sf_dir, "b1").where(F.col("risk_flag") != "Unscored")
    return SC.cluster_profile(c)


def _radar_sql():
    cols = R.FEATURE_COLUMNS
    g = ", ".join(f"min({c}) AS mn_{c}, max({c}) AS mx_{c}, count({c}) AS n_{c}" for c in cols)
    m = ", ".join(f"avg({c}) AS m_{c}" for c in cols)
    r = ", ".join(f"CASE WHEN g.n_{c} < 2 THEN 0.5 ELSE (m.m_{c} - g.mn_{c}) / (g.mx_{c} - g.mn_{c} + 1e-10) END AS r_{c}"
                  for c in cols)
    return f"""
WITH s AS (SELECT * FROM ({clusters_sql('b1')}) c {SCORED})
SELECT m.cluster_label, d.dominant_flag, {r}
FROM (SELECT cluster_label, {m} FROM s GROUP BY cluster_label) m
CROSS JOIN (SELECT {g} FROM s) g
LEFT JOIN ({_mode_sql('SELECT * FROM s', 'cluster_label', 'dominant_flag')}) d ON d.cluster_label = m.cluster_label"""


@register("radar_profile", _radar_sql())
def q_radar_profile(spark, sf_dir):
    """Per-label normalised feature means and dominant tier."""
    c = clusters_for(spark, sf_dir, "b1").where(F.col("risk_flag") != "Unscored")
    return SC.radar_profile(c)


@register("risk_counts", f"SELECT risk_flag, count(*) AS n FROM ({clusters_sql('b2')}) c "
                         "WHERE risk_flag IS NOT NULL GROUP BY risk_flag")
def q_risk_counts(spark, sf_dir):
    """Rows per tier (B2, Unscored included)."""
    return SC.value_counts(clusters_for(spark, sf_dir, "b2"), "risk_flag")


def directory_for(spark, sf_dir, name="b2"):
    ch = BD.BINDINGS[name][1](spark, sf_dir)
    return RP.directory(ch, clusters_for(spark, sf_dir, name))


def directory_sql(name="b2"):
    ch = O.BINDING_SQL[name][1]
    return (f"SELECT ch.*, {', '.join('c.' + x for x in DIR_CLUSTER_COLS)} FROM ({ch}) ch "
            f"LEFT JOIN ({clusters_sql(name)}) c ON c.channel_id = ch.channel_id")


DIR_CLUSTER_COLS = ["computed_at", "upload_freq_30d", "upload_freq_90d", "freq_trend_ratio", "momentum_ratio",
                    "avg_engagement_rate", "days_since_last_upload", "upload_regularity", "duration_trend",
                    "insufficient_history", "risk_score", "cluster_id", "cluster_label", "risk_flag",
                    "model_version", "scored_at", "distance_to_centroid", "confidence"]

_KPI_SQL = f"""
SELECT total, healthy, watch, at_risk, unscored, healthy + watch + at_risk AS scored_count, scored_rows,
       CASE WHEN total > 0 THEN healthy / total * 100 END AS healthy_pct,
       CASE WHEN total > 0 THEN watch / total * 100 END AS watch_pct,
       CASE WHEN total > 0 THEN at_risk / total * 100 END AS at_risk_pct,
       avg_momentum, avg_engagement_pct
FROM (SELECT count(*) AS total, count_if(risk_flag = 'Healthy') AS healthy, count_if(risk_flag = 'Watch') AS watch,
             count_if(risk_flag = 'At-Risk') AS at_risk, count_if(risk_flag = 'Unscored') AS unscored,
             count_if(NOT coalesce(insufficient_history, true)) AS scored_rows,
             avg(momentum_ratio) FILTER (WHERE NOT coalesce(insufficient_history, true)) AS avg_momentum,
             avg(avg_engagement_rate) FILTER (WHERE NOT coalesce(insufficient_history, true)) * 100 AS avg_engagement_pct
      FROM ({directory_sql('b2')}) d) a"""


@register("kpis", _KPI_SQL)
def q_kpis(spark, sf_dir):
    """Tier totals, shares and scored means over the directory (B2)."""
    return SC.kpis(directory_for(spark, sf_dir, "b2"))


@register("risk_histogram", f"""
SELECT risk_flag, bin, bin / 20.0 AS bin_lo, count(*) AS n FROM (
  SELECT risk_flag, CAST(least(floor(risk_score * 20), 19) AS INTEGER) AS bin FROM ({clusters_sql('b1')}) c
  WHERE risk_score IS NOT NULL AND risk_flag IN ('Healthy', 'Watch', 'At-Risk')) h GROUP BY risk_flag, bin""")
def q_risk_histogram(spark, sf_dir):
    """20-bin risk histogram per tier."""
    return SC.risk_histogram(clusters_for(spark, sf_dir, "b1"))


def star_for(spark, sf_dir, name="b1"):
    b = BD.BINDINGS[name][0]
    return RP.export_star(clusters_for(spark, sf_dir, name), features_for(spark, sf_dir, name), S.ts_lit(b.ref))


def star_sql(name="b1"):
    c, f = clusters_sql(name), feats_sql(name)
    dim = (f"SELECT channel_id, risk_flag, cluster_label, model_version FROM ({c}) c")
    fact = (f"SELECT c.channel_id, f.upload_freq_30d, f.upload_freq_90d, f.freq_trend_ratio, f.momentum_ratio, "
            f"f.avg_engagement_rate, f.days_since_last_upload, {O.ts(BD.BINDINGS[name][0].ref)} AS scored_at "
            f"FROM ({c}) c LEFT JOIN ({f}) f ON f.channel_id = c.channel_id")
    return dim, fact


_DIM, _FACT = star_sql("b1")


@register("star_dim", _DIM)
def q_star_dim(spark, sf_dir):
    """K3: channel dimension (one row per channel)."""
    return star_for(spark, sf_dir, "b1")[0]


@register("star_fact", _FACT)
def q_star_fact(spark, sf_dir):
    """K3: metrics fact with the scoring time."""
    return star_for(spark, sf_dir, "b1")[1]


@register("bi_measures", f"""
SELECT n_rows, at_risk_count, CASE WHEN n_rows <> 0 THEN CAST(at_risk_count AS DOUBLE) / CAST(n_rows AS DOUBLE) END AS at_risk_pct,
       avg_upload_freq_30d, dormant_creators
FROM (SELECT count(*) AS n_rows, count_if(d.risk_flag = 'At-Risk') AS at_risk_count,
             avg(f.upload_freq_30d) AS avg_upload_freq_30d, count_if(f.days_since_last_upload > 14) AS dormant_creators
      FROM ({_FACT}) f LEFT JOIN ({_DIM}) d ON d.channel_id = f.channel_id) a""")
def q_bi_measures(spark, sf_dir):
    """At-Risk count and share, mean frequency, dormant creators."""
    dim, fact = star_for(spark, sf_dir, "b1")
    return SC.bi_measures(dim, fact)


@register("bi_momentum_by_label", f"""
SELECT d.cluster_label, avg(f.momentum_ratio) AS avg_momentum
FROM ({_FACT}) f LEFT JOIN ({_DIM}) d ON d.channel_id = f.channel_id GROUP BY d.cluster_label""")
def q_bi_momentum_by_label(spark, sf_dir):
    dim, fact = star_for(spark, sf_dir, "b1")
    return SC.bi_momentum_by_label(dim, fact)


@register("bi_risk_values", f"SELECT DISTINCT risk_flag FROM ({_DIM}) d")
def q_bi_risk_values(spark, sf_dir):
    return SC.bi_risk_values(star_for(spark, sf_dir, "b1")[0])


@register("enum_violations", f"""
SELECT 'risk_flag' AS column_name, count_if(risk_flag IS NULL OR risk_flag NOT IN ('Healthy', 'Watch', 'At-Risk', 'Unscored')) AS n_violations,
       count(*) AS n_rows FROM ({clusters_sql('b2')}) c""")
def q_enum_violations(spark, sf_dir):
    """P25: risk_flag outside the four allowed values."""
    from ..operators import clean as CL
    return CL.enum_violations(clusters_for(spark, sf_dir, "b2"), "risk_flag", R.RISK_FLAGS)

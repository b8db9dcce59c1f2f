"""Risk scoring, tiers, cluster labels and the profiles built on them
(P12, P14, W3, W4, U1, A16-A19, A21, A22)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import rules as R
from .ordering import value_at, value_ranks


def split_scored(df: DataFrame, flag: str = "insufficient_history", null_is_unscored: bool = True):
    """(scored, unscored) by the insufficient-history flag."""
    f = F.coalesce(F.col(flag), F.lit(null_is_unscored))
    return df.where(~f), df.where(f)


def with_risk_score(df: DataFrame, cols: Sequence[str] = R.FEATURE_COLUMNS, out: str = "risk_score") -> DataFrame:
    """P12 as a column."""
    return df.withColumn(out, R.risk_score(cols, present=df.columns))


def tier_thresholds(df: DataFrame, score: str = "risk_score", low_q: float = 0.30, high_q: float = 0.70):
    """W3 / N8 thresholds from exact order statistics of the scores.

    One row (low, high), both NULL when there are no scores: an aggregate over the
    distinct scores and the places they take, so however many rows share a score,
    none of them meet in one task."""
    n = F.col("_n")
    at = [F.greatest(F.floor(n * low_q) - 1, F.lit(0)), F.least(F.ceil(n * high_q), n - 1),
          F.floor((n - 1) / 2), F.floor(n / 2)]
    names = ["_low", "_high", "_m1", "_m2"]
    row = value_ranks(df, score).agg(*[value_at(place).alias(c) for place, c in zip(at, names)])
    med, apart = (F.col("_m1") + F.col("_m2")) / 2.0, F.col("_low") < F.col("_high")
    return row.select(F.when(apart, F.col("_low")).otherwise(med * 0.95).alias("low"),
                      F.when(apart, F.col("_high")).otherwise(med * 1.05).alias("high"))


def assign_tiers(df: DataFrame, score: str = "risk_score", out: str = "risk_flag",
                 low_q: float = 0.30, high_q: float = 0.70) -> DataFrame:
    """Healthy / Watch / At-Risk from the global score distribution. The
    thresholds are a scalar subquery, so nothing runs before the frame is used."""
    th = tier_thresholds(df, score, low_q, high_q)
    cut = th.select(F.struct("low", "high")).scalar()
    tiered = df.withColumn("_cut", cut)
    tier = R.tier(score, F.col("_cut.low"), F.col("_cut.high"))
    return tiered.withColumn(out, F.when(F.col(score).isNotNull(), tier)).drop("_cut")


def label_clusters(df: DataFrame, cluster: str = "cluster_id", risk: str = "risk_score",
                   out: str = "cluster_label") -> DataFrame:
    """Rank clusters by mean risk (desc, then id) and map to labels.
    Every rank from the fifth on has the last template, so four clusters and
    the count decide all labels, however many clusters a model finds."""
    per = df.where(F.col(cluster).isNotNull()).groupBy(cluster).agg(F.avg(risk).alias("_mr"))
    n = per.count()
    top = per.orderBy(F.col("_mr").desc_nulls_last(), F.col(cluster).asc()).limit(4).collect()
    i = F.lit(4)
    for rank, r in enumerate(top):
        i = F.when(F.col(cluster) == F.lit(r[cluster]), F.lit(rank)).otherwise(i)
    return df.drop(out).withColumn(out, F.when(F.col(cluster).isNotNull(), R.label_for_rank(i, F.lit(n))))


def unscored_rows(unscored: DataFrame, model_version: str, scored_at: Column) -> DataFrame:
    """U1 right side: unscored rows get -1 / 'Unscored' / NULL scores."""
    return unscored.select(
        "*",
        F.lit(-1).cast("int").alias("cluster_id"),
        F.lit("Unscored").alias("cluster_label"),
        F.lit("Unscored").alias("risk_flag"),
        F.lit(None).cast("double").alias("risk_score"),
        F.lit(model_version).alias("model_version"),
        scored_at.alias("scored_at"),
        F.lit(None).cast("double").alias("distance_to_centroid"),
        F.lit(None).cast("double").alias("confidence"),
    )


CLUSTER_COLS = ["cluster_id", "cluster_label", "risk_flag", "risk_score", "model_version",
                "scored_at", "distance_to_centroid", "confidence"]


def union_unscored(scored: DataFrame, unscored: DataFrame, model_version: str, scored_at: Column) -> DataFrame:
    """Scored rows + unscored rows in one frame (by column name)."""
    return scored.unionByName(unscored_rows(unscored, model_version, scored_at), allowMissingColumns=True)


def score_with_fixed_clusters(features: DataFrame, cluster_expr: Column, scored_at: Column,
                              model_version: str = "fixed_v1",
                              cols: Sequence[str] = R.FEATURE_COLUMNS) -> DataFrame:
    """Scoring path with a given cluster assignment (deterministic, SQL-checkable):
    P14 -> P12 -> W4 -> W3 -> U1. The modelling path (modeling.score_creators)
    replaces ``cluster_expr`` by a fitted model."""
    scored, unscored = split_scored(features)
    s = with_risk_score(scored, cols).withColumn("cluster_id", cluster_expr.cast("int"))
    s = label_clusters(s)
    s = assign_tiers(s)
    s = s.select("*", F.lit(model_version).alias("model_version"), scored_at.alias("scored_at"),
                 F.lit(None).cast("double").alias("distance_to_centroid"),
                 F.lit(None).cast("double").alias("confidence"))
    return union_unscored(s, unscored, model_version, scored_at)


# ---- profiles over a clusters frame ------------------------------------------

def cluster_profile(scored: DataFrame, cols: Sequence[str] = R.FEATURE_COLUMNS) -> DataFrame:
    """Per cluster mean features (NULL mean -> 0), label, dominant flag
    (most rows, then smallest text; N18), size, mean risk."""
    flags = scored.groupBy("cluster_id", "risk_flag").agg(F.count(F.lit(1)).alias("_c"))
    dom = flags.groupBy("cluster_id").agg(
        F.min_by("risk_flag", F.struct((-F.col("_c")).alias("c"), F.col("risk_flag").alias("f"))).alias("risk_flag"))
    prof = scored.groupBy("cluster_id").agg(
        F.min("cluster_label").alias("cluster_label"),
        F.count(F.lit(1)).alias("size"),
        F.avg("risk_score").alias("mean_risk_score"),
        *[F.coalesce(F.avg(c), F.lit(0.0)).alias(f"mean_{c}") for c in cols])
    return prof.join(dom, "cluster_id", "left")


def radar_profile(scored: DataFrame, cols: Sequence[str] = R.FEATURE_COLUMNS, group: str = "cluster_label") -> DataFrame:
    """Per label mean of each feature, min-max normalised by the global
    min/max (+1e-10); 0.5 when the feature has < 2 values. Dominant flag."""
    g = scored.agg(*[F.min(c).cast("double").alias(f"_mn_{c}") for c in cols],
                   *[F.max(c).cast("double").alias(f"_mx_{c}") for c in cols],
                   *[F.count(c).alias(f"_n_{c}") for c in cols]).first()     # one row of scalars
    means = scored.groupBy(group).agg(*[F.avg(c).alias(f"_m_{c}") for c in cols])
    flags = scored.groupBy(group, "risk_flag").agg(F.count(F.lit(1)).alias("_c"))
    dom = flags.groupBy(group).agg(
        F.min_by("risk_flag", F.struct((-F.col("_c")).alias("c"), F.col("risk_flag").alias("f"))).alias("dominant_flag"))
    j = means.join(dom, group, "left")
    out = [F.col(group), F.col("dominant_flag")]
    for c in cols:
        mn, mx, n = g[f"_mn_{c}"], g[f"_mx_{c}"], g[f"_n_{c}"]
        if n is None or n < 2:
            out.append(F.lit(0.5).alias(f"r_{c}"))
            continue
        norm = (F.col(f"_m_{c}") - F.lit(mn)) / (F.lit(mx) - F.lit(mn) + F.lit(1e-10))
        out.append(norm.alias(f"r_{c}"))
    return j.select(*out)


def value_counts(df: DataFrame, column: str, out: str = "n") -> DataFrame:
    """Rows per value, NULLs dropped."""
    return df.where(F.col(column).isNotNull()).groupBy(column).agg(F.count(F.lit(1)).alias(out))


def kpis(directory: DataFrame) -> DataFrame:
    """One row of totals per tier, shares and scored means over a
    channels-left-join-clusters frame."""
    scored_mask = ~F.coalesce(F.col("insufficient_history"), F.lit(True))

    def n_flag(f):
        return F.count_if(F.col("risk_flag") == f)
    a = directory.agg(
        F.count(F.lit(1)).alias("total"),
        n_flag("Healthy").alias("healthy"), n_flag("Watch").alias("watch"),
        n_flag("At-Risk").alias("at_risk"), n_flag("Unscored").alias("unscored"),
        F.count_if(scored_mask).alias("scored_rows"),
        F.avg(F.when(scored_mask, F.col("momentum_ratio"))).alias("avg_momentum"),
        (F.avg(F.when(scored_mask, F.col("avg_engagement_rate"))) * 100).alias("avg_engagement_pct"))
    pct = lambda c: F.when(F.col("total") > 0, F.col(c) / F.col("total") * 100)
    return a.select("total", "healthy", "watch", "at_risk", "unscored",
                    (F.col("healthy") + F.col("watch") + F.col("at_risk")).alias("scored_count"), "scored_rows",
                    pct("healthy").alias("healthy_pct"), pct("watch").alias("watch_pct"),
                    pct("at_risk").alias("at_risk_pct"), "avg_momentum", "avg_engagement_pct")


def risk_histogram(scored: DataFrame, bins: int = 20) -> DataFrame:
    """Risk-score histogram per tier over [0, 1] in ``bins`` equal bins."""
    s = scored.where(F.col("risk_score").isNotNull() & F.col("risk_flag").isin("Healthy", "Watch", "At-Risk"))
    b = F.least(F.floor(F.col("risk_score") * bins), F.lit(bins - 1)).cast("int")
    return s.groupBy("risk_flag", b.alias("bin")).agg(F.count(F.lit(1)).alias("n")).select(
        "risk_flag", "bin", (F.col("bin") / F.lit(float(bins))).alias("bin_lo"), "n")


def bi_measures(dim: DataFrame, fact: DataFrame) -> DataFrame:
    """At-Risk count and share, average 30-day frequency, dormant
    creators (> 14 days idle), over the fact joined to the dimension."""
    j = fact.join(dim.select("channel_id", "risk_flag", "cluster_label"), "channel_id", "left")
    a = j.agg(F.count(F.lit(1)).alias("n_rows"),
              F.count_if(F.col("risk_flag") == "At-Risk").alias("at_risk_count"),
              F.avg("upload_freq_30d").alias("avg_upload_freq_30d"),
              F.count_if(F.col("days_since_last_upload") > 14).alias("dormant_creators"))
    return a.select("n_rows", "at_risk_count",
                    F.try_divide(F.col("at_risk_count").cast("double"), F.col("n_rows").cast("double")).alias("at_risk_pct"),
                    "avg_upload_freq_30d", "dormant_creators")


def bi_momentum_by_label(dim: DataFrame, fact: DataFrame) -> DataFrame:
    j = fact.join(dim.select("channel_id", "cluster_label"), "channel_id", "left")
    return j.groupBy("cluster_label").agg(F.avg("momentum_ratio").alias("avg_momentum"))


def bi_risk_values(dim: DataFrame) -> DataFrame:
    return dim.select("risk_flag").distinct()

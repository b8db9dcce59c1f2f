"""Profiles of a features table.

Per-feature statistics are computed from one ``unpivot`` (one scan), not one
query per feature; quantiles are exact and distributed (``exact_quantiles``).
Correlations divide by ``nullif(var, 0)`` so constant columns give NULL (N14).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .ordering import exact_quantiles

# ---- fixed values that must equal the reference's for the same results ----
SUMMARY_FEATURES = ["upload_freq_30d", "upload_freq_90d", "momentum_ratio", "avg_engagement_rate",
                    "days_since_last_upload", "upload_regularity", "duration_trend"]
NULL_FEATURES = SUMMARY_FEATURES
ZERO_FEATURES = ["upload_freq_30d", "upload_freq_90d", "days_since_last_upload", "upload_regularity",
                 "duration_trend"]
# The seven fixed correlation pairs of the EDA.
CORR_PAIRS = [
    ("freq_momentum_corr", "upload_freq_30d", "momentum_ratio"),
    ("freq_engagement_corr", "upload_freq_30d", "avg_engagement_rate"),
    ("momentum_engagement_corr", "momentum_ratio", "avg_engagement_rate"),
    ("days_momentum_corr", "days_since_last_upload", "momentum_ratio"),
    ("days_freq_corr", "days_since_last_upload", "upload_freq_30d"),
    ("regularity_freq_corr", "upload_regularity", "upload_freq_30d"),
    ("duration_momentum_corr", "duration_trend", "momentum_ratio"),
]


def long_form(df: DataFrame, cols: Sequence[str], name: str = "feature", value: str = "value") -> DataFrame:
    """Unpivot numeric columns to (feature, value) as doubles, NULLs kept."""
    d = df.select(*[F.col(c).cast("double").alias(c) for c in cols])
    return d.unpivot([], list(cols), name, value)


def eda_counts(features: DataFrame) -> DataFrame:
    """Total, insufficient and scored rows."""
    return features.agg(
        F.count(F.lit(1)).alias("row_count"),
        F.count_if(F.col("insufficient_history") == F.lit(True)).alias("insufficient_count"),
        F.count_if(~F.col("insufficient_history")).alias("scored_count"))


def null_zero_profile(features: DataFrame, kind: str = "null") -> DataFrame:
    """NULL (or zero) counts per feature over scored rows, with % of scored."""
    scored = features.where(~F.col("insufficient_history"))
    cols = NULL_FEATURES if kind == "null" else ZERO_FEATURES
    lf = long_form(scored, cols)
    cond = F.col("value").isNull() if kind == "null" else (F.col("value") == 0)
    g = lf.groupBy("feature").agg(F.count_if(cond).alias("n"), F.count(F.lit(1)).alias("_rows"))
    return g.select("feature", "n", F.try_divide(F.col("n") * 100.0, F.col("_rows").cast("double")).alias("pct"))


def feature_summary(features: DataFrame, cols: Sequence[str] = SUMMARY_FEATURES, digits: int = 4) -> DataFrame:
    """Per feature n, mean, std, min, p25, median, p75, max (rounded)."""
    lf = long_form(features, cols).where(F.col("value").isNotNull())
    basic = lf.groupBy("feature").agg(
        F.count(F.lit(1)).alias("n"), F.avg("value").alias("mean"), F.stddev_samp("value").alias("std"),
        F.min("value").alias("min"), F.max("value").alias("max"))
    q = exact_quantiles(lf, "value", [0.25, 0.5, 0.75], ["feature"])
    qw = q.groupBy("feature").agg(
        F.max(F.when(F.col("p") == 0.25, F.col("q"))).alias("p25"),
        F.max(F.when(F.col("p") == 0.5, F.col("q"))).alias("median"),
        F.max(F.when(F.col("p") == 0.75, F.col("q"))).alias("p75"))
    j = basic.join(qw, "feature", "left")
    r = (lambda c: F.round(F.col(c), digits).alias(c)) if digits is not None else (lambda c: F.col(c))
    return j.select("feature", "n", r("mean"), r("std"), r("min"), r("p25"), r("median"), r("p75"), r("max"))


def correlations(features: DataFrame, digits: int = 4) -> DataFrame:
    """The seven fixed pairs over rows with frequency, momentum and engagement present."""
    f = features.where(F.col("upload_freq_30d").isNotNull() & F.col("momentum_ratio").isNotNull()
                       & F.col("avg_engagement_rate").isNotNull())
    f = f.select(*[F.col(c).cast("double").alias(c) for c in SUMMARY_FEATURES])
    row = f.agg(*[_pair_corr(a, b).alias(name) for name, a, b in CORR_PAIRS])
    if digits is not None:
        row = row.select(*[F.round(F.col(n), digits).alias(n) for n, _, _ in CORR_PAIRS])
    return row


def _pair_corr(a: str, b: str):
    """Pearson over rows where both are non-null: covar_pop / (sd_x * sd_y)."""
    both = F.col(a).isNotNull() & F.col(b).isNotNull()
    x, y = F.when(both, F.col(a)), F.when(both, F.col(b))
    den = F.sqrt(F.var_pop(x)) * F.sqrt(F.var_pop(y))
    return F.try_divide(F.covar_pop(x, y), F.nullif(den, F.lit(0.0)))


def correlation_matrix(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Long-form Pearson matrix (row_feature, col_feature, corr),
    pairwise-complete, NULL for constant columns, from one aggregation."""
    d = df.select(*[F.col(c).cast("double").alias(c) for c in cols])
    pairs = [(a, b) for a in cols for b in cols]
    row = d.agg(*[_pair_corr(a, b).alias(f"{i}") for i, (a, b) in enumerate(pairs)])
    stack = F.explode(F.array(*[
        F.struct(F.lit(a).alias("row_feature"), F.lit(b).alias("col_feature"),
                 F.col(f"{i}").alias("corr")) for i, (a, b) in enumerate(pairs)]))
    return row.select(stack.alias("_s")).select("_s.*")


def feature_histogram(df: DataFrame, cols: Sequence[str], bins: int = 50) -> DataFrame:
    """Equal-width bins between min and max per feature, last bin closed.
    (feature, bin, bin_lo, bin_hi, n) for non-empty bins."""
    lf = long_form(df, cols).where(F.col("value").isNotNull())
    rng = lf.groupBy("feature").agg(F.min("value").alias("_mn"), F.max("value").alias("_mx"))
    # Constant feature: one unit-wide range around the value, as numpy does.
    lo = F.when(F.col("_mx") > F.col("_mn"), F.col("_mn")).otherwise(F.col("_mn") - 0.5)
    hi = F.when(F.col("_mx") > F.col("_mn"), F.col("_mx")).otherwise(F.col("_mx") + 0.5)
    rng = rng.select("feature", lo.alias("_lo"), hi.alias("_hi"))
    j = lf.join(F.broadcast(rng), "feature")  # one row per feature: bounded by len(cols)
    width = (F.col("_hi") - F.col("_lo")) / F.lit(float(bins))
    b = F.least(F.floor((F.col("value") - F.col("_lo")) / width), F.lit(bins - 1)).cast("int")
    g = j.groupBy("feature", b.alias("bin")).agg(F.count(F.lit(1)).alias("n"),
                                                 F.first("_lo").alias("_lo"), F.first("_hi").alias("_hi"))
    w = (F.col("_hi") - F.col("_lo")) / F.lit(float(bins))
    return g.select("feature", "bin", (F.col("_lo") + F.col("bin") * w).alias("bin_lo"),
                    (F.col("_lo") + (F.col("bin") + 1) * w).alias("bin_hi"), "n")


def numeric_columns(df: DataFrame) -> list[str]:
    num = (T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.FloatType, T.DoubleType, T.DecimalType)
    return [f.name for f in df.schema.fields if isinstance(f.dataType, num)]


def feature_means(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    """Mean of every numeric column (booleans excluded), long form."""
    cols = list(cols) if cols is not None else numeric_columns(df)
    row = df.agg(*[F.avg(F.col(c).cast("double")).alias(c) for c in cols])
    return row.unpivot([], cols, "feature", "mean")


def eda_report(features: DataFrame) -> DataFrame:
    """Counts, null/zero profiles, summaries and correlations as one tidy
    (section, name, stat, value) table."""
    counts = eda_counts(features)
    c_long = counts.unpivot([], ["row_count", "insufficient_count", "scored_count"], "name", "value") \
        .select(F.lit("counts").alias("section"), "name", F.lit("n").alias("stat"), F.col("value").cast("double"))
    nulls = null_zero_profile(features, "null").select(
        F.lit("nulls").alias("section"), F.col("feature").alias("name"), F.lit("n").alias("stat"),
        F.col("n").cast("double").alias("value"))
    zeros = null_zero_profile(features, "zero").select(
        F.lit("zeros").alias("section"), F.col("feature").alias("name"), F.lit("n").alias("stat"),
        F.col("n").cast("double").alias("value"))
    summ = feature_summary(features)
    stats = ["n", "mean", "std", "min", "p25", "median", "p75", "max"]
    s_long = summ.select("feature", *[F.col(s).cast("double").alias(s) for s in stats]) \
        .unpivot(["feature"], stats, "stat", "value") \
        .select(F.lit("summary").alias("section"), F.col("feature").alias("name"), "stat", "value")
    corr = correlations(features)
    names = [n for n, _, _ in CORR_PAIRS]
    k_long = corr.unpivot([], names, "name", "value").select(
        F.lit("correlation").alias("section"), "name", F.lit("pearson").alias("stat"), "value")
    return c_long.unionByName(nulls).unionByName(zeros).unionByName(s_long).unionByName(k_long)

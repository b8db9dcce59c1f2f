"""Rule expressions: risk score transforms, tier and label rules, actions,
display formatting. All native ``F.when`` / arithmetic expressions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from .scalar import col

# ---- fixed values that must equal the reference's for the same results ----
# Default scoring columns, in order.
FEATURE_COLUMNS = [
    "upload_freq_30d",
    "upload_freq_90d",
    "freq_trend_ratio",
    "momentum_ratio",
    "avg_engagement_rate",
    "days_since_last_upload",
    "upload_regularity",
]
# Cluster label templates, from highest mean risk to lowest.
LABEL_TEMPLATES = [
    "Low Momentum — Declining Engagement",
    "Mid-Low Momentum — Occasional Uploaders",
    "Mid Momentum — Regular Creators",
    "Mid-High Momentum — Active Creators",
    "High Momentum — Frequent Uploaders",
]
SINGLE_CLUSTER_LABEL = "Single Cluster — All Creators"
# Risk weights; a column not listed weighs 0.1. Weights are normalised to sum 1.
RISK_WEIGHTS = {
    "upload_freq_30d": 0.20,
    "freq_trend_ratio": 0.10,
    "momentum_ratio": 0.30,
    "days_since_last_upload": 0.15,
    "avg_engagement_rate": 0.15,
    "upload_regularity": 0.10,
}
DEFAULT_WEIGHT = 0.1
RISK_FLAGS = ["Healthy", "Watch", "At-Risk", "Unscored"]
# Report actions (at-risk report) and directory actions (dashboard directory).
ACTION_UNSCORED = "Insufficient data — collect more upload history"
ACTION_REACH_OUT_IDLE = "Reach out — momentum declining, no upload in 21+ days"
ACTION_REACH_OUT_DECLINE = "Reach out — momentum sharply declining"
ACTION_MONITOR_DECLINE = "Monitor — declining engagement trend"
ACTION_CHECK_IN_GAP = "Check in — upload gap widening"
ACTION_MONITOR_MID = "Monitor — mid-range metrics"
ACTION_NONE = "No action needed"
DIR_URGENT = "Urgent outreach"
DIR_CHECK_IN = "Check in with creator"
DIR_PRIORITY = "Priority review"
DIR_MONITOR = "Monitor closely"
DIR_AUTO = "Auto-email check-in"
# ---------------------------------------------------------------------------


def normalized_weights(cols: Sequence[str] = FEATURE_COLUMNS) -> dict[str, float]:
    w = {c: RISK_WEIGHTS.get(c, DEFAULT_WEIGHT) for c in cols}
    total = sum(w.values())
    return {c: v / total for c, v in w.items()}


def risk_component(name: str, v: Column) -> Column:
    """Saturating transform of one feature (N9); higher = riskier."""
    if name == "days_since_last_upload":
        return F.try_divide(v, v + F.lit(30.0))
    if name in ("upload_freq_30d", "upload_freq_90d", "momentum_ratio", "freq_trend_ratio"):
        return F.try_divide(F.lit(1.0), F.lit(1.0) + v)
    if name == "avg_engagement_rate":
        return F.try_divide(F.lit(1.0), F.lit(1.0) + v * F.lit(100.0))
    if name == "upload_regularity":
        return F.try_divide(v, v + F.lit(14.0))
    return F.try_divide(v, v + F.lit(1.0))


def risk_score(cols: Sequence[str] = FEATURE_COLUMNS, present: Sequence[str] | None = None) -> Column:
    """Weighted sum of transforms, NULL features as 0, clipped to [0, 1].
    Columns missing from the frame (``present``) keep their weight but add 0."""
    total = F.lit(0.0)
    for c, w in normalized_weights(cols).items():
        if present is not None and c not in present:
            continue
        v = F.coalesce(F.col(c).cast("double"), F.lit(0.0))
        total = total + F.lit(w) * risk_component(c, v)
    return F.least(F.greatest(total, F.lit(0.0)), F.lit(1.0))


def tier(score, low: Column | float, high: Column | float) -> Column:
    """Healthy if <= low (tested first), At-Risk if >= high, else Watch."""
    s = col(score)
    lo = low if isinstance(low, Column) else F.lit(float(low))
    hi = high if isinstance(high, Column) else F.lit(float(high))
    return F.when(s <= lo, "Healthy").when(s >= hi, "At-Risk").otherwise("Watch")


def label_for_rank(rank0, n) -> Column:
    """Cluster label from 0-based rank by mean risk (desc) and count."""
    i, n = col(rank0), col(n)
    t = [F.lit(x) for x in LABEL_TEMPLATES]
    idx4 = F.element_at(F.array(F.lit(0), F.lit(1), F.lit(3), F.lit(4)), (i + 1).cast("int"))
    idx = (F.when(n == 2, F.when(i == 0, 0).otherwise(4))
           .when(n == 3, F.when(i == 0, 0).when(i == n - 1, 4).otherwise(2))
           .when(n == 4, idx4)
           .otherwise(F.least(i, F.lit(4))))
    return F.when(n == 1, F.lit(SINGLE_CLUSTER_LABEL)).otherwise(
        F.element_at(F.array(*t), (idx + 1).cast("int")))


def recommended_action(flag="risk_flag", days="days_since_last_upload", momentum="momentum_ratio") -> Column:
    """P15 / N11."""
    d = F.coalesce(col(days).cast("double"), F.lit(0.0))
    m = F.coalesce(col(momentum).cast("double"), F.lit(1.0))
    f = F.coalesce(col(flag).cast("string"), F.lit(""))
    return (F.when(f == "Unscored", ACTION_UNSCORED)
            .when(f == "At-Risk", F.when(d > 21, ACTION_REACH_OUT_IDLE)
                  .when(m < 0.5, ACTION_REACH_OUT_DECLINE).otherwise(ACTION_MONITOR_DECLINE))
            .when(f == "Watch", F.when(d > 14, ACTION_CHECK_IN_GAP).otherwise(ACTION_MONITOR_MID))
            .otherwise(ACTION_NONE))


def directory_action(days="days_since_last_upload", momentum="momentum_ratio", risk="risk_score") -> Column:
    """``x or default`` replaces 0 and NULL; NULL would be NaN in the
    reference's frame, for which every comparison is false -> last branch."""
    def or_default(c, dflt):
        v = col(c).cast("double")
        return F.when(v.isNull(), F.lit(None).cast("double")).when(v == 0, F.lit(dflt)).otherwise(v)
    d_raw = col(days).cast("double")
    d = F.when(d_raw.isNull(), F.lit(None).cast("double")).otherwise(d_raw)  # 0 -> 0 (default is 0)
    m, r = or_default(momentum, 1.0), or_default(risk, 0.5)
    return (F.when(d >= 30, DIR_URGENT)
            .when(d >= 14, DIR_CHECK_IN)
            .when((m < 0.5) & (r > 0.5), DIR_PRIORITY)
            .when(d >= 7, DIR_MONITOR)
            .otherwise(DIR_AUTO))


def thousands(c) -> Column:
    """1234567 -> '1,234,567', NULL -> 'N/A'."""
    return F.coalesce(F.format_number(col(c).cast("bigint"), 0), F.lit("N/A"))


def fixed(c, digits: int = 2, scale: float = 1.0, suffix: str = "") -> Column:
    """c*scale with ``digits`` decimals (+suffix), NULL -> 'N/A'. Rounded half-up
    on the decimal value to twelve places, so any SQL engine prints the same text."""
    v = F.round((col(c).cast("double") * F.lit(scale)).cast("decimal(38,12)"), digits)
    return F.coalesce(F.concat(v.cast("string"), F.lit(suffix)), F.lit("N/A"))


def int_text(c) -> Column:
    return F.coalesce(col(c).cast("bigint").cast("string"), F.lit("N/A"))


def short_title(c, n: int = 60) -> Column:
    return F.substring(F.coalesce(col(c).cast("string"), F.lit("Unknown")), 1, n)

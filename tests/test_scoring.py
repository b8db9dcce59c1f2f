"""Risk score, tiers (N8), labels (N10), actions."""
import pytest
from pyspark.sql import functions as F

from tidewatch.functions import rules as R
from tidewatch.operators import scoring as SC


def tiers(spark, scores):
    df = spark.createDataFrame([(i, s) for i, s in enumerate(scores)], "id int, risk_score double")
    return [r["risk_flag"] for r in SC.assign_tiers(df).orderBy("id").collect()]


def test_three_tiers_reference_case(spark):
    t = tiers(spark, [.1, .15, .2, .3, .35, .4, .6, .7, .8, .9])
    assert t == ["Healthy"] * 3 + ["Watch"] * 4 + ["At-Risk"] * 3


def test_tier_monotone_ties_and_small(spark):
    t = tiers(spark, [0.5] * 6)                 # all tied: median rule, everything Watch
    assert t == ["Watch"] * 6
    assert tiers(spark, [0.3]) == ["Watch"]      # one row: low >= high -> median band
    df = spark.createDataFrame([], "id int, risk_score double")
    assert SC.assign_tiers(df).count() == 0
    order = {"Healthy": 0, "Watch": 1, "At-Risk": 2}
    scores = [i / 37 for i in range(37)]
    ranks = [order[x] for x in tiers(spark, scores)]
    assert ranks == sorted(ranks)


def test_thresholds_match_sorted_positions(spark):
    scores = [((i * 7919) % 101) / 101 for i in range(101)]
    df = spark.createDataFrame(list(enumerate(scores)), "id int, risk_score double")
    ranked = sorted(scores)
    assert tuple(SC.tier_thresholds(df).first()) == (ranked[29], ranked[71])


@pytest.mark.parametrize("n", [1, 2, 3, 4, 5, 6])
def test_labels_by_rank_of_mean_risk(spark, n):
    """Every number of clusters, ties by id, no cluster without a label."""
    rows = [(c, 1.0 - c / 10) for c in range(n) for _ in range(2)]
    df = spark.createDataFrame(rows, "cluster_id int, risk_score double")
    got = {r["cluster_id"]: r["cluster_label"] for r in SC.label_clusters(df).collect()}
    picks = {1: None, 2: [0, 4], 3: [0, 2, 4], 4: [0, 1, 3, 4]}.get(n, [min(i, 4) for i in range(n)])
    want = [R.SINGLE_CLUSTER_LABEL] if n == 1 else [R.LABEL_TEMPLATES[i] for i in picks]
    assert [got[c] for c in range(n)] == want


def test_risk_score_range_and_weights(spark):
    w = R.normalized_weights()
    assert sum(w.values()) == pytest.approx(1.0) and w["upload_freq_90d"] == pytest.approx(0.1 / 1.1)
    rows = [(None,) * 7, (0.0,) * 7, (5.0,) * 7, (1e9,) * 7]
    df = spark.createDataFrame(rows, ", ".join(f"{c} double" for c in R.FEATURE_COLUMNS))
    vals = [r[0] for r in SC.with_risk_score(df).select("risk_score").collect()]
    assert all(0.0 <= v <= 1.0 for v in vals)
    assert vals[0] == vals[1]                   # NULL features score as 0


@pytest.mark.parametrize("n,expected", [
    (1, [R.SINGLE_CLUSTER_LABEL]),
    (2, [R.LABEL_TEMPLATES[0], R.LABEL_TEMPLATES[4]]),
    (3, [R.LABEL_TEMPLATES[0], R.LABEL_TEMPLATES[2], R.LABEL_TEMPLATES[4]]),
    (4, [R.LABEL_TEMPLATES[i] for i in (0, 1, 3, 4)]),
    (6, R.LABEL_TEMPLATES + [R.LABEL_TEMPLATES[4]]),
])
def test_labels_by_rank(spark, n, expected):
    df = spark.createDataFrame([(c, float(n - c)) for c in range(n)], "cluster_id int, risk_score double")
    got = [r["cluster_label"] for r in SC.label_clusters(df).orderBy(F.col("risk_score").desc()).collect()]
    assert got == expected


def test_actions(spark):
    rows = [("Unscored", None, None, None), ("At-Risk", 30.0, 0.9, 0.8), ("At-Risk", 3.0, 0.2, 0.8),
            ("At-Risk", 3.0, None, 0.8), ("Watch", 20.0, 1.0, 0.5), ("Watch", 2.0, 1.0, 0.5), ("Healthy", 0.0, 0.0, 0.0)]
    df = spark.createDataFrame(rows, "risk_flag string, days_since_last_upload double, momentum_ratio double, "
                                     "risk_score double")
    got = [r[0] for r in df.select(R.recommended_action()).collect()]
    assert got == [R.ACTION_UNSCORED, R.ACTION_REACH_OUT_IDLE, R.ACTION_REACH_OUT_DECLINE, R.ACTION_MONITOR_DECLINE,
                   R.ACTION_CHECK_IN_GAP, R.ACTION_MONITOR_MID, R.ACTION_NONE]
    d = [r[0] for r in df.select(R.directory_action()).collect()]
    # NULL days -> every comparison false -> last branch; momentum 0 -> 1.0, risk 0 -> 0.5
    assert d == [R.DIR_AUTO, R.DIR_URGENT, R.DIR_PRIORITY, R.DIR_AUTO, R.DIR_CHECK_IN, R.DIR_AUTO, R.DIR_AUTO]

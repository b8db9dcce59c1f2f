"""Drift, alerts, freshness and correlation edge cases."""
import pytest
from pyspark.sql import functions as F

from tidewatch.operators import eda as ED
from tidewatch.operators import monitor as MO


def test_feature_drift_rules(spark):
    prev = spark.createDataFrame([(1.0, 0.0, 2.0)], "a double, b double, c double")
    cur = spark.createDataFrame([(4.0, 9.0, 2.1)], "a double, b double, c double")
    rep0, base = MO.feature_drift(prev, None)
    assert not any(r["alarm"] for r in rep0.collect())          # first run: store only
    rep, _ = MO.feature_drift(cur, base)
    r = {x["feature"]: x for x in rep.collect()}
    assert r["a"]["alarm"] is True and r["a"]["change"] == pytest.approx(3.0)
    assert r["b"]["alarm"] is False and r["b"]["change"] is None   # baseline mean 0: no score
    assert r["c"]["alarm"] is False


def test_cluster_drift_new_and_vanished(spark):
    prev = spark.createDataFrame([("x",)] * 10 + [("gone",)] * 5, "cluster_label string")
    cur = spark.createDataFrame([("x",)] * 9 + [("new",)] * 3, "cluster_label string")
    _, base = MO.cluster_drift(prev, None)
    rep = {r["label"]: r for r in MO.cluster_drift(cur, base)[0].collect()}
    assert set(rep) == {"x", "new"}                              # a vanished label raises nothing
    assert rep["new"]["alarm"] is True and rep["new"]["change_pct"] == pytest.approx(100.0)
    assert rep["x"]["alarm"] is False


def test_new_at_risk_and_freshness(spark):
    cur = spark.createDataFrame([("a", "At-Risk", "A", 3, 0.9), ("b", "At-Risk", "B", 1, 0.8),
                                 ("c", "Watch", "C", 1, 0.5)],
                                "channel_id string, risk_flag string, title string, days_since_last_upload int, "
                                "risk_score double")
    prev = spark.createDataFrame([("a", "At-Risk")], "channel_id string, risk_flag string")
    assert [r["channel_id"] for r in MO.new_at_risk(cur, prev).collect()] == ["b"]
    assert sorted(r["channel_id"] for r in MO.new_at_risk(cur, None).collect()) == ["a", "b"]
    f = MO.freshness(cur, prev).first()
    assert (f["n_a"], f["n_b"], f["n_overlap"], f["stale"], f["ok"]) == (3, 1, 1, True, True)
    e = MO.freshness(cur.limit(0), prev).first()
    assert e["ok"] is False


def test_constant_column_correlation_is_null(spark):
    rows = [(float(i), 1.0, 1.0, 0.1 * i, 1.0, 2.0, 3.0) for i in range(10)]
    df = spark.createDataFrame(rows, ", ".join(f"{c} double" for c in ED.SUMMARY_FEATURES))
    r = ED.correlations(df).first()
    assert r["freq_momentum_corr"] is None                      # momentum constant (N14)
    m = {(x["row_feature"], x["col_feature"]): x["corr"] for x in
         ED.correlation_matrix(df, ["upload_freq_30d", "upload_freq_90d"]).collect()}
    assert m[("upload_freq_30d", "upload_freq_30d")] == pytest.approx(1.0)
    assert m[("upload_freq_90d", "upload_freq_30d")] is None
    _ = F

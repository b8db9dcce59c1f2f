"""Report and directory formatting (P17, P18, K2) and ordering (O1, O3)."""
from tidewatch import schemas as SCH
from tidewatch.operators import reports as RP
from tidewatch.session import scratch_path
from tidewatch.sinks import files as SK

DIR = ("channel_id string, title string, subscriber_count long, upload_freq_30d double, momentum_ratio double, "
       "avg_engagement_rate double, days_since_last_upload long, risk_score double, confidence double, "
       "cluster_label string, risk_flag string, insufficient_history boolean")


def test_directory_display_text(spark):
    rows = [("a", "T" * 70, 1234567, 0.3333333, 1.25, 0.0123, 40, 0.8765, 0.754, "L", "At-Risk", False),
            ("b", None, None, None, None, None, None, None, None, None, None, None)]
    d = {r["channel_id"]: r for r in RP.directory_report(spark.createDataFrame(rows, DIR)).collect()}
    a, b = d["a"], d["b"]
    assert a["title"] == "T" * 60 and a["subscribers"] == "1,234,567" and a["frequency"] == "0.33"
    assert a["engagement"] == "1.23%" and a["days_idle"] == "40" and a["risk"] == "0.877" and a["confidence"] == "75%"
    assert a["action"] == "Urgent outreach" and a["risk_value"] == 0.8765
    assert (b["title"], b["subscribers"], b["frequency"], b["days_idle"], b["cluster"], b["tier"]) == \
        ("Unknown", "N/A", "N/A", "N/A", "Unknown", "Unknown")
    assert b["risk_value"] == 0.5 and b["action"] == "Auto-email check-in"


def test_report_order_top_k_and_csv(spark):
    clusters = spark.createDataFrame(
        [("a", "Watch", 0.5, "L", None), ("b", "At-Risk", 0.9, "L", 1.5), ("c", "At-Risk", 0.9, "L", None),
         ("d", "Healthy", 0.1, "L", None), ("e", "Unscored", None, "Unscored", None)],
        "channel_id string, risk_flag string, risk_score double, cluster_label string, distance_to_centroid double")
    feats = spark.createDataFrame([(c, 0.123456, 0.1, 1.0, 0.05, d, 2.0, 3.0) for c, d in
                                   [("a", 20), ("b", 30), ("c", 10), ("d", 1), ("e", None)]],
                                  "channel_id string, upload_freq_30d double, upload_freq_90d double, "
                                  "momentum_ratio double, avg_engagement_rate double, days_since_last_upload long, "
                                  "upload_regularity double, duration_trend double")
    rep = RP.at_risk_report(clusters, feats, None)
    ids = [r["channel_id"] for r in rep.collect()]
    assert ids == ["b", "c", "d", "e", "a"]                   # flag text asc, score desc, days desc
    assert [r["channel_id"] for r in RP.top_at_risk(rep, 2).collect()] == ["b", "c"]
    assert rep.first()["upload_freq_30d"] == 0.1235
    path = scratch_path(spark, "report-csv")
    SK.write_report_csv(rep, path)
    back = {r["channel_id"]: r for r in spark.read.option("header", True).schema(SCH.REPORT_CSV).csv(path).collect()}
    assert back["b"]["distance_to_centroid"] == "1.5000" and back["c"]["distance_to_centroid"] is None
    assert back["e"]["risk_score"] is None and back["b"]["upload_freq_30d"] == "0.1235"

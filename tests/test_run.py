"""A full run twice over the B1 binding: outputs written, second run sees the
first run's baselines and previous report, merges replay-safe."""
import pytest

from conftest import SF_SMALL
from tidewatch.plans import channel_health as CH
from tidewatch.session import scratch_path
from tidewatch.sources import bindings as BD


def test_two_runs(spark):
    b, ch, vi = BD.channels_videos(spark, SF_SMALL, "b1")
    out1, out2, state = scratch_path(spark, "run1"), scratch_path(spark, "run2"), scratch_path(spark, "state")
    r1 = CH.run(spark, ch, vi, b.ref, out1, state, version=1, model_type="kmeans", n_boot=5)
    assert r1.features.count() == ch.count()
    assert not any(r["alarm"] for r in r1.feature_drift.collect())          # first run: store only
    assert {r["risk_flag"] for r in r1.clusters.collect()} <= {"Healthy", "Watch", "At-Risk", "Unscored"}
    r2 = CH.run(spark, ch, vi, b.ref, out2, state, version=2, model_type="kmeans", n_boot=5)
    assert r2.new_at_risk.count() == 0                                      # same data: nobody new
    assert all(r["change"] == pytest.approx(0.0) for r in r2.feature_drift.collect() if r["change"] is not None)
    assert r2.freshness.first()["ok"] is True
    assert r2.report.count() == r1.report.count()

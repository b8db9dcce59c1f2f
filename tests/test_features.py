"""Feature job: the reference's engineering fixture (ref 2024-06-15) and edge cases."""
import datetime as dt

import pytest

from tidewatch.operators import features as FE

REF = dt.datetime(2024, 6, 15)
VSCHEMA = ("video_id string, channel_id string, published_at timestamp, view_count long, like_count long, "
           "comment_count long, comments_disabled boolean, duration_seconds int")


def fixture_frames(spark, extra_videos=()):
    ch = spark.createDataFrame([("UCactive", "A", 1000), ("UCinsufficient", "B", 10), ("UCno_videos", "C", 5)],
                               "channel_id string, title string, subscriber_count long")
    rows = []
    for i, d in enumerate(range(1, 20, 2)):
        rows.append((f"a{i}", "UCactive", REF - dt.timedelta(days=d), 1000 * d, 50, 5, False, 300))
    for i, d in enumerate(range(35, 75, 2)):
        rows.append((f"b{i}", "UCactive", REF - dt.timedelta(days=d), 1000 * d, 50, 5, False, 300))
    rows.append(("c0", "UCinsufficient", REF - dt.timedelta(days=5), 1000, 10, 1, False, 60))
    rows += list(extra_videos)
    return ch, spark.createDataFrame(rows, VSCHEMA)


def feats(spark, **kw):
    ch, vi = fixture_frames(spark)
    return {r["channel_id"]: r for r in FE.compute_features(ch, vi, REF, **kw).collect()}


def test_reference_fixture(spark):
    f = feats(spark)
    a = f["UCactive"]
    assert a["upload_freq_30d"] == pytest.approx(10 / 30)
    assert a["upload_freq_90d"] == pytest.approx(30 / 90)
    assert a["days_since_last_upload"] == 1
    assert 0.8 < a["momentum_ratio"] < 1.2
    assert 0 < a["avg_engagement_rate"] <= 1
    assert a["insufficient_history"] is False
    b = f["UCinsufficient"]
    assert b["insufficient_history"] is True and b["momentum_ratio"] is None
    c = f["UCno_videos"]
    assert c["insufficient_history"] is True and c["upload_freq_30d"] is None and c["days_since_last_upload"] is None


def test_blocks_do_not_change_features(spark):
    """A hot key split over many range blocks gives the same features as one block."""
    ch, vi = fixture_frames(spark)
    one = sorted(FE.compute_features(ch, vi, REF, blocks=1).collect())
    for a, b in zip(one, sorted(FE.compute_features(ch, vi, REF, blocks=9).collect()), strict=True):
        assert list(a) == [pytest.approx(x, rel=1e-12) if isinstance(x, float) else x for x in b]


def test_null_time_equal_times_and_fallback(spark):
    # 4 videos all older than 90 days -> windows empty -> insufficient, metrics NULL
    old = [(f"o{i}", "UCold", REF - dt.timedelta(days=200 + i), 100, 1, 1, False, 60) for i in range(4)]
    # equal publish times + a NULL time; all recent -> half-split fallback
    same = [(f"s{i}", "UCsame", REF - dt.timedelta(days=3), 100 * (i + 1), 1, 1, False, 60) for i in range(4)]
    same.append(("s9", "UCsame", None, 100, 1, 1, False, 60))
    ch = spark.createDataFrame([("UCold",), ("UCsame",)], "channel_id string")
    vi = spark.createDataFrame(old + same, VSCHEMA)
    f = {r["channel_id"]: r for r in FE.compute_features(ch, vi, REF).collect()}
    assert f["UCold"]["insufficient_history"] is True and f["UCold"]["upload_regularity"] is None
    s = f["UCsame"]
    # older half = first 2 of 5 by (time, id) = s0, s1 (vpd 100/3, 200/3); recent = s2, s3 (NULL time last)
    assert s["momentum_ratio"] == pytest.approx(((300 + 400) / 3 / 2) / ((100 + 200) / 3 / 2))
    assert s["upload_regularity"] == pytest.approx(0.0)
    assert s["days_since_last_upload"] == 3


def test_future_upload_and_empty_inputs(spark):
    fut = [("f1", "UCf", REF + dt.timedelta(days=2), 50, 1, 1, False, 60),
           ("f2", "UCf", REF - dt.timedelta(days=1), 50, 1, 1, False, 60)]
    ch = spark.createDataFrame([("UCf",)], "channel_id string")
    vi = spark.createDataFrame(fut, VSCHEMA)
    r = FE.compute_features(ch, vi, REF).first()
    assert r["days_since_last_upload"] == 0 and r["upload_freq_30d"] == pytest.approx(2 / 30)
    empty = spark.createDataFrame([], VSCHEMA)
    assert FE.compute_features(ch, empty, REF).count() == 0
    assert FE.compute_features(ch.limit(0), vi, REF).count() == 0


def test_short_long_windows_7_21(spark):
    ch, vi = fixture_frames(spark)
    f = {r["channel_id"]: r for r in FE.compute_features(ch, vi, REF, short=7, long=21).collect()}
    assert f["UCactive"]["upload_freq_30d"] == pytest.approx(4 / 7)   # days 1,3,5,7
    assert f["UCactive"]["upload_freq_90d"] == pytest.approx(10 / 21)

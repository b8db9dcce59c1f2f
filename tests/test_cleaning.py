"""Cleaning: casts, outlier caps, dedup (reference cleaning tests)."""
import numpy as np
import pytest

from tidewatch.functions import scalar as S
from tidewatch.operators import clean as CL
from tidewatch.operators import ordering as OR


def test_cast_numeric_and_audit(spark):
    df = spark.createDataFrame([("100",), ("200",), ("bad",), ("300",)], "v string")
    vals = [r[0] for r in df.select(S.cast_numeric("v")).collect()]
    assert vals.count(None) == 1
    a = CL.cast_numeric_audit(df, ["v"]).first()
    assert (a["n_input"], a["n_coerced"], a["all_coerced"]) == (4, 1, False)


def test_cap_outliers_interpolated(spark):
    df = spark.createDataFrame([(float(i),) for i in range(1, 101)], "v double")
    out = CL.cap_outliers(df, "v", 0.95)
    assert max(r["v"] for r in out.collect()) == pytest.approx(np.quantile(np.arange(1, 101), 0.95))


def test_cap_outliers_exponential(spark):
    rng = np.random.default_rng(42)
    x = list(rng.exponential(100, 1000) * 1000) + [1e6, 2e6]
    df = spark.createDataFrame([(float(v),) for v in x], "v double")
    assert max(r["v"] for r in CL.cap_outliers(df, "v", 0.99).collect()) < 500_000


def test_dedup_first_and_count(spark):
    df = spark.createDataFrame([("a", 1), ("b", 2), ("a", 3), ("c", 4), ("b", 5)], "video_id string, ord int")
    out, stats = CL.dedup_with_count(df, ["video_id"], ["ord"])
    assert sorted(tuple(r) for r in out.collect()) == [("a", 1), ("b", 2), ("c", 4)]
    assert tuple(stats.first()) == (5, 3, 2)
    last = OR.dedup_first(df, ["video_id"], ["ord"], keep="last")
    assert sorted(tuple(r) for r in last.collect()) == [("a", 3), ("b", 5), ("c", 4)]


def test_exact_quantiles(spark):
    rng = np.random.default_rng(1)
    rows = [(g, float(v)) for g in ("x", "y") for v in rng.normal(size=57)]
    df = spark.createDataFrame(rows, "g string, v double")
    a = sorted(tuple(r) for r in OR.exact_quantiles(df, "v", [0.25, 0.5, 0.99], ["g"]).collect())
    b = sorted(tuple(r) for r in OR.exact_quantiles(df, "v", [0.25, 0.5, 0.99], ["g"], blocks=30).collect())
    for (g1, p1, q1), (g2, p2, q2) in zip(a, b):
        assert (g1, p1) == (g2, p2) and q1 == pytest.approx(q2, abs=1e-12)
    for g, p, q in a:
        ref = np.quantile([v for gg, v in rows if gg == g], p)
        assert q == pytest.approx(ref, abs=1e-12)


def test_key_violations(spark):
    df = spark.createDataFrame([("a", 1), ("a", 2), (None, 3), ("z", 4)], "channel_id string, x int")
    parent = spark.createDataFrame([("a",)], "channel_id string")
    r = {(x["check_name"], x["columns"]): x["n"] for x in
         CL.key_violations(df, "videos", ["channel_id"], fk=("channel_id", parent, "channel_id")).collect()}
    assert r[("primary_key", "channel_id")] == 1 and r[("not_null", "channel_id")] == 1
    assert r[("foreign_key", "channel_id")] == 1

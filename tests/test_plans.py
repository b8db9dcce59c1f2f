"""Physical plans: filters and columns reach the scan, no cartesian product, no
key gathered whole for a window."""
import re

from conftest import SF_SMALL
from pyspark.sql import functions as F


def plan_text(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString() + df._jdf.queryExecution().optimizedPlan().toString()


def test_scan_pushdown_and_no_cartesian(spark):
    import datetime as dt

    from tidewatch.operators import features as FE
    from tidewatch.sources import bindings as BD
    _, ch, vi = BD.channels_videos(spark, SF_SMALL, "b1")
    p = plan_text(vi)
    assert "l_comment" not in p and "LessThan(l_shipdate" not in p         # all rows, needed columns
    assert "LessThan(l_shipdate" in plan_text(BD.b1_videos(spark, SF_SMALL, dt.datetime(1999, 1, 1)))
    assert "CartesianProduct" not in plan_text(FE.compute_features(ch, vi, BD.B1.ref))


def test_window_never_gathers_a_key(spark):
    """Rows are windowed by (key, block); per key only the blocks' totals meet, and
    a hot key's rows lie in many blocks."""
    from tidewatch.operators import ordering as OR
    df = spark.range(4000).selectExpr("id", "if(id % 3 = 0, id, 7) AS k")
    ranked = OR.rank_in_groups(df, ["k"], ["id"], carry=["id"], blocks=16)
    p = ranked._jdf.queryExecution().executedPlan().toString()
    for at in re.finditer(r"Exchange hashpartitioning\(k#\d+L, \d+\)", p):
        assert "partial_count" in p[at.end():at.end() + 900]               # below it: one row per key and block
    got = {r["id"]: (r["_rank"], r["_gsize"], r["_prev_id"]) for r in ranked.where("k = 7").collect()}
    hot = sorted(got)
    assert len(hot) > 2600 and all(got[x] == (i + 1, len(hot), hot[i - 1] if i else None) for i, x in enumerate(hot))


def test_dedup_limits_copies_before_the_shuffle(spark):
    from tidewatch.sources import bindings as BD
    df = BD.b1_videos(spark, SF_SMALL)
    p = df._jdf.queryExecution().executedPlan().toString()
    assert "partial_min" in p and "Window" not in p and p.count("Exchange") == 1

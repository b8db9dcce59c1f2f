"""Order statistics, ranks and first rows: against NumPy and plain Python, with
hot keys, frequent values, nulls and empty frames; plans without jobs or checkpoints."""
import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidewatch.operators import clean as CL
from tidewatch.operators import eda as ED
from tidewatch.operators import ordering as OR
from tidewatch.operators import scoring as SC


def jobs_of(spark, build):
    """(result of ``build``, jobs that it ran)."""
    sc = spark.sparkContext
    group = f"build-{random.random()}"
    sc.setJobGroup(group, group)
    try:
        out = build()
        sc._jsc.sc().listenerBus().waitUntilEmpty(10_000)
        return out, list(sc.statusTracker().getJobIdsForGroup(group))
    finally:
        sc.setLocalProperty("spark.jobGroup.id", None)


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def frequent(spark):
    """80 % zeros, the rest spread out; a hot group of two thirds."""
    rng = np.random.default_rng(7)
    zero = rng.random(60_000) < 0.8
    v = np.where(zero, 0.0, rng.normal(5, 3, 60_000))
    g = np.where(rng.random(60_000) < 0.67, "hot", "cold")
    df = spark.createDataFrame([(a, float(b)) for a, b in zip(g.tolist(), v.tolist())], "g string, v double")
    return g, v, df.repartition(6).persist()


def test_frequent_value_is_one_row_per_task(spark, frequent):
    _, v, df = frequent
    ranks = OR.value_ranks(df, "v", blocks=8)
    p = plan(ranks)
    assert "partial_count" in p and "Window" in p and "rangepartitioning" not in p
    rows = ranks.groupBy(F.spark_partition_id().alias("part")).agg(F.count(F.lit(1)).alias("n")).collect()
    sizes = [r.n for r in rows]
    assert sum(sizes) == len(np.unique(v)) and len(sizes) == 8
    assert max(sizes) <= 2 * sum(sizes) / len(sizes)
    zero = ranks.where("_v = 0").first()
    assert (zero._from, zero._to, zero._n) == (int((v < 0).sum()), int((v <= 0).sum()), len(v))


@pytest.mark.parametrize("blocks", [1, 3, 8])
def test_quantiles_by_group(frequent, blocks):
    g, v, df = frequent
    ps = [0.0, 0.1, 0.25, 0.5, 0.9, 0.99, 1.0]
    got = {(r.g, r.p): r.q for r in OR.exact_quantiles(df, "v", ps, ["g"], blocks=blocks).collect()}
    assert len(got) == 2 * len(ps)
    for (name, p), q in got.items():
        assert q == pytest.approx(np.quantile(v[g == name], p), abs=1e-12)
    whole = {r.p: r.q for r in OR.exact_quantiles(df, "v", ps, blocks=blocks).collect()}
    assert all(whole[p] == pytest.approx(np.quantile(v, p), abs=1e-12) for p in ps)


def test_places_and_empty_frames(spark, frequent):
    _, v, df = frequent
    s = np.sort(v)
    ks = [0, 5, 30_000, len(v) - 1, len(v) + 7]
    assert OR.kth_values(df, "v", ks) == {k: s[k] for k in ks[:-1]}
    none = spark.createDataFrame([(None, "a")], "v double, g string")
    assert OR.kth_values(none, "v", [0]) == {} and OR.exact_quantiles(none, "v", [0.5]).collect() == []
    assert OR.exact_quantiles(none, "v", [0.5], ["g"]).collect() == []
    assert [r.risk_flag for r in SC.assign_tiers(none.withColumnRenamed("v", "risk_score")).collect()] == [None]
    assert [r.v_capped for r in CL.cap_outliers(none.select("v"), "v").collect()] == [False]


def test_thresholds_of_frequent_scores(frequent):
    """Most scores alike: the thresholds collapse to 0.95 and 1.05 times the median."""
    _, v, df = frequent
    low, high = SC.tier_thresholds(df.select((F.col("v") + 10).alias("risk_score"))).first()
    n, s = len(v), np.sort(v + 10)
    lo, hi = s[int(n * 0.3) - 1], s[int(np.ceil(n * 0.7))]
    assert (low, high) == ((lo, hi) if lo < hi else (pytest.approx(np.median(s) * 0.95), pytest.approx(np.median(s) * 1.05)))


def test_ranks_with_one_exchange_and_no_jobs(spark):
    rnd = random.Random(2)
    rows = [(rnd.choice(["hot"] * 6 + ["a", "b", None]), rnd.randrange(100) if rnd.random() < 0.9 else None, i) for i in range(5000)]
    df = spark.createDataFrame(rows, "k string, t int, i int").repartition(5)
    ranked, jobs = jobs_of(spark, lambda: OR.rank_in_groups(df, ["k"], ["t", "i"], nulls_last=True, carry=["t", "i"], blocks=7))
    assert jobs == []
    p = plan(ranked)
    assert len(re.findall(r"hashpartitioning\(k#\d+, _blk#\d+, 7\), REPARTITION_BY_NUM", p)) == 1 and "rangepartitioning" not in p
    groups = {}
    for r in rows:
        groups.setdefault(r[0], []).append(r)
    want = {}
    for g in groups.values():
        g.sort(key=lambda r: (r[1] is None, r[1] or 0, r[2]))
        for j, r in enumerate(g):
            want[r[2]] = (j + 1, len(g), g[j - 1][1] if j else None, g[j - 1][2] if j else None)
    got = ranked.collect()
    assert {r.i: (r._rank, r._gsize, r._prev_t, r._prev_i) for r in got} == want and len(got) == len(rows)
    spread = ranked.where("k = 'hot'").groupBy(F.spark_partition_id()).count().collect()
    assert len(spread) >= 4


def test_global_index(spark):
    rows = [(None if i % 10 == 0 else (i * 37) % 400, i) for i in range(1000)]
    df = spark.createDataFrame(rows, "v int, i int").repartition(4)
    idx, jobs = jobs_of(spark, lambda: OR.global_index(df, ["v", "i"], blocks=5, nulls_last=True))
    assert jobs == []
    want = sorted(rows, key=lambda r: (r[0] is None, r[0] or 0, r[1]))
    assert [(r.v, r.i) for r in sorted(idx.collect(), key=lambda r: r._gidx)] == want
    assert sorted(r._gidx for r in idx.collect()) == list(range(1000))
    assert OR.global_index(df.where("false"), ["v", "i"]).collect() == []


def test_first_rows(spark):
    rnd = random.Random(9)
    rows = [(rnd.choice(["x", "y", None, "z"]), rnd.choice([None, 1, 2]), rnd.choice([None, "p", "q"]), rnd.choice([None, 0.5])) for _ in range(400)]
    df = spark.createDataFrame(rows, "k string, o int, a string, b double").repartition(3)

    for keep, pick in (("first", min), ("last", max)):
        want = {k: pick((r for r in rows if r[0] == k), key=lambda r: [(x is not None, x if x is not None else 0 if c != 2 else "") for c, x in enumerate(r) if c]) for k in ("x", "y", None, "z")}
        got = OR.dedup_first(df, ["k"], ["o"], keep)
        assert "partial_m" in plan(got) and "Window" not in plan(got)
        assert {r.k: tuple(r) for r in got.collect()} == want and got.columns == df.columns


def test_summaries_run_nothing_until_used(spark, frequent):
    _, v, df = frequent
    wide = df.select(*[F.col("v").alias(c) for c in ED.SUMMARY_FEATURES])
    out, jobs = jobs_of(spark, lambda: ED.feature_summary(wide))
    assert jobs == []
    assert {r["median"] for r in out.collect()} == {round(float(np.median(v)), 4)}
    _, jobs = jobs_of(spark, lambda: SC.assign_tiers(df.withColumnRenamed("v", "risk_score")))
    assert jobs == []

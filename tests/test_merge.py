"""Keyed merges: idempotence, repeated keys, partial columns, versions."""
import pytest

from tidewatch.operators import merge as MG
from tidewatch.session import scratch_path

T = "channel_id string, title string, n long"


def test_upsert_insert_update_and_idempotent(spark):
    t = spark.createDataFrame([("a", "A", 1), ("b", "B", 2)], T)
    u = spark.createDataFrame([("b", "B2", 20, 1), ("c", "C", 3, 1), ("c", "C2", 30, 2)], T + ", seq int")
    once = MG.upsert(t, u, ["channel_id"], seq_col="seq")
    twice = MG.upsert(once, u, ["channel_id"], seq_col="seq")
    exp = [("a", "A", 1), ("b", "B2", 20), ("c", "C2", 30)]
    assert sorted(tuple(r) for r in once.collect()) == exp
    assert sorted(tuple(r) for r in twice.collect()) == exp


def test_partial_update_keeps_insert_only(spark):
    t = spark.createDataFrame([("v1", "ch1", 10)], "video_id string, channel_id string, views long")
    u = spark.createDataFrame([("v1", "chX", 99), ("v2", "ch2", 5)], "video_id string, channel_id string, views long")
    r = sorted(tuple(x) for x in MG.upsert(t, u, ["video_id"], update_cols=["views"]).collect())
    assert r == [("v1", "ch1", 99), ("v2", "ch2", 5)]


def test_missing_column_aligned_and_composite_keys(spark):
    t = spark.createDataFrame([("a", "2024-01-01", 1, 7.0)], "c string, d string, n long, extra double")
    u = spark.createDataFrame([("a", "2024-01-01", 5), ("a", "2024-01-02", 6)], "c string, d string, n long")
    r = sorted(tuple(x) for x in MG.upsert(t, u, ["c", "d"]).collect())
    assert r == [("a", "2024-01-01", 5, None), ("a", "2024-01-02", 6, None)]


def test_merge_again_changes_nothing(spark):
    base = scratch_path(spark, "merge-test")
    u1 = spark.createDataFrame([("a", "A", 1)], T)
    u2 = spark.createDataFrame([("a", "A2", 2), ("b", "B", 3)], T)
    assert MG.read_current(spark, base) is None
    MG.merge_into(spark, base, u1, ["channel_id"])
    MG.merge_into(spark, base, u2, ["channel_id"])
    again = MG.merge_into(spark, base, u2, ["channel_id"])   # a replay
    assert sorted(tuple(r) for r in again.collect()) == [("a", "A2", 2), ("b", "B", 3)]
    none = MG.merge_into(spark, base, u2.where("false"), ["channel_id"])
    assert sorted(tuple(r) for r in none.collect()) == [("a", "A2", 2), ("b", "B", 3)]
    rec = {r["table_name"]: r for r in MG.reconcile({"x": again}, {"x": 2, "y": 0}).collect()}
    assert rec["x"]["match"] is True and rec["y"]["match"] is False and rec["y"]["actual"] is None
    empty = MG.merge_into(spark, scratch_path(spark, "merge-none"), u1.where("false"), ["channel_id"])
    assert empty.columns == u1.columns and empty.count() == 0


def files(spark, base):
    return {r[0] for r in spark.read.parquet(base).select("_metadata.file_path").distinct().collect()}


def test_merge_rewrites_only_touched_buckets(spark):
    """One key's merge leaves the other buckets' files as they are; older batches can come again."""
    base = scratch_path(spark, "merge-buckets")
    first = spark.createDataFrame([(f"c{i}", f"t{i}", i) for i in range(200)], T)
    MG.merge_into(spark, base, first, ["channel_id"], buckets=8)
    before = files(spark, base)
    assert len(before) == 8
    for n in range(2, 6):
        MG.merge_into(spark, base, spark.createDataFrame([("c5", "new", n)], T), ["channel_id"], buckets=8)
    assert len(files(spark, base) & before) == 7 and len(files(spark, base)) == 8
    rows = {r["channel_id"]: tuple(r) for r in MG.read_current(spark, base).collect()}
    assert len(rows) == 200 and rows["c5"] == ("c5", "new", 5) and rows["c7"] == ("c7", "t7", 7)
    MG.merge_into(spark, base, first, ["channel_id"], buckets=8)      # the first batch once more
    assert MG.read_current(spark, base).count() == 200


def test_stage_left_by_a_crash_is_put_in_place(spark, monkeypatch):
    base = scratch_path(spark, "merge-crash")
    one, two, other = (spark.createDataFrame([r], T) for r in (("a", "x", 1), ("a", "y", 2), ("zz", "z", 3)))
    MG.merge_into(spark, base, one, ["channel_id"])
    kept = MG._overwrite
    monkeypatch.setattr(MG, "_overwrite", lambda *a: 1 / 0)
    with pytest.raises(ZeroDivisionError):
        MG.merge_into(spark, base, two, ["channel_id"])
    monkeypatch.setattr(MG, "_overwrite", kept)
    assert [tuple(r) for r in MG.read_current(spark, base).collect()] == [("a", "x", 1)]
    MG.merge_into(spark, base, other, ["channel_id"])
    assert sorted(tuple(r) for r in MG.read_current(spark, base).collect()) == [("a", "y", 2), ("zz", "z", 3)]

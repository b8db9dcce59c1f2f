"""Landing JSON, seeds, batching, budget (reference load / extraction tests)."""
import json

import pytest
from pyspark.sql import functions as F

from tidewatch import schemas as SCH
from tidewatch.operators import ordering as OR
from tidewatch.operators import reports as RP
from tidewatch.session import scratch_path
from tidewatch.sources import landing as LD

CHANNELS = [
    {"id": "UC" + "a" * 22, "snippet": {"title": "One", "description": None, "publishedAt": "2020-01-01T00:00:00Z",
                                        "country": None},
     "statistics": {"viewCount": "500000", "subscriberCount": None, "hiddenSubscriberCount": True, "videoCount": "12"},
     "contentDetails": {"relatedPlaylists": {"uploads": "UU" + "a" * 22, "likes": ""}}},
    {"id": "UC" + "b" * 22, "snippet": {"title": "Two", "publishedAt": "2021-05-05T10:00:00Z"},
     "statistics": {"viewCount": "100", "subscriberCount": "7", "hiddenSubscriberCount": False, "videoCount": "3"}},
]
VIDEOS = [
    {"id": "v1", "snippet": {"channelId": "UC" + "a" * 22, "publishedAt": "2024-06-01T00:00:00Z"},
     "statistics": {"viewCount": "10", "likeCount": "2"}, "contentDetails": {"duration": "PT10M30S"}},
    {"id": "v2", "snippet": {"channelId": "UC" + "a" * 22, "publishedAt": "2024-06-02T00:00:00Z"},
     "statistics": {"viewCount": "10", "likeCount": "2", "commentCount": "4"}, "contentDetails": {"duration": "PT1M"}},
]


def _write(spark, root, name, text):
    spark.createDataFrame([(text,)], "value string").coalesce(1).write.mode("overwrite").text(f"{root}/{name}")


def test_channel_json_two_items(spark):
    root = scratch_path(spark, "json-ch")
    _write(spark, root, "f1", json.dumps(CHANNELS))                     # one array per file
    _write(spark, root, "broken", '[{"id": "UCx", ')
    _write(spark, root, "empty", "[]")
    raw = LD.read_landing(spark, root, SCH.CHANNEL_ITEM, multi_line=True)
    good, bad = LD.split_corrupt(raw)
    dim, snap = LD.channel_dim_and_snapshots(good, "2024-06-15")
    assert dim.count() == 2 and snap.count() == 2 and bad.count() == 1
    s = {r["channel_id"]: r for r in snap.collect()}
    assert s["UC" + "a" * 22]["subscriber_count"] is None and s["UC" + "a" * 22]["subscriber_hidden"] is True
    d = {r["channel_id"]: r for r in dim.collect()}
    assert d["UC" + "b" * 22]["uploads_playlist_id"] is None and d["UC" + "a" * 22]["description"] is None


def test_video_json_missing_comment_count(spark):
    root = scratch_path(spark, "json-v")
    _write(spark, root, "f1", json.dumps(VIDEOS))
    v = {r["video_id"]: r for r in LD.read_videos_json(spark, root, multi_line=True).collect()}
    assert v["v1"]["duration_seconds"] == 630
    assert v["v1"]["comments_disabled"] is True and v["v1"]["comment_count"] is None
    assert v["v2"]["comments_disabled"] is False and v["v2"]["comment_count"] == 4


def test_batches_120_ids(spark):
    ids = spark.createDataFrame([(f"id{i:03d}",) for i in range(120)], "channel_id string")
    b = OR.batch_ids(ids, "channel_id", ["channel_id"], 50).orderBy("batch").collect()
    assert [r["n"] for r in b] == [50, 50, 20]
    assert b[0]["ids"][0] == "id000" and b[2]["ids"][-1] == "id119"


def test_budget_plan(spark):
    rows = [(i, 200 if i < 1000 else 0) for i in range(5000)]
    ch = spark.createDataFrame(rows, "channel_id int, video_count long")
    r = RP.extraction_budget(ch).first()
    assert (r["channel_calls"], r["total_units"], r["days_needed"]) == (100, 8100, 1)


def test_seed_first_n_in_file_order(spark):
    path = scratch_path(spark, "seed-test")
    ids = ["UC" + ch * 22 for ch in "zyxwvu"] + ["UC" + "z" * 22, "bad"]
    spark.createDataFrame([(i, f"n{k}", "x", k) for k, i in enumerate(ids)], "channel_id string, name string, niche string, k int") \
        .orderBy("k").drop("k").coalesce(1).write.option("header", True).csv(path)
    first3 = [r["channel_id"] for r in LD.read_seed_csv(spark, path, n=3).orderBy("_ordinal").collect()]
    assert first3 == ids[:3]
    from tidewatch.operators import clean as CL
    seeds = CL.build_seed(LD.read_seed_csv(spark, path), ordinal="_ordinal").orderBy("_ordinal").collect()
    assert [r["channel_id"] for r in seeds] == ids[:6] and seeds[0]["name"] == "n0"


def test_landing_is_parsed_once(spark):
    """The frames of a landing folder read its parsed items, not its text."""
    root = scratch_path(spark, "json-once")
    _write(spark, root, "f1", json.dumps(VIDEOS))
    _write(spark, root, "f2", json.dumps(VIDEOS) + "\n[{")       # a line of its own, so the whole file goes
    good, bad = LD.split_corrupt(LD.read_landing(spark, root, SCH.VIDEO_ITEM))
    assert sorted(r["id"] for r in good.select("id").collect()) == ["v1", "v2"] and bad.count() == 1
    plan = good._jdf.queryExecution().executedPlan().toString()
    assert "from_json" not in plan and "FileScan text" not in plan and plan.count("FileScan parquet") == 2


def test_missing_landing_folder_is_empty(spark):
    assert LD.read_videos_json(spark, scratch_path(spark, "none")).collect() == []
    assert LD.read_channels_json(spark, scratch_path(spark, "none"), multi_line=True).collect() == []


def test_manifest_header(spark):
    root = scratch_path(spark, "manifest")
    _write(spark, root, "f", "a,b,c")
    with pytest.raises(ValueError):
        LD.read_manifest(spark, root)


def test_stream_keeps_items_without_id_and_second_checkpoints(spark):
    """An item without id is kept as in batch, an empty page has no row, and a
    second checkpoint neither overwrites nor skips rows of the first."""
    from tidewatch.operators import merge as MG
    from tidewatch.streaming import ingest as ST
    root = scratch_path(spark, "stream-io")
    _write(spark, f"{root}/a", "f1", '[{"id": "v1", "statistics": {"viewCount": "1"}}, {"statistics": {"viewCount": "2"}}]')
    _write(spark, f"{root}/a", "f2", "[]")
    _write(spark, f"{root}/b", "f1", '[{"id": "v1", "statistics": {"viewCount": "3"}}, {"id": "v1", "statistics": {"viewCount": "4"}}]')
    for s in ("a", "b"):
        for _ in range(2):                                                   # the second run finds nothing new
            ST.ingest_landing_stream(spark, f"{root}/{s}", SCH.VIDEO_ITEM, LD.flatten_videos, f"{root}/out", f"{root}/cp-{s}").awaitTermination()
            ST.stream_upsert(spark, f"{root}/{s}", SCH.VIDEO_ITEM, LD.flatten_videos, f"{root}/table", f"{root}/up-{s}", ["video_id"]).awaitTermination()
    assert sorted((r["video_id"], r["view_count"]) for r in spark.read.parquet(f"{root}/out").collect()) == [("", 2), ("v1", 1), ("v1", 3), ("v1", 4)]
    assert sorted((r["video_id"], r["view_count"]) for r in MG.read_current(spark, f"{root}/table").collect()) == [("", 2), ("v1", 4)]


def test_landing_pages_are_parsed_and_shuffled_once(spark, tmp_path):
    """A page is parsed by one expression, and landing it takes one exchange, of the tables' columns."""
    from tidewatch.sources import landing_fixture as LF
    pages = spark.createDataFrame([("[]", "f", 0), ('[{"id": "a"}, {"id": "b"}]', "f", 0), ("not json [", "g", 0), (" ", "h", 0)], "value string, _source_file string, _block long")
    items = LD.parse_pages(pages, SCH.VIDEO_ITEM)
    assert items._jdf.queryExecution().optimizedPlan().toString().count("from_json") == 1
    assert sorted((r["id"], r[SCH.CORRUPT_COL]) for r in items.collect() if r["id"]) == [("a", None), ("b", None)] and items.count() == 3
    rows = spark.createDataFrame([(1, 2, "x"), (1, 1, "y"), (0, 5, None), (None, 1, "z")], "page long, o int, t string")
    LF.write_pages(LF.Items(rows, ["o"], lambda r: LF.F.struct(r["t"].alias("t"), r["o"].alias("o"))), f"{tmp_path}/pages")
    assert sorted(r[0] for r in spark.read.text(f"{tmp_path}/pages").collect()) == ['[{"o":5}]', '[{"t":"y","o":1},{"t":"x","o":2}]', '[{"t":"z","o":1}]']
    assert list(tmp_path.glob("pages/*.gz")) and not list(tmp_path.glob("pages/*.txt"))


def test_merge_rows_hold_a_file_number_and_keep_path_order(spark, monkeypatch):
    """Of a key in several files the last file in path order wins, as text; the rows that a
    merge sorts have the file's number, and a broken file's number leaves the others' order."""
    from tidewatch.operators import merge as MG
    from tidewatch.streaming import ingest as ST
    root, kinds, whole = scratch_path(spark, "stream-order"), [], MG.merge_into
    for name, views in (("p10", 1), ("p9", 2), ("p1", 3)):
        _write(spark, f"{root}/in", name, f'[{{"id": "v", "statistics": {{"viewCount": "{views}"}}}}, {{"id": "{name}"}}]')
    _write(spark, f"{root}/in", "p95", '[{"id": "v"')
    monkeypatch.setattr(MG, "merge_into", lambda s, base, rows, *a, **k: kinds.append(rows.schema[ST.ITEM_ORDER].dataType["f"].dataType.simpleString()) or whole(s, base, rows, *a, **k))
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    ST.stream_upsert(spark, f"{root}/in", SCH.VIDEO_ITEM, LD.flatten_videos, f"{root}/table", f"{root}/cp", ["video_id"]).awaitTermination()
    got = {r["video_id"]: r["view_count"] for r in MG.read_current(spark, f"{root}/table").collect()}
    assert got == {"v": 2, "p10": None, "p9": None, "p1": None}
    assert kinds and set(kinds) <= {"bigint", "int"} and spark.conf.get("spark.sql.files.maxPartitionBytes") == before


def test_a_run_parses_each_folder_once(spark, monkeypatch):
    """Features and merges of a run read the same parsed items, and what they sort holds a
    file's number; the first item of a repeated video counts in the features, the last is merged."""
    import datetime as dt
    from tidewatch.functions import scalar as S
    from tidewatch.operators import scoring
    from tidewatch.plans import raw_run as RR
    root, read, kinds, whole = scratch_path(spark, "raw-run"), [], [], RR.dedup_first
    _write(spark, f"{root}/channels", "f", json.dumps(CHANNELS))
    again = [{**v, "statistics": {"viewCount": "9000"}} for v in VIDEOS]
    _write(spark, f"{root}/videos", "p10", json.dumps(VIDEOS))
    _write(spark, f"{root}/videos", "p9", json.dumps(again))
    _write(spark, f"{root}/videos", "p95", "[{")
    parse = LD.parse_pages
    monkeypatch.setattr(LD, "parse_pages", lambda *a: read.append(1) or parse(*a))
    monkeypatch.setattr(RR, "dedup_first", lambda df, *a, **k: kinds.append(df.schema[LD.ITEM_ORDER].dataType["f"].dataType.simpleString()) or whole(df, *a, **k))
    ref = dt.datetime(2024, 6, 15)
    items = RR.landed(spark, root)
    feats = RR.raw_to_features(spark, root, ref, items=items)
    a = feats.where(F.col("channel_id") == "UC" + "a" * 22).first()
    assert feats.count() == 2 and a["upload_freq_30d"] == 2 / 30 and a["avg_engagement_rate"] == pytest.approx(0.4)
    clusters = scoring.score_with_fixed_clusters(feats, F.length("channel_id") % 3, S.ts_lit(ref))
    out = RR.load_all(spark, root, feats, clusters, f"{root}/tables", ref, items=items)
    assert {r["table_name"]: (r["actual"], r["expected"]) for r in out.collect()} == {
        "channels": (2, 2), "channel_snapshots": (2, 2), "videos": (2, 4), "creator_features": (2, 2), "creator_clusters": (2, 2)}
    assert [r["view_count"] for r in spark.read.parquet(f"{root}/tables/videos").collect()] == [9000, 9000]
    assert len(read) == 2 and set(kinds) == {"bigint"}

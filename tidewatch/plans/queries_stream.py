"""Streaming queries (T1, T2): files land in two steps; the stream resumes from
its checkpoint and must end with the same rows as a batch read."""

from __future__ import annotations

from .. import schemas as SCH
from ..operators import merge as MG
from ..session import scratch_path
from ..sources import landing as LD
from ..sources import landing_fixture as LF
from ..sources.bindings import B1_DEDUP_ORDER
from ..streaming import ingest as ST
from .catalog import register
from .queries_io import VID_ITEMS_SQL

_VID_FLAT = ("video_id, channel_id, published_at, view_count, like_count, comment_count, comments_disabled, "
             "duration_seconds")


_NO_ID_SQL = "'', CAST(NULL AS TIMESTAMP), CAST(7 AS BIGINT), CAST(NULL AS BIGINT), CAST(NULL AS BIGINT), true, CAST(NULL AS BIGINT)"
_LAST_ITEM_SQL = ", ".join(f"{c} DESC" for c in B1_DEDUP_ORDER)


def _land_in_two_steps(spark, sf_dir, run_between):
    root = scratch_path(spark, "stream")
    src = f"{root}/landing"
    LF.write_pages(LF.video_items(spark, sf_dir, hi=LF.VIDEO_SPLIT), f"{src}/batch=1")
    LF.write_text(spark, f"{src}/broken", "not json [")
    run_between(root, src)
    LF.write_pages(LF.video_items(spark, sf_dir, lo=LF.VIDEO_SPLIT), f"{src}/batch=2")
    run_between(root, src)
    return root


@register("stream_ingest", f"SELECT {_VID_FLAT} FROM ({VID_ITEMS_SQL}) v")
def q_stream_ingest(spark, sf_dir):
    """File-stream ingest of landing pages, stopped and resumed (availableNow)."""
    def run(root, src):
        q = ST.ingest_landing_stream(spark, src, SCH.VIDEO_ITEM, LD.flatten_videos, f"{root}/out",
                                     f"{root}/checkpoint", f"{root}/quarantine")
        q.awaitTermination()
    root = _land_in_two_steps(spark, sf_dir, run)
    return spark.read.parquet(f"{root}/out").drop("stream", "batch_id")


@register("stream_two_sources", f"SELECT {_VID_FLAT} FROM ({VID_ITEMS_SQL}) v UNION ALL SELECT '', {_NO_ID_SQL}")
def q_stream_two_sources(spark, sf_dir):
    """Two sources with a checkpoint each into one folder; an item without id is
    kept, an empty page has no row, a broken file is skipped."""
    root = scratch_path(spark, "stream-two")
    LF.write_pages(LF.video_items(spark, sf_dir, hi=LF.VIDEO_SPLIT), f"{root}/a")
    LF.write_pages(LF.video_items(spark, sf_dir, lo=LF.VIDEO_SPLIT), f"{root}/b")
    LF.write_text(spark, f"{root}/b/empty", "[]")
    LF.write_text(spark, f"{root}/b/broken", '[{"id": "lost"')
    LF.write_text(spark, f"{root}/b/no_id", '[{"statistics": {"viewCount": "7"}}]')
    for source in ("a", "b"):
        ST.ingest_landing_stream(spark, f"{root}/{source}", SCH.VIDEO_ITEM, LD.flatten_videos, f"{root}/out",
                                 f"{root}/checkpoint-{source}").awaitTermination()
    return spark.read.parquet(f"{root}/out").drop("stream", "batch_id")


@register("stream_upsert", f"""
SELECT {_VID_FLAT} FROM (
  SELECT *, row_number() OVER (PARTITION BY video_id ORDER BY in_batch_2 DESC, {_LAST_ITEM_SQL}) AS rn
  FROM ({VID_ITEMS_SQL}) v) d WHERE rn = 1""")
def q_stream_upsert(spark, sf_dir):
    """Keyed merge per micro-batch into a bucketed table; later batches win,
    and in a batch the last item of a key."""
    def run(root, src):
        q = ST.stream_upsert(spark, src, SCH.VIDEO_ITEM, LD.flatten_videos, f"{root}/table",
                             f"{root}/checkpoint", ["video_id"])
        q.awaitTermination()
    root = _land_in_two_steps(spark, sf_dir, run)
    return MG.read_current(spark, f"{root}/table")


@register("stream_upsert_sources", f"""
SELECT {_VID_FLAT} FROM (
  SELECT *, row_number() OVER (PARTITION BY video_id ORDER BY in_batch_2 DESC, {_LAST_ITEM_SQL}) AS rn
  FROM ({VID_ITEMS_SQL}) v) d WHERE rn = 1""")
def q_stream_upsert_sources(spark, sf_dir):
    """Two sources with a checkpoint each, merged into one table: the second
    source's first batch is not taken for a replay of the first's."""
    root = scratch_path(spark, "stream-upsert")
    LF.write_pages(LF.video_items(spark, sf_dir, hi=LF.VIDEO_SPLIT), f"{root}/a")
    LF.write_pages(LF.video_items(spark, sf_dir, lo=LF.VIDEO_SPLIT), f"{root}/b")
    for source in ("a", "b"):
        ST.stream_upsert(spark, f"{root}/{source}", SCH.VIDEO_ITEM, LD.flatten_videos, f"{root}/table",
                         f"{root}/checkpoint-{source}", ["video_id"]).awaitTermination()
    return MG.read_current(spark, f"{root}/table")

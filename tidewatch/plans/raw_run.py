"""From landing pages to features and keyed tables: parse, skip
corrupt files, cast, cap, drop repeated videos, compute features; merge the
landing rows, features and clusters into the five keyed tables and reconcile
their row counts with the rows that came in."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession

from .. import schemas as SC
from ..functions import scalar as S
from ..operators import clean as CL
from ..operators import features as FE
from ..operators import merge as MG
from ..operators.ordering import dedup_first
from ..sources import landing as LD

CAPPED = ["subscriber_count", "view_count_total", "video_count"]
TABLES = {"channels": ["channel_id"], "channel_snapshots": ["channel_id", "snapshot_date"], "videos": ["video_id"],
          "creator_features": ["channel_id"], "creator_clusters": ["channel_id"]}


KINDS = {"channels": SC.CHANNEL_ITEM, "videos": SC.VIDEO_ITEM}


def landed(spark: SparkSession, root: str, multi_line: bool = False) -> dict[str, DataFrame]:
    """The parsed items of the landing folders below ``root``, with their places: one
    written table per folder, which every step of a run can read."""
    return {kind: LD.read_landing(spark, f"{root}/{kind}", schema, multi_line, ordered=True) for kind, schema in KINDS.items()}


def _good(items: DataFrame) -> DataFrame:
    """Items of readable files; their places hold the file's number."""
    return LD.numbered_files(LD.split_corrupt(items)[0], items)


def clean_channels(items: DataFrame, p: float = 0.99, cap: bool = True) -> DataFrame:
    """Channel rows of landed items with the three counters cast and capped."""
    df = LD.flatten_channels(LD.split_corrupt(items)[0])
    for c in CAPPED:
        df = CL.cap_outliers(df, c, p, enabled=cap).drop(f"{c}_capped")
    return df


def clean_videos(items: DataFrame) -> DataFrame:
    """Video rows of landed items: the first item of each video id in file order,
    counters as numbers."""
    rows = dedup_first(LD.flatten_videos(_good(items), LD.ITEM_ORDER), ["video_id"], [LD.ITEM_ORDER]).drop(LD.ITEM_ORDER)
    return rows.withColumns({c: S.cast_numeric(c) for c in ("view_count", "like_count", "comment_count", "duration_seconds")})


def raw_to_features(spark: SparkSession, root: str, ref, short: int = 30, long: int = 90, min_videos: int = 2,
                    multi_line: bool = False, items: dict[str, DataFrame] | None = None) -> DataFrame:
    """Features from the landing folders ``root/channels`` and ``root/videos``; ``items``:
    what :func:`landed` gave for them, when other steps read it too."""
    items = items or landed(spark, root, multi_line)
    return FE.compute_features(clean_channels(items["channels"]), clean_videos(items["videos"]), ref, short, long, min_videos)


def load_all(spark: SparkSession, root: str, features: DataFrame, clusters: DataFrame, tables: str, as_of,
             fetched_at: Column | None = None, multi_line: bool = False, items: dict[str, DataFrame] | None = None) -> DataFrame:
    """Merge everything into the keyed tables below ``tables`` (repeated keys:
    the last item in file order) and reconcile: table, actual, expected, delta, match.
    ``items``: what :func:`landed` gave for ``root``, when other steps read it too."""
    items = items or landed(spark, root, multi_line)
    dim, snap = LD.channel_dim_and_snapshots(_good(items["channels"]), as_of, fetched_at, LD.ITEM_ORDER)
    rows = {"channels": dim, "channel_snapshots": snap, "videos": LD.flatten_videos(_good(items["videos"]), LD.ITEM_ORDER),
            "creator_features": features, "creator_clusters": MG.with_algorithm(clusters)}
    merged = {name: MG.merge_into(spark, f"{tables.rstrip('/')}/{name}", df, TABLES[name],
                                  seq_col=LD.ITEM_ORDER if LD.ITEM_ORDER in df.columns else None)
              for name, df in rows.items()}
    return MG.reconcile(merged, rows)

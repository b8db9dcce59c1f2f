"""Nested landing JSON written from the driver tables.

Channels come from customer (+ nation, + order counts), videos from lineitem
(duplicates kept). Items are grouped into API-sized pages (at most 50 channel
items / 8 orders' lines per page) and written one JSON array per line. Batch 1
holds everything older than the split date, batch 2 the rest plus repeated
channel items; one broken file and one empty array are added.
"""

from __future__ import annotations

import datetime as _dt
from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import scalar as S
from ..session import scratch_path
from .bindings import B1_DEDUP_ORDER, table

VIDEO_SPLIT = _dt.datetime(1999, 7, 1)
ISO_FMT = "yyyy-MM-dd'T'HH:mm:ss'Z'"
KINDS = ("channels", "videos")


def uc_id(key: Column, malformed: Column | None = None) -> Column:
    """'UC' + key left-padded with 'A' to 22 characters; malformed: 20 + '!'."""
    k = key.cast("string")
    good = F.concat(F.lit("UC"), F.lpad(k, 22, "A"))
    if malformed is None:
        return good
    return F.when(malformed, F.concat(F.lit("UC"), F.lpad(k, 20, "A"), F.lit("!"))).otherwise(good)


@dataclass(frozen=True)
class Items:
    """Rows to land: ``rows`` has the number of the API page and the columns that items are
    made from, ``order`` names those that order the items of a page, and ``item`` makes
    the item of a row (a struct of the columns)."""
    rows: DataFrame
    order: list[str]
    item: Callable[[Column], Column]


def channel_items(spark: SparkSession, sf_dir: str, repeat: bool = False) -> Items:
    cus = table(spark, sf_dir, "customer")
    nat = table(spark, sf_dir, "nation").select(F.col("n_nationkey").alias("c_nationkey"), "n_name")
    cnt = table(spark, sf_dir, "orders").groupBy(F.col("o_custkey").alias("c_custkey")) \
        .agg(F.count(F.lit(1)).alias("n_orders"))
    c = cus.join(nat, "c_nationkey", "left").join(cnt, "c_custkey", "left")
    if repeat:
        c = c.where(F.col("c_mktsegment") == "MACHINERY")
    bump = 1 if repeat else 0

    def item(r: Column) -> Column:
        cid = uc_id(r["c_custkey"], r["c_mktsegment"] == "HOUSEHOLD")
        missing = r["c_nationkey"] == 0
        snippet = F.struct(
            r["c_name"].alias("title"),
            F.when(r["c_mktsegment"] != "AUTOMOBILE", F.concat(F.lit("Segment "), r["c_mktsegment"])).alias("description"),
            F.date_format(F.to_timestamp(F.lit("2015-01-01")) + F.make_interval(days=(r["c_custkey"] % 365).cast("int")),
                          ISO_FMT).alias("publishedAt"),
            r["n_name"].alias("country"))
        stats = F.struct(
            F.when(r["c_mktsegment"] == "FURNITURE", F.lit("n/a"))
            .otherwise(F.floor(r["c_acctbal"] * 1000).cast("bigint").cast("string")).alias("viewCount"),
            F.when(r["c_acctbal"] >= 0, (F.floor(r["c_acctbal"] * 100).cast("bigint") + bump).cast("string"))
            .alias("subscriberCount"),
            (r["c_acctbal"] < 0).alias("hiddenSubscriberCount"),
            F.coalesce(r["n_orders"], F.lit(0)).cast("string").alias("videoCount"))
        uploads = F.when(r["c_nationkey"] != 2, F.concat(F.lit("UU"), F.substring(cid, 3, 100)))
        content = F.struct(F.struct(uploads.alias("uploads"), F.lit("").alias("likes")).alias("relatedPlaylists"))
        return F.struct(cid.alias("id"), F.when(~missing, snippet).alias("snippet"),
                        F.when(~missing, stats).alias("statistics"), F.when(~missing, content).alias("contentDetails"))

    rows = c.select(F.floor(F.col("c_custkey") / 50).alias("page"), "c_custkey", "c_name", "c_nationkey", "c_acctbal", "c_mktsegment", "n_name", "n_orders")
    return Items(rows, ["c_custkey"], item)


def video_items(spark: SparkSession, sf_dir: str, lo=None, hi=None) -> Items:
    li = table(spark, sf_dir, "lineitem")
    if hi is not None:
        li = li.where(F.col("l_shipdate") < S.ntz_lit(hi))
    if lo is not None:
        li = li.where(F.col("l_shipdate") >= S.ntz_lit(lo))

    def item(r: Column) -> Column:
        stats = F.map_filter(F.create_map(
            F.lit("viewCount"), F.floor(r["l_extendedprice"]).cast("bigint").cast("string"),
            F.lit("likeCount"), F.floor(r["l_quantity"]).cast("bigint").cast("string"),
            F.lit("commentCount"), F.when(r["l_returnflag"] != "N",
                                          F.round(r["l_tax"] * 100).cast("bigint").cast("string"))),
            lambda k, v: v.isNotNull())
        return F.struct(
            F.concat(r["l_orderkey"].cast("string"), F.lit("-"), r["l_linenumber"].cast("string")).alias("id"),
            F.struct(uc_id(r["l_suppkey"]).alias("channelId"),
                     F.date_format(S.ts_utc(r["l_shipdate"]), ISO_FMT).alias("publishedAt")).alias("snippet"),
            stats.alias("statistics"),
            F.struct(S.seconds_to_iso(F.floor(r["l_quantity"] * 37)).alias("duration")).alias("contentDetails"))

    return Items(li.select(F.floor(F.col("l_orderkey") / 8).alias("page"), "l_orderkey", "l_linenumber", *B1_DEDUP_ORDER), list(B1_DEDUP_ORDER), item)


def write_pages(items: Items, path: str) -> None:
    """One JSON array (an API page, bounded size) per line, in compressed files.
    Pages follow their number over the files, items their order in the page. The
    tables' own columns go through the one exchange, by page; the text is made after it."""
    rest = [c for c in items.rows.columns if c != "page" and c not in items.order]
    dealt = items.rows.repartitionByRange("page")
    pages = dealt.groupBy("page").agg(F.sort_array(F.collect_list(F.struct(*items.order, *rest))).alias("rows"))
    value = F.to_json(F.transform("rows", items.item))
    pages.sortWithinPartitions("page").select(value.alias("value")).write.mode("overwrite") \
        .option("compression", "gzip").option("zlib.compress.level", "BEST_SPEED").text(path)


def write_text(spark: SparkSession, path: str, text: str) -> None:
    spark.createDataFrame([(text,)], "value string").coalesce(1).write.mode("overwrite").text(path)


def build_landing(spark: SparkSession, sf_dir: str, kinds: Sequence[str] = KINDS) -> str:
    """Write the B4 landing zone's folders of ``kinds`` and return its root. Every query
    lands the folders that it reads, so its work is the same whichever ran before."""
    root = scratch_path(spark, "landing")
    if "channels" in kinds:
        write_pages(channel_items(spark, sf_dir), f"{root}/channels/batch=1")
        write_pages(channel_items(spark, sf_dir, repeat=True), f"{root}/channels/batch=2")
        write_text(spark, f"{root}/channels/broken", '[{"id": "UCbroken", "snippet": {"title": ')
        write_text(spark, f"{root}/channels/empty", "[]")
    if "videos" in kinds:
        write_pages(video_items(spark, sf_dir, hi=VIDEO_SPLIT), f"{root}/videos/batch=1")
        write_pages(video_items(spark, sf_dir, lo=VIDEO_SPLIT), f"{root}/videos/batch=2")
        write_text(spark, f"{root}/videos/broken", "not json [")
        write_text(spark, f"{root}/videos/empty", "[]")
    return root

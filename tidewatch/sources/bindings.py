"""Bindings B1-B3: derive channel and video frames from the driver's tables.

The driver tables hold no channels or videos; these projections give the
feature jobs real work that grows with the tables. Timestamps arrive as
``timestamp_ntz`` and are read as UTC. Every double -> integer cast goes
through ``floor`` (or ``round``) so Spark and SQL engines agree.
"""

from __future__ import annotations

import datetime as _dt
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import scalar as S
from ..operators.ordering import dedup_first


@dataclass(frozen=True)
class Binding:
    name: str
    ref: _dt.datetime
    short: int
    long: int


# All rows take part: the reference days lie past the last ship date and order.
# (Future uploads, N3, are covered by the tests' random frames.)
B1 = Binding("b1", _dt.datetime(2001, 11, 5), 30, 90)
B2 = Binding("b2", _dt.datetime(2001, 8, 2), 30, 90)
B3 = Binding("b3", _dt.datetime(2024, 1, 31), 7, 21)

VIDEO_COLS = ["video_id", "channel_id", "published_at", "view_count", "like_count",
              "comment_count", "comments_disabled", "duration_seconds"]

# Dedup order of B1 (first row per video_id wins).
B1_DEDUP_ORDER = ["l_shipdate", "l_suppkey", "l_partkey", "l_extendedprice", "l_quantity",
                  "l_discount", "l_tax", "l_returnflag", "l_linestatus"]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _bigint_floor(c) -> F.Column:
    return F.floor(S.col(c)).cast("bigint")


def _subscribers(acctbal: str) -> F.Column:
    return F.when(F.col(acctbal) >= 0, F.floor(F.col(acctbal) * 100).cast("bigint"))


# ---- B1: supplier / lineitem ------------------------------------------------

def b1_channels(spark: SparkSession, sf_dir: str) -> DataFrame:
    sup = table(spark, sf_dir, "supplier")
    cnt = table(spark, sf_dir, "lineitem").groupBy(F.col("l_suppkey").alias("s_suppkey")) \
        .agg(F.count(F.lit(1)).alias("video_count"))
    return sup.join(cnt, "s_suppkey", "left").select(
        F.col("s_suppkey").alias("channel_id"),
        F.col("s_name").alias("title"),
        _subscribers("s_acctbal").alias("subscriber_count"),
        F.coalesce(F.col("video_count"), F.lit(0)).cast("bigint").alias("video_count"),
    )


def _b1_source(spark: SparkSession, sf_dir: str, before=None) -> DataFrame:
    """Line items; ``before``: the state of the table at an earlier day."""
    li = table(spark, sf_dir, "lineitem")
    if before is not None:
        li = li.where(F.col("l_shipdate") < S.ntz_lit(before))
    return li.select(
        F.concat(F.col("l_orderkey").cast("string"), F.lit("-"), F.col("l_linenumber").cast("string")).alias("video_id"),
        *B1_DEDUP_ORDER)


def _b1_video_columns(df: DataFrame) -> DataFrame:
    """Video columns derived from line-item columns (all derived from the
    dedup order columns, so the dedup can run before the derivation)."""
    n_flag = F.col("l_returnflag") == "N"
    return df.select(
        "video_id",
        F.col("l_suppkey").alias("channel_id"),
        S.ts_utc("l_shipdate").alias("published_at"),
        _bigint_floor("l_extendedprice").alias("view_count"),
        _bigint_floor("l_quantity").alias("like_count"),
        F.when(~n_flag, F.round(F.col("l_tax") * 100).cast("bigint")).alias("comment_count"),
        n_flag.alias("comments_disabled"),
        F.floor(F.col("l_quantity") * 37).cast("int").alias("duration_seconds"),
        *B1_DEDUP_ORDER,
    )


def b1_videos_raw(spark: SparkSession, sf_dir: str, before=None) -> DataFrame:
    """Video rows before dedup (video_id is not unique), with the dedup order columns."""
    return _b1_video_columns(_b1_source(spark, sf_dir, before))


def b1_videos(spark: SparkSession, sf_dir: str, before=None) -> DataFrame:
    """Deduplicated videos: first row per video_id in the binding's order. The
    dedup shuffles only the key and the order columns; video columns are
    derived afterwards."""
    first = dedup_first(_b1_source(spark, sf_dir, before), ["video_id"], B1_DEDUP_ORDER)
    return _b1_video_columns(first).select(*VIDEO_COLS)


# ---- B2: customer / orders ---------------------------------------------------

def b2_channels(spark: SparkSession, sf_dir: str) -> DataFrame:
    cus = table(spark, sf_dir, "customer")
    cnt = table(spark, sf_dir, "orders").groupBy(F.col("o_custkey").alias("c_custkey")) \
        .agg(F.count(F.lit(1)).alias("video_count"))
    return cus.join(cnt, "c_custkey", "left").select(
        F.col("c_custkey").alias("channel_id"),
        F.col("c_name").alias("title"),
        _subscribers("c_acctbal").alias("subscriber_count"),
        F.coalesce(F.col("video_count"), F.lit(0)).cast("bigint").alias("video_count"),
    )


def b2_videos(spark: SparkSession, sf_dir: str, before=None) -> DataFrame:
    o = table(spark, sf_dir, "orders")
    if before is not None:
        o = o.where(F.col("o_orderdate") < S.ntz_lit(before))
    low = F.col("o_orderpriority") == "5-LOW"
    return o.select(
        F.col("o_orderkey").cast("string").alias("video_id"),
        F.col("o_custkey").alias("channel_id"),
        S.ts_utc("o_orderdate").alias("published_at"),
        _bigint_floor("o_totalprice").alias("view_count"),
        (F.col("o_orderkey") % 97).cast("bigint").alias("like_count"),
        F.when(~low, (F.col("o_orderkey") % 7).cast("bigint")).alias("comment_count"),
        low.alias("comments_disabled"),
        ((F.col("o_orderkey") % 50) * 30).cast("int").alias("duration_seconds"),
    )


# ---- B3: users / events ------------------------------------------------------

def b3_channels(spark: SparkSession, sf_dir: str) -> DataFrame:
    ev = table(spark, sf_dir, "events")
    return ev.groupBy(F.col("user_id").alias("channel_id")).agg(F.count(F.lit(1)).alias("video_count")).select(
        "channel_id",
        F.concat(F.lit("user-"), F.col("channel_id").cast("string")).alias("title"),
        F.lit(None).cast("bigint").alias("subscriber_count"),
        F.col("video_count").cast("bigint"),
    )


def b3_videos(spark: SparkSession, sf_dir: str) -> DataFrame:
    ev = table(spark, sf_dir, "events")
    err = F.col("event_type") == "error"
    return ev.select(
        F.col("event_id").cast("string").alias("video_id"),
        F.col("user_id").alias("channel_id"),
        S.ts_utc("ts").alias("published_at"),
        _bigint_floor("value").alias("view_count"),
        F.get_json_object("props", "$.k").try_cast("bigint").alias("like_count"),
        F.when(~err, (F.col("event_id") % 5).cast("bigint")).alias("comment_count"),
        err.alias("comments_disabled"),
        (F.col("event_id") % 600).cast("int").alias("duration_seconds"),
    )


BINDINGS = {
    "b1": (B1, b1_channels, b1_videos),
    "b2": (B2, b2_channels, b2_videos),
    "b3": (B3, b3_channels, b3_videos),
}


def channels_videos(spark: SparkSession, sf_dir: str, name: str):
    b, ch, vi = BINDINGS[name]
    return b, ch(spark, sf_dir), vi(spark, sf_dir)

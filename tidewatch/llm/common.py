"""Helpers shared by the operators: table access, column packing, written tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import scratch_path

ASCII_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
ASCII_LOWER = ASCII_UPPER.lower()


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def lower_ascii(c: Column) -> Column:
    """Lower-case A-Z only; every other character stays."""
    return F.translate(c, ASCII_UPPER, ASCII_LOWER)


def whole_text(c: str | Column) -> Column:
    """The text, with null read as empty."""
    return F.coalesce(F.col(c) if isinstance(c, str) else c, F.lit(""))


def packed(df: DataFrame, *own: Column) -> DataFrame:
    """``own`` columns plus the whole input row as one struct ``row``.

    The operators carry the caller's columns as a struct, so that none of
    their names can clash with a column that the operator adds."""
    return df.select(*own, F.struct(*[F.col(f"`{c}`") for c in df.columns]).alias("row"))


def written(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared checkpoint folder and read it back: cuts the
    lineage, survives the loss of an executor, and gives both sides of a later
    join a plain exchange that the engine can split when a key is hot."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def text_bytes(df: DataFrame, text: str) -> int:
    """UTF-8 bytes of a text column, for sizing shuffles (one pass, one number)."""
    return df.agg(F.sum(F.octet_length(F.col(text).cast("string")).cast("long"))).first()[0] or 0


def sampled(df: DataFrame, key: str, total: int, most: int) -> DataFrame:
    """At most ``most`` rows of ``df``, one per ``key``, that a 64-bit hash of the key
    draws from all of about ``total`` keys; all of them when there are no more.

    A threshold on the hash leaves about twice as many in each task, then the
    smallest hashes stay; columns other than the key become their least value."""
    h = F.xxhash64(key)
    if total > 2 * most:
        df = df.where(h < F.lit(-(1 << 63) + (2 * most << 64) // total))
    one = df.groupBy(key).agg(*[F.min(c).alias(c) for c in df.columns if c != key])
    return one.orderBy(h, F.col(key)).limit(most).select(df.columns)


def shuffle_partitions(spark: SparkSession, *, rows: int = 0, rows_per_task: int = 1) -> int:
    """The session's shuffle partitions, or more when the rows ask for it."""
    return max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-rows // rows_per_task))

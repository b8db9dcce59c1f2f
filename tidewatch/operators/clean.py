"""Cleaning and validation (P1 audit, A10, W5 counts, P20, P22, P25, P26)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import scalar as S
from .ordering import dedup_first, exact_quantiles


def cast_numeric_audit(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """P1 audit: per column non-null inputs, values coerced to NULL, and whether
    every value was lost (column may be corrupt)."""
    aggs = []
    for c in cols:
        aggs += [F.count(F.col(c)).alias(f"{c}__in"), F.sum(S.coerced_flag(c)).alias(f"{c}__lost")]
    row = df.agg(*aggs)
    stack = F.explode(F.array(*[
        F.struct(F.lit(c).alias("column_name"), F.col(f"{c}__in").alias("n_input"),
                 F.coalesce(F.col(f"{c}__lost"), F.lit(0)).cast("bigint").alias("n_coerced")) for c in cols]))
    out = row.select(stack.alias("s")).select("s.*")
    return out.withColumn("all_coerced", (F.col("n_input") > 0) & (F.col("n_coerced") == F.col("n_input")))


def cap_outliers(df: DataFrame, column: str, p: float = 0.99, enabled: bool = True,
                 group_cols: Sequence[str] = ()) -> DataFrame:
    """A10: clip values above the interpolated p-quantile (exact, N7); NULLs
    pass through. Adds ``<column>_capped`` (bool)."""
    if not enabled:
        return df.withColumn(f"{column}_capped", F.lit(False))
    q = exact_quantiles(df, column, [p], group_cols).select(*group_cols, F.col("q").alias("_cap"))
    if group_cols:
        j = df.join(q, list(group_cols), "left")
    else:
        cap = q.first()                                   # one scalar
        j = df.withColumn("_cap", F.lit(cap["_cap"] if cap else None).cast("double"))
    x = F.col(column).cast("double")
    return j.select(*[F.when(x > F.col("_cap"), F.col("_cap")).otherwise(x).alias(column) if c == column else F.col(c)
                      for c in df.columns],
                    F.coalesce(x > F.col("_cap"), F.lit(False)).alias(f"{column}_capped"))


def dedup_with_count(df: DataFrame, keys: Sequence[str], order: Sequence[str], keep: str = "first"):
    """(deduplicated frame, one-row frame with rows in/out/dropped)."""
    out = dedup_first(df, keys, order, keep)
    tagged = df.select(F.lit(1).alias("_in"), F.lit(0).alias("_out")).unionByName(
        out.select(F.lit(0).alias("_in"), F.lit(1).alias("_out")))
    stats = tagged.agg(F.sum("_in").cast("bigint").alias("rows_in"), F.sum("_out").cast("bigint").alias("rows_out"))
    stats = stats.select(F.coalesce("rows_in", F.lit(0)).alias("rows_in"), F.coalesce("rows_out", F.lit(0)).alias("rows_out"))
    return out, stats.withColumn("dropped", F.col("rows_in") - F.col("rows_out"))


def build_seed(df: DataFrame, id_col: str = "channel_id", ordinal: str = "ordinal") -> DataFrame:
    """P20: drop repeated ids (first in file order wins, before the format
    check), then drop ids that fail P19; file order kept in ``ordinal``."""
    first = dedup_first(df, [id_col], [ordinal])
    return first.where(S.valid_channel_id(id_col))


def channels_with_uploads(df: DataFrame, id_col: str = "channel_id", uploads_col: str = "uploads_playlist_id"):
    """(channels with an id and an uploads playlist, the rest)."""
    ok = (F.coalesce(F.length(F.col(id_col)), F.lit(0)) > 0) & (F.coalesce(F.length(F.col(uploads_col)), F.lit(0)) > 0)
    return df.where(ok), df.where(~ok)


def enum_violations(df: DataFrame, column: str, allowed: Sequence[str]) -> DataFrame:
    """P25: count of values outside ``allowed`` (NULL counts as a violation)."""
    bad = F.col(column).isNull() | ~F.col(column).isin(list(allowed))
    return df.agg(F.lit(column).alias("column_name"), F.count_if(bad).alias("n_violations"),
                  F.count(F.lit(1)).alias("n_rows"))


def key_violations(df: DataFrame, table: str, pk: Sequence[str], not_null: Sequence[str] = (),
                   fk: tuple[str, DataFrame, str] | None = None) -> DataFrame:
    """Primary-key duplicates, NULLs in required columns, and rows whose
    foreign key has no parent (left anti join). One row per check."""
    pk = list(pk)
    dup = df.groupBy(*pk).agg(F.count(F.lit(1)).alias("_c")).where(F.col("_c") > 1) \
        .agg(F.coalesce(F.sum(F.col("_c") - 1), F.lit(0)).cast("bigint").alias("n"))
    parts = [dup.select(F.lit(table).alias("table_name"), F.lit("primary_key").alias("check_name"),
                        F.lit(",".join(pk)).alias("columns"), "n")]
    for c in list(pk) + list(not_null):
        parts.append(df.agg(F.count_if(F.col(c).isNull()).alias("n")).select(
            F.lit(table).alias("table_name"), F.lit("not_null").alias("check_name"), F.lit(c).alias("columns"), "n"))
    if fk is not None:
        col, parent, parent_col = fk
        orphans = df.where(F.col(col).isNotNull()).join(
            parent.select(F.col(parent_col).alias(col)), col, "left_anti")
        parts.append(orphans.agg(F.count(F.lit(1)).alias("n")).select(
            F.lit(table).alias("table_name"), F.lit("foreign_key").alias("check_name"), F.lit(col).alias("columns"), "n"))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out

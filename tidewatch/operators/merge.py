"""Keyed merge (upsert) for parquet tables, K5-K9, plus row-count reconciliation.

Parquet tables have no MERGE. A table is partitioned into hash buckets of its key;
a merge is a full outer join on the keys over the buckets that the updates touch,
put in place by dynamic partition overwrite. Updates are first reduced to one
row per key (last wins by a sequence column, as rows applied in order would
leave it) so a batch with repeated keys is well defined.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import exists, remove
from .ordering import dedup_first


def align_schema(df: DataFrame, columns: Sequence[str], types: dict | None = None) -> DataFrame:
    """K8: add missing columns as NULL (typed when known), keep ``columns`` order."""
    out = []
    for c in columns:
        if c in df.columns:
            out.append(F.col(c))
        else:
            t = (types or {}).get(c, "string")
            out.append(F.lit(None).cast(t).alias(c))
    return df.select(*out)


def latest_updates(updates: DataFrame, keys: Sequence[str], seq_col: str | None) -> DataFrame:
    """One update row per key: the last by ``seq_col`` (partial aggregation,
    so a key repeated millions of times is reduced before the shuffle)."""
    if seq_col is None:
        return dedup_first(updates, keys, [c for c in updates.columns if c not in keys], keep="last")
    return dedup_first(updates, keys, [seq_col], keep="last")


def upsert(target: DataFrame, updates: DataFrame, keys: Sequence[str],
           update_cols: Sequence[str] | None = None, seq_col: str | None = None,
           drop_seq: bool = True) -> DataFrame:
    """K5-K8: insert new keys; for existing keys overwrite ``update_cols`` (all
    non-key columns by default) and keep the target's other columns
    (insert-only, K7). Columns missing from ``updates`` become NULL on update."""
    keys = list(keys)
    tcols = [c for c in target.columns]
    types = {f.name: f.dataType.simpleString() for f in target.schema.fields}
    u = latest_updates(updates, keys, seq_col)
    if seq_col is not None and drop_seq and seq_col not in tcols:
        u = u.drop(seq_col)
    u = align_schema(u, tcols, types)
    value_cols = [c for c in tcols if c not in keys]
    upd = set(value_cols if update_cols is None else update_cols)
    t = target.withColumn("_in_t", F.lit(True)).alias("t")
    uu = u.withColumn("_in_u", F.lit(True)).alias("u")
    cond = None
    for k in keys:
        c = F.col(f"t.{k}") == F.col(f"u.{k}")
        cond = c if cond is None else cond & c
    j = t.join(uu, cond, "full_outer")
    in_u = F.col("u._in_u").isNotNull()
    in_t = F.col("t._in_t").isNotNull()
    out = [F.coalesce(F.col(f"u.{k}"), F.col(f"t.{k}")).alias(k) for k in keys]
    for c in value_cols:
        if c in upd:
            out.append(F.when(in_u, F.col(f"u.{c}")).otherwise(F.col(f"t.{c}")).alias(c))
        else:
            out.append(F.when(in_t, F.col(f"t.{c}")).otherwise(F.col(f"u.{c}")).alias(c))
    return j.select(*out).select(*tcols)


def with_algorithm(clusters: DataFrame) -> DataFrame:
    """K9: algorithm = text before the first '_' of model_version, 'kmeans' if NULL."""
    return clusters.withColumn("algorithm", F.coalesce(F.substring_index("model_version", "_", 1), F.lit("kmeans")))


# ---- merges into a Parquet folder ----------------------------------------------

BUCKETS = 32


def read_current(spark: SparkSession, base: str) -> DataFrame | None:
    """The table at ``base``; None when nothing was merged into it yet."""
    if not exists(spark, base):
        return None
    return spark.read.parquet(base).drop("bucket")


def _overwrite(spark: SparkSession, base: str) -> None:
    """The staged rows' buckets in place of the table's, then the stage goes."""
    staged = f"{base}/_staged"
    spark.read.parquet(staged).write.mode("overwrite").option("partitionOverwriteMode", "dynamic") \
        .partitionBy("bucket").parquet(base)
    remove(spark, staged)


def merge_into(spark: SparkSession, base: str, updates: DataFrame, keys: Sequence[str],
               update_cols: Sequence[str] | None = None, seq_col: str | None = None,
               buckets: int = BUCKETS) -> DataFrame:
    """K5-K9: merge ``updates`` into the Parquet table at ``base`` and return the table.

    The table is partitioned by a hash of its keys into ``buckets`` (the same number
    in every merge). Only buckets that hold a key of the updates are read; their
    merged rows are staged, then put in place by Spark's dynamic partition
    overwrite. A stage that was written whole but not put in place, as after a
    crash, is put in place first.

    Merging the same updates again changes nothing, so a run or micro-batch that
    is replayed after a failure needs no record of it: a stream replays its last
    batch only. One writer at a time."""
    keys, base = list(keys), base.rstrip("/")
    if exists(spark, f"{base}/_staged/_SUCCESS"):
        _overwrite(spark, base)
    table = read_current(spark, base)
    types = dict(table.dtypes) if table is not None else {}
    u = updates.withColumns({k: F.col(k).cast(types[k]) for k in keys if k in types})
    bucket = F.pmod(F.xxhash64(*keys), F.lit(buckets)).cast("int")
    touched = sorted(r[0] for r in u.select(bucket).distinct().collect())     # at most ``buckets`` numbers
    if not touched:
        return table if table is not None else updates.drop(*([seq_col] if seq_col else [])).limit(0)
    if table is not None:
        current = spark.read.parquet(base).where(F.col("bucket").isin(touched)).drop("bucket")
        merged = upsert(current, u, keys, update_cols, seq_col)
    else:
        merged = latest_updates(u, keys, seq_col)
        merged = merged.drop(seq_col) if seq_col is not None else merged
    merged.withColumn("bucket", bucket).repartitionById(buckets, F.col("bucket")).write.mode("overwrite").parquet(f"{base}/_staged")
    _overwrite(spark, base)
    return read_current(spark, base)


# ---- D4 ----------------------------------------------------------------------

def reconcile(tables: dict[str, DataFrame], expected: dict) -> DataFrame:
    """Per table actual rows vs expected (an int, or a frame whose row count
    is the expectation), delta and match. A table that is not known gives NULL
    actual and match false."""
    spark = next(iter(tables.values())).sparkSession if tables else SparkSession.getActiveSession()
    parts = []
    for name, exp in expected.items():
        if name in tables:
            parts.append(tables[name].select(F.lit(name).alias("table_name"), F.lit(1).alias("_a"), F.lit(0).alias("_e")))
        if isinstance(exp, DataFrame):
            parts.append(exp.select(F.lit(name).alias("table_name"), F.lit(0).alias("_a"), F.lit(1).alias("_e")))
    fixed = [(n, int(e)) for n, e in expected.items() if not isinstance(e, DataFrame)]
    names = spark.createDataFrame([(n, n in tables) for n in expected], "table_name string, _known boolean")
    out = names
    if parts:
        u = parts[0]
        for p in parts[1:]:
            u = u.unionByName(p)
        cnt = u.groupBy("table_name").agg(F.sum("_a").cast("bigint").alias("_na"), F.sum("_e").cast("bigint").alias("_ne"))
        out = out.join(cnt, "table_name", "left")
    else:
        out = out.withColumn("_na", F.lit(None).cast("bigint")).withColumn("_ne", F.lit(None).cast("bigint"))
    fx = spark.createDataFrame(fixed or [("", 0)], "table_name string, _fe bigint")
    out = out.join(fx, "table_name", "left")            # one row per expected table: bounded
    actual = F.when(F.col("_known"), F.coalesce(F.col("_na"), F.lit(0)))
    exp_col = F.coalesce(F.col("_fe"), F.coalesce(F.col("_ne"), F.lit(0)))
    return out.select("table_name", actual.alias("actual"), exp_col.cast("bigint").alias("expected"),
                      (actual - exp_col).alias("delta"),
                      F.coalesce(actual == exp_col, F.lit(False)).alias("match"))

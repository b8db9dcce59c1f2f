"""Order-dependent operators that stay distributed under skew.

All of them cut a total order, or a hot key's rows in it, into blocks of about
equal size. Block bounds are read from a sample of rows that a hash of the sort key draws, so they are the
same however often and wherever they are computed; they enter the plan as a
scalar subquery, and a row's block number is an expression of its sort key. So
nothing runs while a frame is built, nothing is checkpointed, and a lost
executor's rows fall into the same blocks again.

* ``rank_in_groups`` — rank, group size and predecessor values inside key groups:
  one exchange by key and block, where only keys that fill half a block or more
  are cut; windows over (key, block) on it, and a table of the hot keys' blocks
  with what lies before.
* ``value_ranks`` — order statistics over *distinct* values: (group, value) is
  counted by partial aggregation, then counts are summed up block by block. A
  value that most rows share is one row per task before any exchange.
* ``exact_quantiles`` / ``kth_values`` — exact order statistics on ``value_ranks``,
  without the single-buffer ``percentile`` aggregate.
* ``global_index`` — dense 0-based index over a total order.
* ``dedup_first`` — first row per key as the minimum of (order, rest of the row).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

SAMPLED = 32   # sampled rows per block
HOT = 16       # sampled rows from which on a key is cut, and rows between its bounds


def _n_blocks(df: DataFrame, blocks: int | None) -> int:
    if blocks:
        return int(blocks)
    return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))


def _key_cond(left: str, right: str, keys: Sequence[str]):
    """Null-safe equality on ``keys`` between two aliased frames."""
    cond = None
    for k in keys:
        c = F.col(f"{left}.{k}").eqNullSafe(F.col(f"{right}.{k}"))
        cond = c if cond is None else cond & c
    return cond


def _sort_key(order: Sequence[str], nulls_last: bool) -> list[Column]:
    """Ascending sort expressions of the order columns."""
    return [e for c in order for e in ([F.col(c).isNull(), F.col(c)] if nulls_last else [F.col(c)])]


def _bounds(df: DataFrame, key: Column, hashed: Sequence[str], n: int, also: Sequence[str] = ()) -> Column:
    """At most n - 1 sorted bounds of ``key`` as a scalar subquery.

    ``also``: columns that the sample reads although it does not need them, so
    that it can share an exchange below ``df`` with the other readers."""
    h = F.xxhash64(*hashed)
    near = df.select(key.alias("_k"), h.alias("_h"), *[F.col(c) for c in also]).orderBy("_h", "_k").limit(SAMPLED * n)
    some = near.agg(F.sort_array(F.collect_list(F.struct("_k", *also))).alias("_s"))
    at = F.sequence(F.lit(1), F.lit(max(n - 1, 1)))
    pick = F.transform(at, lambda j: F.get(F.col("_s._k"), F.floor(j * F.size("_s") / F.lit(float(n))).cast("int")))
    if n < 2:
        pick = F.slice(pick, 1, 0)
    return some.select(F.array_distinct(F.filter(pick, lambda b: b.isNotNull()))).scalar()


def _blocked(df: DataFrame, bounds: Column, key: Column, n: int, cut: Column | None = None) -> DataFrame:
    """``df`` with its block number ``_blk``, and with ``cut`` (a struct) ``_near``: whether
    one of the block's two bounds has that struct as its ``k``."""
    df = df.withColumn("_bounds", bounds)
    b = F.col("_bounds")
    df = df.withColumn("_blk", _search(b, key, n))
    if cut is not None:
        near = F.get(b, F.col("_blk") - 1)["k"].eqNullSafe(cut) | F.get(b, F.col("_blk"))["k"].eqNullSafe(cut)
        df = df.withColumn("_near", F.coalesce(near, F.lit(False)))
    return df.drop("_bounds")


def _search(bounds: Column, key: Column, n: int) -> Column:
    """How many of the sorted ``bounds`` are at or below ``key``, by binary search."""
    steps = F.array(*[F.lit(1 << s) for s in range(max(n - 1, 1).bit_length() - 1, -1, -1)])
    return F.aggregate(steps, F.lit(0), lambda at, s: F.when(
        (at + s <= F.size(bounds)) & (F.get(bounds, at + s - F.lit(1)) <= key), at + s).otherwise(at))


def _hot_keys(df: DataFrame, keys: Sequence[str], order: Sequence[str], sort: Sequence[Column], n: int) -> Column:
    """Keys with many rows as a scalar subquery: a map from the key's hash to sorted
    bounds inside the key. A key is hot when ``HOT`` or more of the ``SAMPLED * n`` sampled
    rows are its own, so there are at most 2 n hot keys and as many bounds."""
    near = df.select(F.xxhash64(*keys).alias("_key"), F.struct(*sort).alias("_o"), F.xxhash64(*keys, *order).alias("_h")).orderBy("_h", "_o").limit(SAMPLED * n)
    hot = near.groupBy("_key").agg(F.sort_array(F.collect_list("_o")).alias("_s")).where(F.size("_s") >= HOT)
    every = F.transform(F.sequence(F.lit(1), F.floor(F.size("_s") / HOT).cast("int")), lambda j: F.get("_s", j * HOT - 1))
    return hot.agg(F.map_from_entries(F.collect_list(F.struct("_key", F.array_distinct(every))))).scalar()


def rank_in_groups(df: DataFrame, keys: Sequence[str], order: Sequence[str], *, nulls_last: bool = False,
                   carry: Sequence[str] = (), blocks: int | None = None,
                   rank_col: str = "_rank", size_col: str = "_gsize",
                   prev_prefix: str = "_prev_") -> DataFrame:
    """Add ``rank_col`` (1-based rank inside each ``keys`` group by ascending
    ``order`` columns, which must give a total order), ``size_col`` (group size) and,
    for each column ``c`` in ``carry``, ``prev_prefix + c`` = value of ``c`` on the
    preceding row of the same group (NULL for the first row).

    One exchange, by key and block: a key of few rows is one block, a hot one is
    cut at its bounds, so no group of many rows is ever in one task whole."""
    keys, order, carry = list(keys), list(order), list(carry)
    n = _n_blocks(df, blocks)
    sort = _sort_key(order, nulls_last)
    hot = df.withColumn("_hot", _hot_keys(df, keys, order, sort, n)).withColumn("_bounds", F.col("_hot")[F.xxhash64(*keys)]).drop("_hot")
    blocked = hot.withColumn("_blk", F.when(F.col("_bounds").isNotNull(), _search(F.col("_bounds"), F.struct(*sort), 2 * SAMPLED * n)).otherwise(0))

    # Hot keys: their blocks' sizes and last rows, added up by block.
    last = F.max_by(F.struct(*carry), F.struct(*sort)) if carry else F.lit(None)
    # (The partition id, which is always there, keeps the search from being copied into the filter.)
    near = F.col("_bounds").isNotNull() & (F.spark_partition_id() >= 0)
    parts = blocked.where(near).groupBy(*keys, "_blk").agg(F.count(F.lit(1)).alias("_bn"), last.alias("_last"))
    wk = Window.partitionBy(*keys).orderBy("_blk")
    cut = parts.select(*keys, "_blk",
                       F.coalesce(F.sum("_bn").over(wk.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("_off"),
                       F.sum("_bn").over(Window.partitionBy(*keys)).alias("_whole"),
                       F.lag("_last").over(wk).alias("_before"))

    w = Window.partitionBy(*keys, "_blk").orderBy(*sort)
    local = blocked.drop("_bounds").repartition(n, *keys, "_blk").select(
        "*", F.row_number().over(w).alias("_lrank"), F.count(F.lit(1)).over(Window.partitionBy(*keys, "_blk")).alias("_lsize"),
        *[F.lag(c).over(w).alias(f"_lprev_{c}") for c in carry])
    # A row per hot key and block: at most 4 n.
    j = local.alias("_l").join(F.broadcast(cut.alias("_b")), _key_cond("_l", "_b", keys) & (F.col("_l._blk") == F.col("_b._blk")), "left")
    out = [F.col(f"_l.{c}") for c in df.columns]
    out.append((F.col("_l._lrank") + F.coalesce("_b._off", F.lit(0))).alias(rank_col))
    out.append(F.coalesce("_b._whole", "_l._lsize").alias(size_col))
    out += [F.when(F.col("_l._lrank") > 1, F.col(f"_l._lprev_{c}")).otherwise(F.col("_b._before")[c]).alias(prev_prefix + c) for c in carry]
    return j.select(*out)


def value_ranks(df: DataFrame, value_col: str, group_cols: Sequence[str] = (), blocks: int | None = None) -> DataFrame:
    """Distinct non-null values per group with the places they take in the group's
    sorted rows: group..., _v, _from (0-based), _to (exclusive), _n (rows of the group).

    Rows are counted per (group, value) before the first exchange, and the sums
    run over distinct values in blocks, so neither a frequent value nor a large
    group is in one task whole."""
    group_cols = list(group_cols)
    n = _n_blocks(df, blocks)
    counts = df.select(*group_cols, F.col(value_col).alias("_v")).where(F.col("_v").isNotNull()) \
        .groupBy(*group_cols, "_v").agg(F.count(F.lit(1)).alias("_c"))
    group = F.struct(*(group_cols or [F.lit(0).alias("none")]))
    at = F.struct(group.alias("k"), F.col("_v").alias("v"))
    blocked = _blocked(counts, _bounds(counts, at, [*group_cols, "_v"], n, also=["_c"]), at, n, group)
    # Groups that a bound cuts: at most two rows per block. The condition reads the
    # count, and the sums the value, so that all readers share the counts' exchange.
    parts = blocked.where(F.when(F.col("_c") > 0, F.col("_near"))).groupBy(*group_cols, "_blk").agg(F.sum("_c").alias("_here"), F.max("_v").alias("_top"))
    by = [F.col(g) for g in group_cols] or [F.lit(0)]
    wk = Window.partitionBy(*by).orderBy("_blk")
    parts = parts.select(*group_cols, "_blk", "_top",
                         F.coalesce(F.sum("_here").over(wk.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("_off"),
                         F.sum("_here").over(Window.partitionBy(*by)).alias("_whole"))
    w = Window.partitionBy(*group_cols, "_blk")
    local = blocked.drop("_near").repartitionById(n, F.col("_blk")).select("*", F.sum("_c").over(w.orderBy("_v").rowsBetween(Window.unboundedPreceding, 0)).alias("_upto"), F.sum("_c").over(w).alias("_here"))
    cond = (F.col("a._blk") == F.col("b._blk")) & (F.col("a._v") <= F.col("b._top"))
    cond = cond & _key_cond("a", "b", group_cols) if group_cols else cond
    j = local.alias("a").join(F.broadcast(parts.alias("b")), cond, "left")
    end = F.coalesce("b._off", F.lit(0)) + F.col("a._upto")
    return j.select(*[F.col(f"a.{g}").alias(g) for g in group_cols], F.col("a._v").alias("_v"), (end - F.col("a._c")).alias("_from"), end.alias("_to"), F.coalesce("b._whole", "a._here").alias("_n"))


def value_at(place: Column) -> Column:
    """Aggregate over ``value_ranks``: the value at a 0-based place (an expression of ``_n``)."""
    return F.max(F.when((F.col("_from") <= place) & (place < F.col("_to")), F.col("_v")))


def kth_values(df: DataFrame, value_col: str, ks: Sequence[int], blocks: int | None = None) -> dict[int, float]:
    """Exact k-th smallest (0-based) non-null values of ``value_col``; places beyond
    the rows are left out."""
    ks = sorted(set(int(k) for k in ks))
    row = value_ranks(df, value_col, blocks=blocks).agg(*[value_at(F.lit(k)).alias(f"k{k}") for k in ks]).first()
    return {k: row[f"k{k}"] for k in ks if row[f"k{k}"] is not None}


def exact_quantiles(df: DataFrame, value_col: str, probs: Sequence[float],
                    group_cols: Sequence[str] = (), blocks: int | None = None) -> DataFrame:
    """Linear-interpolation quantiles (numpy / pandas / ``quantile_cont``
    definition) of non-null ``value_col`` per group: columns group..., p, q.
    One aggregate over ``value_ranks``; without values there is no row."""
    group_cols, probs = list(group_cols), [float(p) for p in probs]
    ranks = value_ranks(df.withColumn("_d", F.col(value_col).cast("double")), "_d", group_cols, blocks)
    aggs = [F.max("_n").alias("_n")]
    for i, p in enumerate(probs):
        h = (F.col("_n") - 1) * F.lit(p)
        low = F.floor(h).cast("bigint")
        aggs += [value_at(low).alias(f"_lo{i}"), value_at(F.least(low + 1, F.col("_n") - 1)).alias(f"_hi{i}")]
    found = ranks.groupBy(*group_cols).agg(*aggs).where(F.col("_n").isNotNull())
    h = [(F.col("_n") - 1) * F.lit(p) for p in probs]
    each = F.explode(F.array(*[F.struct(F.lit(p).alias("p"), (F.col(f"_lo{i}") + (h[i] - F.floor(h[i])) * (F.col(f"_hi{i}") - F.col(f"_lo{i}"))).alias("q")) for i, p in enumerate(probs)]))
    return found.select(*group_cols, each.alias("_e")).select(*group_cols, "_e.p", "_e.q")


def global_index(df: DataFrame, order: Sequence[str], blocks: int | None = None,
                 index_col: str = "_gidx", nulls_last: bool = False) -> DataFrame:
    """Dense 0-based index over ascending ``order`` columns (a total order): one
    exchange by block, and one row per block with the rows before it."""
    order = list(order)
    n = _n_blocks(df, blocks)
    sort = _sort_key(order, nulls_last)
    at = F.struct(*sort)
    blocked = _blocked(df, _bounds(df, at, order, n), at, n)
    earlier = Window.partitionBy(F.lit(0)).orderBy("_blk").rowsBetween(Window.unboundedPreceding, -1)
    offs = blocked.groupBy("_blk").agg(F.count(F.lit(1)).alias("_bn")).select("_blk", F.coalesce(F.sum("_bn").over(earlier), F.lit(0)).alias("_off"))
    w = Window.partitionBy("_blk").orderBy(*sort)
    local = blocked.repartitionById(n, F.col("_blk")).withColumn("_lrank", F.row_number().over(w))
    # One row per block: bounded by the number of blocks.
    return local.join(F.broadcast(offs), "_blk").withColumn(index_col, F.col("_off") + F.col("_lrank") - 1).drop("_blk", "_off", "_lrank")


def dedup_first(df: DataFrame, keys: Sequence[str], order: Sequence[str], keep: str = "first") -> DataFrame:
    """One row per key: the first (or last) under ascending ``order``, NULLs first.
    Ties on ``order`` are broken by the remaining columns, so the result is
    deterministic. The row is the minimum (maximum) of (order, rest) in a partial
    aggregate, so a key with millions of copies leaves each task as one row, and
    rows are sorted by nothing but the key."""
    keys, order = list(keys), list(order)
    rest = [c for c in df.columns if c not in keys and c not in order]
    if not order + rest:
        return df.distinct()
    row = F.struct(*[F.col(f"`{c}`") for c in order + rest])
    best = df.groupBy(*[F.col(f"`{k}`") for k in keys]).agg((F.min if keep == "first" else F.max)(row).alias("_row"))
    return best.select(*[F.col(f"`{c}`") if c in keys else F.col("_row")[c].alias(c) for c in df.columns])


def latest_per_key(df: DataFrame, keys: Sequence[str], seq_col: str) -> DataFrame:
    """Last row per key by ``seq_col``."""
    return dedup_first(df, keys, [seq_col], keep="last")


def batch_ids(df: DataFrame, id_col: str, order: Sequence[str], size: int = 50,
              blocks: int | None = None) -> DataFrame:
    """Number an ordered id list into batches of ``size``: (batch, ids array
    in order, n). Each group holds at most ``size`` ids."""
    idx = global_index(df.select(id_col, *[c for c in df.columns if c != id_col]), order, blocks)
    b = idx.withColumn("batch", F.floor(F.col("_gidx") / size).cast("bigint"))
    g = b.groupBy("batch").agg(F.sort_array(F.collect_list(F.struct("_gidx", id_col))).alias("_s"))
    return g.select("batch", F.col(f"_s.{id_col}").alias("ids"), F.size("_s").alias("n"))

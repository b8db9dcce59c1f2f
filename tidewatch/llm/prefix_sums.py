"""Sums of all earlier rows of a key, for keys of any size.

Rows are range-partitioned on (key, order), so that a hot key is cut into
contiguous blocks of different tasks; a task adds up its own rows as they
come, and a table of one row per block and key carries the sums of the earlier
blocks. No key is ever in one task whole.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from .common import shuffle_partitions, written


def _running(key: str, value: str, schema: pa.Schema):
    def run(batches):
        from pyspark import TaskContext

        part = TaskContext.get().partitionId()
        seen, last, total = 0, None, 0
        for b in batches:
            if not b.num_rows:
                continue
            keys, size = b.column(key).to_pylist(), b.column(value).to_numpy(zero_copy_only=False).astype(np.int64)
            new = np.array([i == 0 or keys[i] != keys[i - 1] for i in range(len(keys))])
            new[0] = not seen or keys[0] != last
            after = np.cumsum(size) + (0 if new[0] else total)
            begin = np.maximum.accumulate(np.where(new, np.arange(len(new)), 0))
            base = np.where(begin > 0, after[begin] - size[begin], 0) if len(new) else after
            base[begin == 0] = 0
            after = after - base
            last, total = keys[-1], int(after[-1])
            more = {"block": pa.array(np.full(len(size), part, np.int32)), "row_no": pa.array((part << 33) + seen + np.arange(len(size), dtype=np.int64)), "before": pa.array(after - size)}
            seen += len(size)
            yield pa.RecordBatch.from_arrays([more[f.name] if f.name in more else b.column(f.name) for f in schema], schema=schema)

    return run


def running_sum(df: DataFrame, key: str, order: Sequence[Column], value: str, name: str) -> tuple[DataFrame, DataFrame]:
    """``df`` with ``block``, ``row_no`` (unique) and ``before``: the sum of the
    long ``value`` over earlier rows of the same block and key; and the blocks:
    block, key, ``here`` (the block's sum) and ``earlier`` (the sum of the key's
    earlier blocks). A row's whole prefix sum is ``earlier + before``.

    Both are written tables. Rows that tie on (key, order) come in any order."""
    n = shuffle_partitions(df.sparkSession)
    by = [F.col(key).asc_nulls_first(), *order]
    kind = T.StructType(df.schema.fields + T.StructType.fromDDL("block int, row_no long, before long").fields)
    placed = df.repartitionByRange(n, *by).sortWithinPartitions(*by).mapInArrow(_running(key, value, to_arrow_schema(kind)), kind)
    placed = written(placed, f"{name}-placed")
    w = Window.partitionBy(key).orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    blocks = placed.groupBy("block", key).agg(F.sum(value).alias("here"))
    return placed, written(blocks.withColumn("earlier", F.coalesce(F.sum("here").over(w), F.lit(0))), f"{name}-blocks")

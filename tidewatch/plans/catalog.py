"""Registry of the queries exposed through ``__spark_entry__``.

Each entry is a Spark job over the driver's tables (via the bindings) plus,
where the result is SQL-expressible, the DuckDB SQL computing the same frame.
Timestamps leave as ``timestamp_ntz`` so both engines print the same values.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import configure

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def ntz_out(df: DataFrame) -> DataFrame:
    """Cast timestamp (and date) columns to timestamp_ntz (UTC wall time) so
    both engines hand the same type to the comparison."""
    cols = []
    for f in df.schema.fields:
        if isinstance(f.dataType, (T.TimestampType, T.DateType)):
            cols.append(F.col(f.name).cast("timestamp_ntz").alias(f.name))
        else:
            cols.append(F.col(f.name))
    return df.select(*cols)


def register(name: str, sql: str | None = None):
    def deco(fn: Callable[[SparkSession, str], DataFrame]):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            configure(spark)
            return ntz_out(fn(spark, sf_dir))
        run.__name__ = f"q_{name}"
        run.__doc__ = fn.__doc__
        QUERIES[name] = run
        if sql is not None:
            ORACLE[name] = sql
        return fn
    return deco


# Query modules register themselves on import.
from . import queries_core, queries_eda, queries_io, queries_model, queries_ops, queries_scoring, queries_stream  # noqa: E402,F401,E501

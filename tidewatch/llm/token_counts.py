"""Token counts through a digest cache.

A count is stored under two digests: SHA-256 of the tokenizer version
(vocabulary file, library and its version) and SHA-256 of the normalised
content (null reads as empty; nothing else is changed, as any change could
change the count). A run joins the documents' digests with the cache, encodes
the distinct misses, one text per digest, appends their counts, and takes every
document's count from the cache.

* The cache is a Parquet folder partitioned by tokenizer version. Appends are
  committed per task; rows that a repeated run appended twice are read once.
* A digest's copies are folded inside each input task before the shuffle, so a
  text that a third of all rows share reaches it once per task.
* Documents find their counts by a plain join on the digest with nothing but
  ids and digests moved, which the engine splits when a digest is hot.

Null and empty texts have no tokens. Repeated rows each get their count. An
empty table gives an empty result and appends nothing.
"""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import exists, scratch_path
from .common import whole_text
from .encoding import Vocabulary, tokenizer

CACHE_SCHEMA = "digest binary, n_tokens long"
SLICE = 256


def _encode(vocabulary):
    def run(batches):
        t = tokenizer(vocabulary.value)
        for batch in batches:
            for at in range(0, batch.num_rows, SLICE):
                part = batch.slice(at, SLICE)
                counts = [len(t.encode(x)) for x in part.column("text").to_pylist()]
                yield pa.RecordBatch.from_arrays([part.column("digest"), pa.array(counts, pa.int64())], names=["digest", "n_tokens"])

    return run


def cached(spark, path: str, version: str) -> DataFrame:
    """Digest and count of what the cache holds for a tokenizer version."""
    at = f"{path}/version={version}"
    if not exists(spark, at):
        return spark.createDataFrame([], CACHE_SCHEMA)
    return spark.read.schema(CACHE_SCHEMA).parquet(at)


def count_tokens(docs: DataFrame, vocabulary: Vocabulary, *, id_col: str = "doc_id", text_col: str = "text", cache: str | None = None, window: int = 1024) -> DataFrame:
    """Per row: id, n_bytes (UTF-8), n_tokens, over_limit (n_tokens > window).

    ``cache``: folder of the digest cache, kept between runs; without one, a
    new folder below the shared checkpoint folder."""
    spark = docs.sparkSession
    cache = cache or scratch_path(spark, "token-counts")
    at = f"{cache}/version={vocabulary.version}"
    src = docs.select(F.col(id_col).alias("id"), whole_text(text_col).alias("text"))
    src = src.withColumn("digest", F.unhex(F.sha2(F.col("text").cast("binary"), 256)))

    distinct = src.select("digest", "text").dropDuplicates(["digest"])
    known = cached(spark, cache, vocabulary.version).select("digest")
    misses = distinct.join(known, "digest", "left_anti") if exists(spark, at) else distinct
    file = spark.sparkContext.broadcast(vocabulary)
    misses.mapInArrow(_encode(file), CACHE_SCHEMA).write.mode("append").parquet(at)

    # The cache holds a digest twice when a run was repeated, or two runs appended it.
    counts = cached(spark, cache, vocabulary.version)
    stored = counts.groupBy("digest").agg(F.max("n_tokens").alias("n_tokens"))
    rows = src.select("id", F.octet_length("text").cast("long").alias("n_bytes"), "digest")
    return rows.join(stored, "digest").select(F.col("id").alias(id_col), "n_bytes", "n_tokens", (F.col("n_tokens") > window).alias("over_limit"))

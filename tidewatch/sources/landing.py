"""Landing-zone sources (S1-S4, S6, S7, S9) and the B4 landing fixture writer.

Landing files hold JSON arrays of nested API items: either one array per file
(``multi_line=True``) or one array per line (line mode, splittable). Both are
read with an explicit schema in PERMISSIVE mode; unreadable text lands in
``_corrupt_record`` and is split off (S3) instead of failing the job.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import schemas as SC
from ..functions import scalar as S
from ..operators.ordering import dedup_first, global_index
from ..session import exists, saved

ITEM_ORDER = "_item_order"   # place of an item: file, block, page, position in the page


def read_landing(spark: SparkSession, path: str, schema, multi_line: bool = False, ordered: bool = False) -> DataFrame:
    """Raw items of every landing file under ``path``, with ``_source_file``
    and ``_corrupt_record`` (the text of a page/file that is not a JSON array
    of items; its item columns are NULL).

    Pages are read as text and parsed with ``from_json`` against an explicit
    array schema: one page per line, or one page per file (``multi_line``). They
    are parsed once, into a Parquet table in the shared folder, as the split of
    corrupt files asks for the items twice. A missing folder holds no items.
    ``ordered`` keeps each item's place.
    """
    if not exists(spark, path):
        none = spark.createDataFrame([], "value string, _source_file string, _block long")
        return parse_pages(none, schema) if ordered else parse_pages(none, schema).drop(ITEM_ORDER)
    txt = (spark.read.option("wholetext", multi_line).option("recursiveFileLookup", True).text(path)
           .select("value", F.col("_metadata.file_path").alias("_source_file"),
                   F.col("_metadata.file_block_start").alias("_block")))
    items = parse_pages(txt, schema)
    return saved(items if ordered else items.drop(ITEM_ORDER), "landing-items")


def parse_pages(pages: DataFrame, schema: T.StructType) -> DataFrame:
    """Items of pages (value, _source_file, _block), parsed once: the item's fields,
    the text of a page that is no array of items, the file, and the item's
    place (file, block, page, position). An empty page has no row."""
    parsed = pages.where(F.length(F.trim("value")) > 0).select(
        "value", "_source_file", F.struct(F.col("_source_file").alias("f"), F.col("_block").alias("b"),
                                          F.monotonically_increasing_id().alias("i")).alias("_page"),
        F.from_json("value", T.ArrayType(schema), {"mode": "PERMISSIVE"}).alias("_items"))
    # Empty pages go after the items are taken apart: a filter on the parsed array would be
    # pushed below it and parse each page again.
    one = parsed.select("_source_file", "_page", F.when(F.col("_items").isNull(), F.col("value")).alias(SC.CORRUPT_COL),
                        F.posexplode_outer("_items").alias("_pos", "_item"))
    one = one.where(F.col("_pos").isNotNull() | F.col(SC.CORRUPT_COL).isNotNull())
    return one.select(*[F.col(f"_item.{f.name}").alias(f.name) for f in schema.fields], SC.CORRUPT_COL, "_source_file",
                      F.struct("_page.*", F.col("_pos").alias("p")).alias(ITEM_ORDER))


def split_corrupt(raw: DataFrame):
    """S3: (good rows, corrupt rows with their file). A corrupt file is skipped
    whole by dropping every row that came from it. ``raw`` is a written table
    (``read_landing``), of which the corrupt rows' two columns are read first."""
    bad = raw.where(F.col(SC.CORRUPT_COL).isNotNull())
    bad_files = bad.select("_source_file").distinct()
    good = raw.join(bad_files, "_source_file", "left_anti")
    return good, bad.select("_source_file", SC.CORRUPT_COL)


def numbered_files(good: DataFrame, items: DataFrame) -> DataFrame:
    """``good`` with the file's number in path order among ``items`` for its path in
    ``ITEM_ORDER``: the same order, without a path in every row that is sorted and sent."""
    files = saved(items.select("_source_file").distinct(), "landing-files")   # a row per file
    files = F.broadcast(saved(global_index(files, ["_source_file"], index_col="_file"), "landing-files"))
    place = F.struct(F.col("_file").alias("f"), *[F.col(f"{ITEM_ORDER}.{c}").alias(c) for c in ("b", "i", "p")])
    return good.join(files, "_source_file").withColumn(ITEM_ORDER, place).drop("_file")


def read_channels_json(spark: SparkSession, path: str, multi_line: bool = False) -> DataFrame:
    """S1 (cleaning projection): id, title, three counters as text->double, hidden flag."""
    raw, _ = split_corrupt(read_landing(spark, path, SC.CHANNEL_ITEM, multi_line))
    return flatten_channels(raw)


def flatten_channels(raw: DataFrame) -> DataFrame:
    return raw.select(
        S.text_or_empty("id").alias("channel_id"),
        F.col("snippet.title").alias("title"),
        S.cast_numeric("statistics.subscriberCount").alias("subscriber_count"),
        S.cast_numeric("statistics.viewCount").alias("view_count_total"),
        S.cast_numeric("statistics.videoCount").alias("video_count"),
        S.safe_bool("statistics.hiddenSubscriberCount").alias("hidden_subscriber"),
    )


def channel_dim_and_snapshots(raw: DataFrame, as_of, fetched_at: Column | None = None, *also: str):
    """One item -> a dimension row and a dated snapshot row (two selects of
    one parsed frame); ``also`` names columns of ``raw`` to carry along."""
    fetched = fetched_at if fetched_at is not None else S.ts_lit(as_of)
    dim = raw.select(
        S.text_or_empty("id").alias("channel_id"),
        F.coalesce(F.col("snippet.title"), F.lit("")).alias("title"),
        F.col("snippet.description").alias("description"),
        F.col("snippet.country").alias("country"),
        S.parse_ts("snippet.publishedAt").alias("published_at"),
        F.col("contentDetails.relatedPlaylists.uploads").alias("uploads_playlist_id"),
        fetched.alias("fetched_at"),
        *also,
    )
    snap = raw.select(
        S.text_or_empty("id").alias("channel_id"),
        S.ts_lit(as_of).cast("date").alias("snapshot_date"),
        S.safe_int("statistics.subscriberCount").alias("subscriber_count"),
        S.safe_bool("statistics.hiddenSubscriberCount").alias("subscriber_hidden"),
        S.safe_int("statistics.viewCount").alias("view_count_total"),
        S.safe_int("statistics.videoCount").alias("video_count"),
        *also,
    )
    return dim, snap


def read_videos_json(spark: SparkSession, path: str, multi_line: bool = False) -> DataFrame:
    """Flat video rows (P4, P5, P6, P7 applied)."""
    raw, _ = split_corrupt(read_landing(spark, path, SC.VIDEO_ITEM, multi_line))
    return flatten_videos(raw)


def flatten_videos(raw: DataFrame, *also: str) -> DataFrame:
    """Flat video rows; ``also`` names columns of ``raw`` to carry along."""
    st = F.col("statistics")
    return raw.select(
        S.text_or_empty("id").alias("video_id"),
        S.text_or_empty("snippet.channelId").alias("channel_id"),
        S.parse_ts("snippet.publishedAt").alias("published_at"),
        S.safe_int(st.getItem("viewCount")).alias("view_count"),
        S.safe_int(st.getItem("likeCount")).alias("like_count"),
        S.safe_int(st.getItem("commentCount")).alias("comment_count"),
        S.key_absent(st, "commentCount").alias("comments_disabled"),
        S.iso8601_duration_seconds("contentDetails.duration").alias("duration_seconds"),
        *also,
    )


def read_table(spark: SparkSession, path: str, schema=None, missing: str = "empty") -> DataFrame:
    """Parquet table. A missing path gives an empty frame of ``schema``
    (``missing='empty'``) or raises (``missing='error'``)."""
    if not exists(spark, path):
        if missing == "error" or schema is None:
            raise FileNotFoundError(path)
        return spark.createDataFrame([], schema)
    r = spark.read.schema(schema) if schema is not None else spark.read
    return r.parquet(path)


def with_file_order(df: DataFrame, col: str = "_ordinal") -> DataFrame:
    """Position of each row in its source files (file path, split start, row
    within split), for 'first n' / 'last row wins' rules on CSV inputs."""
    return df.withColumn(col, F.struct(F.col("_metadata.file_path").alias("f"),
                                       F.col("_metadata.file_block_start").alias("b"),
                                       F.monotonically_increasing_id().alias("i")))


def read_seed_csv(spark: SparkSession, path: str, n: int | None = None) -> DataFrame:
    """Seed ids (channel_id, name, niche) with header, first ``n`` in file order."""
    df = with_file_order(spark.read.option("header", True).schema(SC.SEED).csv(path))
    if n is not None:
        df = df.orderBy("_ordinal").limit(int(n))
    return df


def read_manifest(spark: SparkSession, path: str) -> DataFrame:
    """Manifest rows, last row per (channel_id, stage) in file order. A
    file without the expected header raises."""
    if not manifest_header_ok(spark, path):
        raise ValueError(f"{path} has no manifest header")
    df = with_file_order(spark.read.option("header", True).schema(SC.MANIFEST).csv(path))
    return dedup_first(df, ["channel_id", "stage"], ["_ordinal"], keep="last").drop("_ordinal")


def manifest_header_ok(spark: SparkSession, path: str) -> bool:
    """S7 header check: the first line of the manifest equals the expected header."""
    heads = spark.read.text(path).where((F.col("_metadata.file_block_start") == 0) & (F.trim("value") == ",".join(SC.MANIFEST_HEADER)))
    return not heads.isEmpty()


def read_previous_report(spark: SparkSession, path: str) -> DataFrame:
    """At-Risk ids of a previous report CSV; a missing file -> empty."""
    if not exists(spark, path):
        return spark.createDataFrame([], "channel_id string, risk_flag string")
    df = spark.read.option("header", True).schema(SC.REPORT_CSV).csv(path)
    return df.where(F.col("risk_flag") == "At-Risk").select("channel_id", "risk_flag")


def register_views(spark: SparkSession, tables: dict[str, DataFrame]) -> list[str]:
    """Named SQL views over frames (parquet scans keep their pushdown)."""
    for name, df in tables.items():
        df.createOrReplaceTempView(name)
    return sorted(tables)

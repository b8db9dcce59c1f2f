"""Exact deduplication by Grace hashing.

Records are dealt by a hash of their normalised content to spill files in the
shared folder until each bucket fits an open-addressing table (a Python dict
keyed by the content, so that every probe compares the complete content).

* Before the first deal, each input task folds its own copies in such a table,
  and hands its groups on and starts afresh when it is full, so a text that
  makes up a third of all rows reaches the shuffle once per table, not once per
  row. A record's other columns count towards the room of a table.
* A bucket's table takes contents until ``table_bytes`` is reached. Copies of
  contents it holds are still folded in; contents it has no room for go to the
  next level, where they are dealt again under another seed. Each level
  settles up to ``table_bytes`` per bucket, so the recursion ends whatever the
  skew, and no task holds more than one table.

Normalisation lower-cases A-Z only. Nulls count as the empty text. Of equal
texts the row with the largest id stays; a null id is smaller than any other.
Rows that share id and text are one document listed twice: ``decisions`` marks
each of them alike, ``deduplicate`` returns exactly one of them.
An empty table gives an empty result.
"""

from __future__ import annotations

import hashlib

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pyspark.sql.pandas.types import to_arrow_schema

from .common import lower_ascii, shuffle_partitions, text_bytes, whole_text, written

TABLE_BYTES = 192 << 20
_FOLD = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))


def normalise(text: bytes) -> bytes:
    return text.translate(_FOLD)


def _key(digest: bytes, level: int) -> int:
    """Deal of a level: eight bytes of the digest under the level's seed."""
    return int.from_bytes(hashlib.blake2b(digest, digest_size=8, salt=level.to_bytes(4, "big")).digest(), "big", signed=True)


class _Table:
    """Open-addressing table content -> [kept record, its id, rows]."""

    def __init__(self, room: int):
        self.room, self.groups = room, {}

    def add(self, content: bytes, ident, rows: int, record, size: int) -> bool:
        """``size``: bytes of the record. False: no room for a new content."""
        g = self.groups.get(content)
        if g is None:
            if self.room <= 0 and self.groups:
                return False
            self.room -= 2 * len(content) + size + 200
            self.groups[content] = [record, ident, rows]
        else:
            if g[1] is None or ident is not None and ident > g[1]:
                g[0], g[1] = record, ident
            g[2] += rows
        return True


def _schema(row_type: pa.DataType, id_type: pa.DataType) -> pa.Schema:
    return pa.schema([("deal", pa.int64()), ("settled", pa.bool_()), ("digest", pa.binary()), ("text", pa.string()), ("id", id_type), ("rows", pa.int64()), ("row", row_type)])


class _Out:
    """Rows gathered into Arrow batches of a few megabytes."""

    def __init__(self, schema: pa.Schema):
        self.schema, self.rows, self.size = schema, [], 0

    def add(self, row: tuple, size: int) -> bool:
        self.rows.append(row)
        self.size += size + 64
        return self.size > 4 << 20

    def batch(self) -> pa.RecordBatch:
        cols, self.rows, self.size = list(zip(*self.rows)), [], 0
        return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(cols, self.schema)], schema=self.schema)


def _fold(level: int, room: int, last: bool, row_type: pa.DataType, id_type: pa.DataType):
    """Task: fold rows into a table; emit its groups, and what found no room.

    ``last``: all rows of a content meet in this task, so its groups are settled."""

    def run(batches):
        table, out = _Table(room), _Out(_schema(row_type, id_type))

        def emptied():
            while table.groups:
                content, ((text, record), ident, rows) = table.groups.popitem()
                digest = hashlib.sha256(content).digest()
                if out.add((_key(digest, level), last, digest, text, ident, rows, record), len(content)):
                    yield out.batch()

        for batch in batches:
            texts = batch.column("text").cast(pa.binary()).to_pylist()
            ids, records = batch.column("id").to_pylist(), batch.column("row").to_pylist()
            counts = batch.column("rows").to_pylist() if "rows" in batch.schema.names else [1] * len(texts)
            size = 4 * (batch.column("row").nbytes + batch.column("id").nbytes) // max(1, batch.num_rows)  # as Python objects, roughly
            for text, ident, rows, record in zip(texts, ids, counts, records):
                content = normalise(text or b"")
                if table.add(content, ident, rows, (text, record), size):
                    continue
                if not last:  # full: hand on what there is, so copies go on being folded at any place of the input
                    yield from emptied()
                    table.room = room
                    table.add(content, ident, rows, (text, record), size)
                    continue
                digest = hashlib.sha256(content).digest()
                if out.add((_key(digest, level + 1), False, digest, text, ident, rows, record), len(content)):
                    yield out.batch()
        yield from emptied()
        if out.rows:
            yield out.batch()

    return run


def groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", *, table_bytes: int = TABLE_BYTES, keep_rows: bool = True) -> DataFrame:
    """One row per distinct normalised text: digest, id (largest), rows (how
    many), and with ``keep_rows`` the text and the other columns (struct
    ``row``) of the input row that stays."""
    spark = docs.sparkSession
    others = [c for c in docs.columns if keep_rows and c != text_col]
    row = F.struct(*[F.col(f"`{c}`") for c in others]) if others else F.struct(F.lit(0).alias("none"))
    df = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"), row.alias("row"))
    spark_type = f"deal long, settled boolean, digest binary, text string, id {df.schema['id'].dataType.simpleString()}, rows long, row {df.schema['row'].dataType.simpleString()}"
    arrow = to_arrow_schema(df.schema)
    row_type, id_type = arrow.field("row").type, arrow.field("id").type
    parts = shuffle_partitions(spark, rows=text_bytes(docs, text_col), rows_per_task=max(1, table_bytes // 4))
    todo, level, settled = df.mapInArrow(_fold(0, table_bytes // 4, False, row_type, id_type), spark_type), 0, None
    while True:
        dealt = todo.drop("settled").repartition(parts, "deal")
        done = dealt.mapInArrow(_fold(level, table_bytes, True, row_type, id_type), spark_type)
        done = written(done if keep_rows else done.withColumn("text", F.when(~F.col("settled"), F.col("text"))), f"dedup-level{level}")
        out = done.where("settled").select("digest", "id", "rows", *(["text", "row"] if keep_rows else []))
        settled = out if settled is None else settled.unionAll(out)
        todo, level = done.where("NOT settled"), level + 1
        if todo.isEmpty():
            return settled


def decisions(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", *, table_bytes: int = TABLE_BYTES) -> DataFrame:
    """A row per input row: id, keep_id, group_size, kept, text_sha256.

    The groups come from the tables, which compare complete contents; a
    document finds its group by the content's SHA-256. That two contents of
    one SHA-256 can't pass unnoticed is checked: their digest would settle
    twice."""
    found = groups(docs, id_col, text_col, table_bytes=table_bytes, keep_rows=False)
    found = found.select("digest", F.col("id").alias("keep_id"), F.col("rows").alias("group_size"))
    one = found.groupBy("digest").agg(F.count(F.lit(1)).alias("contents")).where("contents > 1")
    if not one.isEmpty():
        raise ValueError("two different contents share a SHA-256 digest")
    own = docs.select(F.col(id_col).alias("id"), F.unhex(F.sha2(lower_ascii(whole_text(text_col)).cast("binary"), 256)).alias("digest"))
    return own.join(found, "digest").select(
        F.col("id").alias(id_col), "keep_id", "group_size", F.col("id").eqNullSafe(F.col("keep_id")).alias("kept"), F.lower(F.hex("digest")).alias("text_sha256"))


def deduplicate(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", *, table_bytes: int = TABLE_BYTES) -> DataFrame:
    """The rows that stay, one per distinct normalised text, with the input's columns."""
    found = groups(docs, id_col, text_col, table_bytes=table_bytes)
    return found.select(*[F.col("text").alias(c) if c == text_col else F.col(f"row.`{c}`") for c in docs.columns])

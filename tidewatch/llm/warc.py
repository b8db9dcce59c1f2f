"""WARC archives with revisit records.

``archive`` writes one record per page, ``read_records`` reads archives back
and ``resolve`` joins revisit records to their original responses.

* Headers only (page, URL, payload digest) are shuffled by payload digest. Of
  equal payloads of at least ``min_bytes`` bytes the one with the smallest page
  id becomes a ``response`` record with the payload; the others become
  ``revisit`` records with fresh headers that refer to it and no payload.
  Smaller payloads are all responses. The payload moves once per task and
  digest at most: the smallest page of a digest is picked by a partial
  aggregate before the shuffle, so a payload that a third of all pages share
  does not meet in one task.
* A file is a ``warcinfo`` record and then page records, one gzip member each, so
  any record can be read from its offset. It ends at ``records_per_file`` records
  or with the record that takes it to ``file_bytes`` compressed bytes, so a task
  holds one file and one record at most. Page records hold an HTTP message: a
  fresh status line and headers, and in responses the payload.
* Spark's text writer puts the files in place, committed per task, one row each.
  It closes a row with ``lineSep``, which is the zero byte that the size of a
  member below 16 MiB ends with; a larger last member is followed by an empty one.
* Reading inflates each file in pieces in the task that holds it and parses it by
  Content-Length, one record at a time; payload digest and length are those of the
  bytes read, not of the header. Files of other writers, with several records in a
  member, without gzip or without HTTP messages, are read as well (a record id that
  names no page is null).

Null payloads are empty, a null URL has no WARC-Target-URI, a null page id is
larger than any other. Pages that repeat id and payload are records of their
own: one response, the rest revisits to the same id. Record ids are distinct,
also where pages repeat their id. No pages: no archive, no rows.

A page must fit a task's memory several times: Spark's Parquet reader loads a
batch of pages before any of this runs (``spark.sql.parquet.columnarReaderBatchSize``).
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import exists, scratch_path
from .common import written

MIN_BYTES = 100
RECORDS_PER_FILE = 65536
FILE_BYTES = 32 << 20  # compressed
DATE = "2000-01-01T00:00:00Z"  # of the records; the given pages carry no capture time
RECORD_TYPES = ("response", "revisit")
PIECE = 1 << 14  # bytes of a file inflated at a time
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


def _record(kind: str, page, url, digest, payload, refers_to, extra):
    """One WARC record as text, with the two line ends that close it. ``digest`` and
    ``extra`` tell records of one page id apart."""
    urn = lambda p, e: F.concat(F.lit("<urn:page:"), F.coalesce(p.cast("string"), F.lit("null")), F.lit(":"), digest, F.lit(":"), e.cast("string"), F.lit(">"))
    http = F.concat(F.lit("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n"), *([F.lit("Content-Length: "), F.octet_length(payload).cast("string"), F.lit("\r\n")] if kind == "response" else []), F.lit("\r\n"))
    header = [
        F.lit("WARC/1.1"),
        F.lit(f"WARC-Type: {kind}"),
        F.concat(F.lit("WARC-Record-ID: "), urn(page, extra)),
        F.lit(f"WARC-Date: {DATE}"),
        F.concat(F.lit("WARC-Target-URI: "), F.regexp_replace(url, r"[\r\n]", "")),
        F.concat(F.lit("WARC-Payload-Digest: sha256:"), digest),
        F.concat(F.lit("WARC-Refers-To: "), urn(refers_to, F.lit(0))) if kind == "revisit" else F.lit(None).cast("string"),
        F.lit(f"WARC-Profile: {PROFILE}") if kind == "revisit" else F.lit(None).cast("string"),
        F.lit("Content-Type: application/http; msgtype=response"),
        F.concat(F.lit("Content-Length: "), (F.octet_length(http) + F.octet_length(payload)).cast("string")),
    ]
    return F.concat(F.concat_ws("\r\n", *header), F.lit("\r\n\r\n"), http, payload, F.lit("\r\n\r\n")).cast("binary").alias("value")


def _member(data: bytes) -> bytes:
    step = zlib.compressobj(6, zlib.DEFLATED, 31)
    return step.compress(data) + step.flush()


def _info(first: bytes) -> bytes:
    """The ``warcinfo`` record of the file that starts with the page record ``first``."""
    fields = b"software: tidewatch\r\nformat: WARC File Format 1.1\r\n"
    head = f"WARC/1.1\r\nWARC-Type: warcinfo\r\nWARC-Record-ID: <urn:sha256:{hashlib.sha256(first).hexdigest()}>\r\nWARC-Date: {DATE}\r\nContent-Type: application/warc-fields\r\nContent-Length: {len(fields)}\r\n\r\n"
    return _member(head.encode() + fields + b"\r\n\r\n")


def _files(records_per_file: int, file_bytes: int):
    """Records -> rows of whole files, less the zero byte that ends each."""
    def run(batches):
        file, n = bytearray(), 0

        def close() -> pa.RecordBatch:
            nonlocal file, n
            if file[-1]:
                file += _member(b"")
            del file[-1:]
            row = pa.RecordBatch.from_arrays([pa.array([bytes(file)], pa.binary())], names=["file"])
            file, n = bytearray(), 0
            return row

        for batch in batches:
            for value in batch.column(0):
                record = value.as_py()
                if not n:
                    file += _info(record)
                file += _member(record)
                n += 1
                if n >= records_per_file or len(file) >= file_bytes:
                    yield close()
        if n:
            yield close()

    return run


def _write(records: DataFrame, path: str, records_per_file: int, file_bytes: int) -> None:
    files = records.mapInArrow(_files(records_per_file, file_bytes), "file binary").select(F.col("file").cast("string").alias("value"))
    files.write.option("lineSep", "\0").option("compression", "none").option("maxRecordsPerFile", 1).text(path)


def archive(pages: DataFrame, path: str, id_col: str = "page_id", url_col: str = "url", payload_col: str = "html", *, min_bytes: int = MIN_BYTES, records_per_file: int = RECORDS_PER_FILE, file_bytes: int = FILE_BYTES) -> None:
    """Write the pages to WARC files below ``path``: folder ``responses``, then ``revisits``."""
    payload = F.coalesce(F.col(payload_col).cast("string"), F.lit(""))
    src = pages.select(F.col(id_col).cast("long").alias("page"), F.col(url_col).cast("string").alias("url"), payload.alias("payload"))
    src = src.withColumns({"digest": F.sha2(F.col("payload").cast("binary"), 256), "big": F.octet_length("payload") >= min_bytes})
    first = src.where("big").groupBy("digest").agg(F.min(F.struct(F.col("page").isNull().alias("no_page"), "page", "url", "payload")).alias("r")).select("digest", "r.page", "r.url", "r.payload")
    none = F.lit(None).cast("long")
    full = lambda df, extra: df.select(_record("response", F.col("page"), F.col("url"), F.col("digest"), F.col("payload"), none, extra))
    _write(full(first, F.lit(0)).unionAll(full(src.where("NOT big"), F.monotonically_increasing_id())), f"{path}/responses", records_per_file, file_bytes)

    # Revisits: headers join the responses as the archive has them.
    heads = src.where("big").groupBy("digest", "page").agg(F.count(F.lit(1)).alias("n"), F.min("url").alias("url"))
    heads = written(heads, "warc-headers")
    original = written(read_records(pages.sparkSession, f"{path}/responses").where(F.col("payload_bytes") >= min_bytes).select(F.col("payload_digest").alias("digest"), F.col("page").alias("refers_to")), "warc-originals")
    rest = heads.join(original, "digest").withColumn("n", F.col("n") - F.col("page").eqNullSafe(F.col("refers_to")).cast("long")).where("n > 0")
    rest = rest.withColumn("copy", F.explode(F.sequence(F.lit(1), F.col("n").cast("int"))))
    _write(rest.select(_record("revisit", F.col("page"), F.col("url"), F.col("digest"), F.lit(""), F.col("refers_to"), F.col("copy"))), f"{path}/revisits", records_per_file, file_bytes)


def _inflated(content: bytes) -> Iterator[bytes]:
    """The file's bytes in pieces, out of its gzip members if it has any."""
    if content[:2] != b"\x1f\x8b":
        yield from (content[at:at + PIECE] for at in range(0, len(content), PIECE))
        return
    at, step = 0, zlib.decompressobj(31)
    while at < len(content):
        piece = content[at:at + PIECE]
        yield step.decompress(piece)
        at += len(piece) - len(step.unused_data)
        if step.eof:
            step = zlib.decompressobj(31)


def _parse(content: bytes) -> Iterator[tuple[dict[str, str], bytes]]:
    """(headers, block) of each record of a WARC file, gzipped or not."""
    pieces, buffer, at = _inflated(content), bytearray(), 0
    while True:
        seen = at
        while (head := buffer.find(b"\r\n\r\n", seen)) < 0:
            seen = max(at, len(buffer) - 3)
            if (piece := next(pieces, None)) is None:
                if buffer[at:].strip():
                    raise ValueError("WARC file ends inside a record's headers")
                return
            buffer += piece
        fields = {}
        for line in buffer[at:head].decode("utf-8").split("\r\n")[1:]:
            name, _, value = line.partition(":")
            fields[name.strip().lower()] = value.strip()
        end = head + 4 + int(fields["content-length"])
        while len(buffer) < end + 4:
            if (piece := next(pieces, None)) is None:
                raise ValueError("WARC file ends inside a record")
            buffer += piece
        yield fields, bytes(memoryview(buffer)[head + 4:end])
        at = end + 4
        if at > PIECE:
            del buffer[:at]
            at = 0


def _payload(fields: dict[str, str], block: bytes) -> bytes:
    """What follows the HTTP headers; the whole block if it is no HTTP message."""
    if not fields.get("content-type", "").startswith("application/http"):
        return block
    end = block.find(b"\r\n\r\n")
    return b"" if end < 0 else block[end + 4:]


_RECORD = pa.schema([("page", pa.int64()), ("record_type", pa.string()), ("payload_bytes", pa.int64()), ("payload_digest", pa.string()), ("stated_digest", pa.string()), ("refers_to", pa.int64()), ("url", pa.string()), ("payload", pa.string())])


def _page(urn: str | None):
    if urn is None or not urn.startswith("<urn:page:"):
        return None
    ident = urn.strip("<>").split(":")[2]
    return None if ident == "null" else int(ident)


def _records(with_payload: bool):
    schema = _RECORD if with_payload else pa.schema(list(_RECORD)[:-1])

    def run(batches):
        for batch in batches:
            for content in batch.column("content"):
                rows, size = [], 0
                for head, block in _parse(content.as_py()):
                    if head.get("warc-type") not in RECORD_TYPES:
                        continue
                    payload = _payload(head, block)
                    rows.append((_page(head.get("warc-record-id")), head.get("warc-type"), len(payload), hashlib.sha256(payload).hexdigest(), head.get("warc-payload-digest", "").removeprefix("sha256:"), _page(head.get("warc-refers-to")), head.get("warc-target-uri"), payload))
                    size += len(payload) if with_payload else 0
                    if size > 4 << 20 or len(rows) >= 8192:
                        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), schema)], schema=schema)
                        rows, size = [], 0
                if rows:
                    yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), schema)], schema=schema)

    return run


def read_records(spark: SparkSession, *paths: str, with_payload: bool = False) -> DataFrame:
    """A row per record of the WARC files in the given folders."""
    kind = "page long, record_type string, payload_bytes long, payload_digest string, stated_digest string, refers_to long, url string" + ", payload string" * with_payload
    files = spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(list(paths)).select("content")
    return files.mapInArrow(_records(with_payload), kind)


def resolve(records: DataFrame) -> DataFrame:
    """Records with the payload size and digest of the full payload: a revisit
    record joins the response that has its stated digest."""
    response, revisit = records.where("record_type = 'response'"), records.where("record_type = 'revisit'")
    wrong = F.when(F.col("payload_digest") != F.col("stated_digest"), F.raise_error(F.concat(F.lit("payload of page "), F.col("page").cast("string"), F.lit(" is not the one written"))))
    original = response.select(F.col("page").alias("refers_to"), F.col("payload_digest").alias("stated_digest"), F.col("payload_bytes").alias("full_bytes"))
    own = response.select("page", "payload_bytes", F.coalesce(wrong.cast("string"), F.col("payload_digest")).alias("payload_digest"), "record_type", F.lit(None).cast("long").alias("refers_to"))
    # Equal small payloads are responses of their own: page and digest together name one.
    found = revisit.select("page", "record_type", "stated_digest", "refers_to", F.col("refers_to").isNull().alias("no_page")).join(
        original.withColumn("no_page", F.col("refers_to").isNull()).withColumnRenamed("refers_to", "to"), "stated_digest").where(F.col("refers_to").eqNullSafe(F.col("to")))
    return own.unionAll(found.select("page", F.col("full_bytes").alias("payload_bytes"), F.col("stated_digest").alias("payload_digest"), "record_type", "refers_to"))


def round_trip(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", payload_col: str = "html", *, path: str | None = None, min_bytes: int = MIN_BYTES, records_per_file: int = RECORDS_PER_FILE, file_bytes: int = FILE_BYTES) -> DataFrame:
    """Write the archives (below ``path``, else in the shared folder), read them back, resolve."""
    spark = pages.sparkSession
    path = path or scratch_path(spark, "warc")
    if exists(spark, path):
        raise FileExistsError(path)
    archive(pages, path, id_col, url_col, payload_col, min_bytes=min_bytes, records_per_file=records_per_file, file_bytes=file_bytes)
    records = written(read_records(spark, f"{path}/responses", f"{path}/revisits"), "warc-records")
    return resolve(records)

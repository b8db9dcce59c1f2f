"""Benchmark decontamination by a broadcast hash set of test n-grams.

The items' normalised words give windows of ``n`` consecutive words; an item
with fewer words, but not none, is one window. Their hashes are broadcast, and
every document's whole text is scanned in one pass: rolling window hashes are
looked up in the set, and each hit is verified on the words themselves.

The broadcast is bounded: a block holds distinct chunks of items of ``block_words``
words and eighths of bytes together, and one chunk more at most (a word that is
longer than all of that comes alone with its chunk). Blocks
are scanned one after the other over all documents, each pass adding its hits to
the row, with a written table between passes, so neither driver nor
executors ever hold more than one block.

A document word inside any occurrence of a window is hit. Null texts have no
words. Items without words have no window. Rows with a null item id take part;
their id reads ``null``. Items that repeat an id are one item. Repeated
documents are judged row by row. An empty benchmark hits nothing.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema

from . import textscan as ts
from .common import lower_ascii, whole_text, written
from .prefix_sums import running_sum

WINDOW = 10
BLOCK_WORDS = 4_000_000
CHUNK_WORDS = 10_000
# Words: runs of digits, letters and all non-ASCII characters (after lower-casing A-Z).
WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
SEPARATOR = ts.separators(lambda b: 48 <= b <= 57 or 65 <= b <= 90 or 97 <= b <= 122 or b >= 128)
FOLD = ts.fold_ascii()
_STEP = ts.U64(0x2545F4914F6CDD1D)
HITS = "array<struct<first:int,words:int,from:long,to:long>>"


class Windows:
    """The windows of one block as flat arrays: about 25 bytes a window and the
    words themselves. ``items`` are (item id, normalised words joined by spaces)."""

    def __init__(self, items: list[tuple[str, str]], n: int):
        self.ids = sorted({item for item, _ in items})
        number = {item: i for i, item in enumerate(self.ids)}
        texts = pa.array([words for _, words in items], pa.large_string())
        scanned = ts.scan(texts, SEPARATOR, FOLD)
        self.data = scanned.data
        owner = np.array([number[item] for item, _ in items], dtype=np.int32)
        words = np.diff(scanned.first)
        hashes = scanned.hashes()
        self.by_length = {}
        for size in np.unique(np.minimum(words, n)).tolist():
            rolled = rolling(hashes, size)
            row = np.searchsorted(scanned.first, np.arange(len(rolled)), side="right") - 1
            mine = (np.minimum(words, n) == size)[row] & (np.arange(len(rolled)) + size <= scanned.first[row + 1])
            at = np.flatnonzero(mine)
            at = at[np.lexsort((owner[row[at]], rolled[at]))]
            bits = min(26, max(16, len(at).bit_length() + 4))
            flags = np.zeros(1 << bits, dtype=bool)
            flags[rolled[at] >> ts.U64(64 - bits)] = True
            self.by_length[size] = (bits, flags, rolled[at], scanned.start[at], scanned.end[at + size - 1], owner[row[at]])

    def hits(self, words: ts.Words, hashes: np.ndarray) -> list[tuple[int, int, list[str]]]:
        """(first word, number of words, items) of each verified occurrence."""
        out = []
        for size, (bits, flags, known, start, end, owner) in self.by_length.items():
            if len(hashes) < size:
                continue
            rolled = rolling(hashes, size)
            at = np.flatnonzero(flags[rolled >> ts.U64(64 - bits)])
            at = at[np.searchsorted(words.first, at, side="right") == np.searchsorted(words.first, at + size - 1, side="right")]
            lo, hi = np.searchsorted(known, rolled[at]), np.searchsorted(known, rolled[at], side="right")
            for k in np.flatnonzero(hi > lo).tolist():
                i = int(at[k])
                joined = b" ".join(words.word(j) for j in range(i, i + size))
                same = {self.ids[owner[w]] for w in range(lo[k], hi[k]) if self.data[start[w]:end[w]].tobytes() == joined}
                if same:
                    out.append((i, size, sorted(same)))
        return out


def rolling(h: np.ndarray, size: int) -> np.ndarray:
    """Hash of each run of ``size`` words."""
    n = max(0, len(h) - size + 1)
    out = h[:n].copy()
    with np.errstate(over="ignore"):
        for j in range(1, size):
            out = out * _STEP + h[j:j + n]
    return ts.mix(out)


def _blocks(benchmark: DataFrame, item_col: str, text_col: str, n: int, block_words: int):
    """The items' words in blocks of bounded size; long items go in overlapping chunks."""
    words = F.regexp_extract_all(lower_ascii(whole_text(text_col)), F.lit(WORD), F.lit(0))
    items = benchmark.select(F.coalesce(F.col(item_col).cast("string"), F.lit("null")).alias("item"), words.alias("words")).where(F.size("words") > 0)
    starts = F.sequence(F.lit(0), F.greatest(F.lit(0), F.size("words") - n), F.lit(CHUNK_WORDS))
    chunks = items.select("item", "words", F.explode(starts).alias("at")).select("item", F.slice("words", F.col("at") + 1, CHUNK_WORDS + n - 1).alias("words"))
    chunks = written(chunks.distinct().withColumn("size", F.size("words") + F.octet_length(F.array_join("words", " ")) / 8), "benchmark-chunks")
    total = chunks.agg(F.sum("size")).first()[0] or 0
    if total <= block_words:
        return [chunks] if total else []
    # Chunks in the order of a hash, cut where the sum of sizes passes a block's bound.
    placed, earlier = running_sum(chunks.select(F.lit(0).alias("all"), "item", "words", F.ceil("size").cast("long").alias("size"), F.xxhash64("item", "words").alias("h")), "all", [F.col("h")], "size", "benchmark-order")
    at = F.floor((F.col("earlier") + F.col("before")) / block_words).cast("long")
    dealt = written(placed.join(earlier.select("block", "earlier"), "block").select("item", "words", at.alias("part")), "benchmark-blocks")
    last = dealt.agg(F.max("part")).first()[0]
    return [dealt.where(F.col("part") == b) for b in range(last + 1)]


def _scan(block, text: str, schema: pa.Schema):
    def run(batches):
        windows: Windows = block.value
        for batch in batches:
            for part in ts.slices(batch, text):
                words = ts.scan(part.column(text), SEPARATOR, FOLD)
                found: dict[int, list] = {}
                for i, size, ids in windows.hits(words, words.hashes()):
                    found.setdefault(int(np.searchsorted(words.first, i, side="right")) - 1, []).append((i, size, ids))
                hits, items = part.column("hits").to_pylist(), part.column("items").to_pylist()
                for d, occurrences in found.items():
                    first, base = int(words.first[d]), int(words.offset[d])
                    hits[d] = merge([(h["first"], h["words"], h["from"], h["to"]) for h in hits[d]] + [(i - first, size, int(words.start[i]) - base, int(words.end[i + size - 1]) - base) for i, size, _ in occurrences])
                    items[d] = sorted({*items[d], *(x for _, _, ids in occurrences for x in ids)})
                cols = {"n_words": pa.array(np.diff(words.first), pa.int64()), "hits": pa.array(hits, schema.field("hits").type), "items": pa.array(items, schema.field("items").type)}
                yield pa.RecordBatch.from_arrays([cols.get(f.name, part.column(f.name) if f.name in part.schema.names else None) for f in schema], schema=schema)

    return run


def merge(spans: list[tuple[int, int, int, int]]) -> list[dict]:
    """Overlapping and adjoining spans (first word, words, from byte, to byte) as one."""
    out: list[dict] = []
    for first, words, start, end in sorted(spans):
        if out and first <= out[-1]["first"] + out[-1]["words"]:
            last = out[-1]
            if first + words > last["first"] + last["words"]:
                last["words"], last["to"] = first + words - last["first"], end
        else:
            out.append({"first": first, "words": words, "from": start, "to": end})
    return out


def scan(docs: DataFrame, benchmark: DataFrame, *own: Column, text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text", n: int = WINDOW, block_words: int = BLOCK_WORDS) -> DataFrame:
    """``own`` columns of each document with the text (column ``text``), n_words,
    hits (merged spans of hit words with their byte range in the text) and items
    (ids of the items with occurring windows, sorted)."""
    spark = docs.sparkSession
    df = docs.select(*own, F.col(text_col).cast("string").alias("text"), F.lit(0).cast("long").alias("n_words"), F.expr(f"cast(array() as {HITS})").alias("hits"), F.expr("cast(array() as array<string>)").alias("items"))
    blocks = _blocks(benchmark, item_col, item_text_col, n, block_words)
    # With no windows at all, one pass still counts the words.
    for i, block in enumerate(blocks or [None]):
        if i:
            df = written(df, f"decontaminate-{i}")
        items = [(r.item, r.words) for r in block.select("item", F.array_join("words", " ").alias("words")).toLocalIterator()] if block is not None else []
        windows = spark.sparkContext.broadcast(Windows(items, n))
        df = df.mapInArrow(_scan(windows, "text", to_arrow_schema(df.schema)), df.schema)
    return df


def report(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """Per document: id, n_words, n_hit, n_items, items, hits, contaminated."""
    found = scan(docs, benchmark, F.col(id_col).alias("id"), text_col=text_col, **options)
    hit = F.aggregate("hits", F.lit(0).cast("long"), lambda a, h: a + h["words"])
    return found.select(F.col("id").alias(id_col), "n_words", hit.alias("n_hit"), F.size("items").cast("long").alias("n_items"), "items", "hits", (F.size("hits") > 0).alias("contaminated"))


def decontaminate(docs: DataFrame, benchmark: DataFrame, text_col: str = "text", *, action: str = "document", **options) -> DataFrame:
    """The documents with the benchmark taken out, in the input's columns.

    ``action='document'`` removes documents with any hit; ``'span'`` removes
    the hit words and what stands between them from the text and keeps the rest."""
    if action not in ("document", "span"):
        raise ValueError(action)
    others = [F.col(f"`{c}`") for c in docs.columns if c != text_col] or [F.lit(0).alias("none")]
    found = scan(docs, benchmark, F.struct(*others).alias("row"), text_col=text_col, **options)
    text = F.col("text")
    if action == "document":
        found = found.where(F.size("hits") == 0)
    else:
        raw = F.col("text").cast("binary")
        keep = F.transform(F.sequence(F.lit(0), F.size("hits")), lambda i: F.substring(
            raw, F.when(i == 0, F.lit(0)).otherwise(F.get("hits", i - 1)["to"]).cast("int") + 1,
            (F.when(i == F.size("hits"), F.octet_length("text").cast("long")).otherwise(F.get("hits", i)["from"]) - F.when(i == 0, F.lit(0)).otherwise(F.get("hits", i - 1)["to"])).cast("int")))
        text = F.when(F.size("hits") > 0, F.array_join(F.transform(keep, lambda b: F.decode(b, "UTF-8")), "")).otherwise(F.col("text"))
    return found.select(*[text.alias(c) if c == text_col else F.col(f"row.`{c}`") for c in docs.columns])

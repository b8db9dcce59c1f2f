"""Sum-of-squares online packing of documents into training windows.

Each input task packs its own documents into windows of ``window`` tokens, one
document after the other as they come:

* A document of more than a window is cut: its full windows are sequences of
  their own, the remainder goes on as one piece.
* A piece of s tokens is placed into the fill level h for which the sum over all
  levels of N(h) squared becomes smallest, where N(h) is the number of partially
  filled windows of level h (0 stands for a new window). Moving one window from
  level h to h+s changes the sum by 2(N(h+s) - N(h)) + 2, without the first or
  the second term when the window is new or becomes full; the level array holds
  N, so a choice looks at each open level once.
* At the end of the task (or when ``open_windows`` are open, which bounds
  memory) the windows that are still partially filled are taken by falling fill
  and their pieces run on into full windows, cut where a window ends. The last
  rest is cut into powers of two, which need no padding.

So no token is lost, every token lies in exactly one piece, and padding is none.
Windows never span tasks: sequence ids are the task's number and a running
number. The result follows the order of rows in a task, which a Parquet scan
fixes; give other inputs an order if runs must repeat exactly.

A document's ids are those of the tokenizer, then ``end_id``; a null text is
empty, so its document is the end id alone. Repeated rows are packed as rows.
An empty table gives no piece.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema

from .encoding import Vocabulary, tokenizer

WINDOW = 1024
OPEN_WINDOWS = 8192
PIECES = pa.schema([("doc_id", pa.int64()), ("start", pa.int64()), ("length", pa.int64()), ("ids_crc32", pa.int64()), ("doc_tokens", pa.int64()), ("sequence_id", pa.int64()), ("offset", pa.int64()), ("ids", pa.list_(pa.int32()))])


class Packer:
    """Windows of one task. ``place`` takes documents; finished sequences are
    lists of (document, start, ids, document's tokens)."""

    def __init__(self, window: int = WINDOW, open_windows: int = OPEN_WINDOWS):
        self.window, self.most = window, open_windows
        self.count = np.zeros(window + 1, dtype=np.int64)  # N by fill level
        self.open: list[list] = [[] for _ in range(window + 1)]
        self.n_open = 0

    def place(self, doc, ids: np.ndarray):
        """Sequences that this document completes."""
        total, at = len(ids), 0
        while total - at >= self.window:
            yield [(doc, at, ids[at:at + self.window], total)]
            at += self.window
        size = total - at
        if not size:
            return
        piece = (doc, at, ids[at:], total)
        level = self.choose(size)
        pieces = self.open[level].pop() if level else []
        if level:
            self.count[level] -= 1
            self.n_open -= 1
        pieces.append(piece)
        if level + size == self.window:
            yield pieces
        else:
            self.open[level + size].append(pieces)
            self.count[level + size] += 1
            self.n_open += 1
            if self.n_open >= self.most:
                yield from self.finish()

    def choose(self, size: int) -> int:
        """Fill level (0: a new window) with the smallest sum of squares; ties to the fullest."""
        room = self.window - size
        levels = np.flatnonzero(self.count[1:room + 1]) + 1
        change = self.count[levels + size] - self.count[levels] + 1
        change[levels == room] -= self.count[self.window] + 1  # becomes full: leaves the sum
        new = 2 * self.count[size] + 1
        if not len(levels):
            return 0
        # 2(N(h+s) - N(h)) + 2, and -2N(h) + 1 for a window that becomes full
        cost = 2 * change
        cost[levels == room] += 1
        best = len(levels) - 1 - int(np.argmin(cost[::-1]))
        return int(levels[best]) if cost[best] <= new else 0

    def finish(self):
        """The open windows' pieces as full windows, the rest in powers of two."""
        left = [p for level in range(self.window, 0, -1) for pieces in self.open[level] for p in pieces]
        self.count[:] = 0
        self.open = [[] for _ in range(self.window + 1)]
        self.n_open = 0
        total = sum(len(p[2]) for p in left)
        queue, at = iter(left), 0
        piece = next(queue, None)
        while total:
            size = min(self.window, 1 << (total.bit_length() - 1))
            total -= size
            sequence = []
            while size:
                doc, start, ids, tokens = piece
                take = min(size, len(ids) - at)
                sequence.append((doc, start + at, ids[at:at + take], tokens))
                size -= take
                at += take
                if at == len(ids):
                    piece, at = next(queue, None), 0
            yield sequence


def _pack(vocabulary, window: int, end_id: int, open_windows: int, with_ids: bool, id_type: pa.DataType):
    schema = PIECES.set(0, pa.field("doc_id", id_type))
    schema = schema if with_ids else pa.schema(list(schema)[:-1])

    def run(batches):
        from pyspark import TaskContext

        encode = tokenizer(vocabulary.value).encode
        packer, sequence = Packer(window, open_windows), TaskContext.get().partitionId() << 40
        rows: list[tuple] = []

        def add(pieces):
            nonlocal sequence
            offset = 0
            for doc, start, ids, tokens in pieces:
                rows.append((doc, start, len(ids), zlib.crc32(ids.tobytes()), tokens, sequence, offset, *([ids] if with_ids else [])))
                offset += len(ids)
            sequence += 1

        def batch():
            cols = [pa.array(c, f.type) for c, f in zip(zip(*rows), schema)]
            rows.clear()
            return pa.RecordBatch.from_arrays(cols, schema=schema)

        for b in batches:
            for at in range(0, b.num_rows, 256):
                part = b.slice(at, 256)
                for doc, text in zip(part.column("id").to_pylist(), part.column("text").to_pylist()):
                    ids = np.append(encode(text or ""), np.uint32(end_id)).astype("<u4", copy=False)
                    for pieces in packer.place(doc, ids):
                        add(pieces)
                if len(rows) >= 4096:
                    yield batch()
        for pieces in packer.finish():
            add(pieces)
            if len(rows) >= 4096:
                yield batch()
        if rows:
            yield batch()

    return run


def pack(docs: DataFrame, vocabulary: Vocabulary, *, id_col: str = "doc_id", text_col: str = "text", window: int = WINDOW, end_id: int = 0, open_windows: int = OPEN_WINDOWS, with_ids: bool = False) -> DataFrame:
    """One row per piece: id, start (the document's ids before it), length,
    ids_crc32, doc_tokens, sequence_id, offset in the sequence, and with
    ``with_ids`` the token ids themselves."""
    file = docs.sparkSession.sparkContext.broadcast(vocabulary)
    src = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    kind = f"doc_id {src.schema['id'].dataType.simpleString()}, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long" + ", ids array<int>" * with_ids
    return src.mapInArrow(_pack(file, window, end_id, open_windows, with_ids, to_arrow_schema(src.schema).field("id").type), kind).withColumnRenamed("doc_id", id_col)

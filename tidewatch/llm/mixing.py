"""Mixing sources to target weights.

1. The words of each source form one stream (documents by id, size and text
   digest), which is cut into blocks of ``block`` words; only the stream's last
   block is shorter. A document's place in its stream is a prefix sum.
2. Targets: sources share the whole number of words by weight, none above
   ``cap`` times its own words; what a capped source leaves is shared anew by
   weight. A source's quota is its target to the nearest word, so it is a number
   of whole slots and a last slot cut to length.
3. Output shards have ``slots`` slots each. A shard draws how many of its slots
   each source gets from the multinomial distribution of the quotas, first by
   groups of sources, then within a group. Running sums over the shards number
   each source's slots; slots beyond a quota are handed, in pseudorandom order,
   to the sources that the draws left short, so every quota is met exactly.
4. Slot j of a source with n blocks is block p(j mod n) of pass j div n, with p a
   Feistel permutation of 0..n-1 keyed by seed, source and pass. A block is thus
   taken at most once a pass, so no document is taken more than ``cap`` times.
5. Blocks and slots are joined by (source, block).

All draws are functions of seed, source and shard: reruns agree.

Null text: size 0, taken 0. A null source is a source of its own, the last in
order. Null, repeated or non-numeric ids are kept as they are; rows count one by
one, and of rows that are alike in id, size and text any may be the one that is
taken more often. An empty table, or one without words, takes nothing. Other
columns are not read, so their names may be anything.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema

from ..operators.ordering import global_index
from . import textscan as ts
from .common import written
from .prefix_sums import running_sum

BLOCK = 1024     # words of a block
SLOTS = 4096     # slots of an output shard
CAP = 3          # times that a source, and so a document, is taken at most
GROUP = 1024     # sources that share a row of weights
SEED = 20
SEPARATOR = ts.separators(lambda b: b != 32 and not 9 <= b <= 13)
PLAIN = np.arange(256, dtype=np.uint8)
U64 = np.uint64


def permute(index: np.ndarray, n: int, key: int, back: bool = False) -> np.ndarray:
    """Places of ``index`` in the pseudorandom permutation of 0..n-1 that ``key``
    names (``back``: the inverse): a Feistel network over the next power of four,
    walked until the value lies below n."""
    half = U64(max(1, -(-max(n - 1, 1).bit_length() // 2)))
    low = (U64(1) << half) - U64(1)
    with np.errstate(over="ignore"):
        keys = ts.mix(np.array([key & (2**64 - 1)], U64) + np.arange(1, 5, dtype=U64) * U64(0x9E3779B97F4A7C15))
    out = np.asarray(index, dtype=U64).copy()
    todo = np.arange(len(out))
    while len(todo):
        a, b = out[todo] >> half, out[todo] & low
        for k in keys[::-1] if back else keys:
            a, b = (b ^ (ts.mix(a ^ k) & low), a) if back else (b, a ^ (ts.mix(b ^ k) & low))
        out[todo] = (a << half) | b
        todo = todo[out[todo] >= U64(n)]
    return out.astype(np.int64)


def pass_key(seed: int, source: int, turn: int) -> int:
    """Key of a source's permutation in its pass ``turn``."""
    x = np.array([(source ^ (seed * 0x9E3779B97F4A7C15)) & (2**64 - 1)], U64)
    return int(ts.mix(ts.mix(x) ^ U64(turn + 1))[0])


def slots_of(words: int, size: int, block: int, key) -> tuple[int, int]:
    """(slots, words of the last slot) that take ``words`` of a stream of
    ``size`` words in blocks; ``key`` gives the permutation's key of a pass."""
    if not words:
        return 0, 0
    n = -(-size // block)
    last = size - (n - 1) * block
    turns, rest = divmod(words, size)
    if not rest:
        ends_with = int(permute(np.array([n - 1]), n, key(turns - 1))[0])
        return turns * n, last if ends_with == n - 1 else block
    short = int(permute(np.array([n - 1]), n, key(turns), back=True)[0])  # where the short block comes
    k = -(-rest // block)
    if k <= short:
        return turns * n + k, rest - (k - 1) * block
    k = max(short + 1, -(-(rest + block - last) // block))
    before = (k - 1) * block - (block - last) * (k - 1 > short)
    return turns * n + k, rest - before


def _count_words(schema: pa.Schema):
    def run(batches):
        for b in batches:
            for part in ts.slices(b, "text"):
                size = np.diff(ts.scan(part.column("text"), SEPARATOR, PLAIN).first).astype(np.int64)
                yield pa.RecordBatch.from_arrays([pa.array(size) if f.name == "size" else part.column(f.name) for f in schema], schema=schema)

    return run


def _quotas(block: int, seed: int):
    def run(frames):
        for f in frames:
            made = [slots_of(int(w), int(s), block, lambda turn, h=int(h): pass_key(seed, h, turn)) for w, s, h in zip(f["quota"], f["source_size"], f["source_key"])]
            yield f.assign(n_slots=np.array([x[0] for x in made], np.int64), last_words=np.array([x[1] for x in made], np.int64))

    return run


def targets(sources: DataFrame, weight: Column, cap: int) -> DataFrame:
    """Adds ``target`` to sources (idx, source_size): shares of the whole by
    ``weight``, at most ``cap`` times a source's size, the excess shared anew by
    weight until none is above. One small aggregate per round."""
    df = sources.withColumn("weight", weight.cast("double"))
    total = df.agg(F.sum("source_size")).first()[0] or 0
    most = F.col("source_size") * F.lit(float(cap))
    share, known = 0.0, -1  # words per unit of weight
    while True:
        full = most <= F.col("weight") * F.lit(share) if known >= 0 else F.lit(False)
        r = df.agg(F.count(F.when(full, 1)), F.sum(F.when(full, F.col("source_size"))), F.sum(F.when(~full, F.col("weight")))).first()
        if r[0] == known:
            return df.withColumn("target", F.least(most, F.col("weight") * F.lit(share))).drop("weight")
        known, share = r[0], float("inf") if r[2] is None else (total - cap * (r[1] or 0)) / r[2] if r[2] else 0.0


def _shares(shards: int, slots: int, total: int, seed: int, groups, weights):
    """Task: a shard's slots dealt over the groups of sources."""
    def run(frames):
        g, w = groups, weights / weights.sum()
        for f in frames:
            out = []
            for shard in f["id"].tolist():
                n = slots if shard < shards - 1 else total - slots * (shards - 1)
                count = np.random.default_rng([seed, 1, shard]).multinomial(n, w)
                out += [(shard, int(g[i]), int(count[i])) for i in np.flatnonzero(count)]
            yield pd.DataFrame(out, columns=["shard", "grp", "n"])

    return run


def _draws(seed: int):
    """Task: a shard's slots of one group of sources dealt over its members."""
    def run(frames):
        for f in frames:
            out = []
            for shard, grp, n, members in zip(f["shard"].tolist(), f["grp"].tolist(), f["n"].tolist(), f["members"]):
                w = np.array([m["n_slots"] for m in members], float)
                count = np.random.default_rng([seed, 2, shard, grp]).multinomial(n, w / w.sum())
                out += [(shard, int(members[i]["idx"]), int(count[i])) for i in np.flatnonzero(count)]
            yield pd.DataFrame(out, columns=["shard", "idx", "n"])

    return run


def _spread(total: int, seed: int):
    """Task: free slots (shard, place, n) one by one, each with its deficit's number."""
    def run(frames):
        for f in frames:
            n = f["n"].to_numpy(np.int64)
            place = np.repeat(f["place"].to_numpy(np.int64) - (np.cumsum(n) - n), n) + np.arange(n.sum())
            yield pd.DataFrame({"shard": np.repeat(f["shard"].to_numpy(np.int64), n), "place": permute(place, total, seed)})

    return run


def _placed(block: int, seed: int):
    """Task: runs of slots (shard, idx, first, n) one by one, with their blocks."""
    def run(frames):
        for f in frames:
            for shard, idx, first, n, size, key, slots, last in zip(*[f[c].tolist() for c in ("shard", "idx", "first", "n", "source_size", "source_key", "n_slots", "last_words")]):
                blocks = -(-size // block)
                for at in range(first, first + n, 1 << 16):
                    j = np.arange(at, min(at + (1 << 16), first + n))
                    to = np.empty(len(j), np.int64)
                    for turn in range(int(j[0]) // blocks, int(j[-1]) // blocks + 1):
                        mine = j // blocks == turn
                        to[mine] = permute(j[mine] % blocks, blocks, pass_key(seed, key, turn))
                    full = np.where(to == blocks - 1, size - (blocks - 1) * block, block)
                    yield pd.DataFrame({"shard": shard, "idx": idx, "slot": j, "word_block": to, "words": np.where(j == slots - 1, last, full), "block_words": full})

    return run


@dataclass
class Mixture:
    """documents: row_no, id, source, size, source_size, target, idx, start (words
    of the source before the document). sources: idx, source, source_size, target,
    quota, n_slots. slots: shard, idx, slot, word_block, words (those of the block
    that the slot takes, from its first on), block_words."""

    documents: DataFrame
    sources: DataFrame
    slots: DataFrame
    block: int

    def pieces(self, *more: str) -> DataFrame:
        """Documents by block: idx, word_block, from, to (words of the block), and
        row_no and ``more`` columns of documents. A document without words has
        one row without a block."""
        b = F.lit(self.block)
        first, last = F.floor(F.col("start") / b), F.floor((F.col("start") + F.col("size") - 1) / b)
        d = self.documents.select("row_no", *more, "idx", "start", "size", F.explode_outer(F.when(F.col("size") > 0, F.sequence(first, last))).alias("word_block"))
        at = F.col("word_block") * b
        some = F.col("word_block").isNotNull()
        return d.select("row_no", *more, "idx", "word_block", F.when(some, F.greatest(F.col("start") - at, F.lit(0))).alias("from"), F.when(some, F.least(F.col("start") + F.col("size") - at, b)).alias("to"))

    def taken(self) -> DataFrame:
        """One row per document: id, size, source_size, target, taken."""
        uses = self.slots.groupBy("idx", "word_block").agg(F.count(F.when(F.col("words") == F.col("block_words"), 1)).alias("whole"), F.max(F.when(F.col("words") < F.col("block_words"), F.col("words"))).alias("part"))
        own = ["id", "size", "source_size", "target"]
        p = self.pieces(*own[:1], *own[2:])
        p = p.join(uses, ["idx", "word_block"], "left")
        words = F.col("to") - F.col("from")
        n = F.when(words.isNotNull(), F.coalesce("whole", F.lit(0)) * words + F.greatest(F.least("to", F.coalesce("part", F.lit(0))) - F.col("from"), F.lit(0)))
        got = p.groupBy("row_no").agg(*[F.first(c).alias(c) for c in ("id", "source_size", "target")], F.sum(F.coalesce(words, F.lit(0))).alias("size"), F.sum(F.coalesce(n, F.lit(0))).cast("long").alias("taken"))
        return got.select(*own, "taken")

    def sequences(self) -> DataFrame:
        """The mix itself as spans of documents: shard, position (of the slot in
        its shard, pseudorandom), at (words of the slot before the span), row_no,
        id, first_word (of the document), n_words."""
        order = Window.partitionBy("shard").orderBy(F.xxhash64("idx", "slot"), "idx", "slot")
        slots = self.slots.withColumn("position", F.row_number().over(order) - 1)
        p = self.pieces("id").where("word_block is not null").join(self.documents.select("row_no", "start"), "row_no")
        to = F.least("to", "words")
        return slots.join(p, ["idx", "word_block"]).where(F.col("from") < to).select(
            "shard", "position", F.col("from").alias("at"), "row_no", "id",
            (F.col("word_block") * F.lit(self.block) + F.col("from") - F.col("start")).alias("first_word"), (to - F.col("from")).alias("n_words"))


def mix(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", weight: Column | None = None, block: int = BLOCK, slots: int = SLOTS, cap: int = CAP, seed: int = SEED) -> Mixture:
    """The mixture of ``docs``. ``weight`` is an expression over ``idx`` (the source's
    place by code point, null last) and ``source``; else 1, 2, 3, repeating."""
    weight = weight if weight is not None else F.col("idx") % 3 + 1
    spark = docs.sparkSession
    text = F.col(text_col).cast("string")
    src = docs.select(F.col(id_col).alias("id"), F.col(source_col).cast("string").alias("source"), F.xxhash64(text).alias("digest"), text.alias("text"))
    sized = src.drop("text").withColumn("size", F.lit(0).cast("long"))
    sized = written(src.mapInArrow(_count_words(to_arrow_schema(sized.schema)), sized.schema), "mix-sizes")
    placed, blocks = running_sum(sized, "source", [F.col("id").asc_nulls_first(), F.col("size"), F.col("digest")], "size", "mix-documents")

    each = blocks.groupBy("source").agg(F.sum("here").alias("source_size"))
    sources = written(global_index(each, ["source"], index_col="idx", nulls_last=True), "mix-sources")
    sources = targets(sources, weight, cap).withColumn("source_key", F.xxhash64("source")).withColumn("quota", F.floor(F.col("target") + 0.5).cast("long"))
    kind = sources.select("*", F.lit(0).cast("long").alias("n_slots"), F.lit(0).cast("long").alias("last_words")).schema
    sources = written(sources.mapInPandas(_quotas(block, seed), kind), "mix-quotas")

    at = blocks.alias("b").join(sources.alias("s"), F.col("b.source").eqNullSafe(F.col("s.source"))).select("b.block", "b.source", "b.earlier", "s.idx", "s.source_size", "s.target")
    at = written(at, "mix-places")
    documents = placed.alias("d").join(at.alias("b"), F.col("d.source").eqNullSafe(F.col("b.source")) & (F.col("d.block") == F.col("b.block"))).select(
        "d.row_no", "d.id", "d.source", "d.size", "b.source_size", "b.target", "b.idx", (F.col("b.earlier") + F.col("d.before")).alias("start"))
    return Mixture(documents, sources, _slots(spark, sources, block, slots, seed), block)


def _slots(spark, sources: DataFrame, block: int, slots: int, seed: int) -> DataFrame:
    used = sources.where("n_slots > 0").withColumn("grp", F.floor(F.col("idx") / GROUP))
    groups = written(used.groupBy("grp").agg(F.sort_array(F.collect_list(F.struct("idx", "n_slots"))).alias("members"), F.sum("n_slots").alias("n")), "mix-groups")
    heads = sorted((r["grp"], r["n"]) for r in groups.select("grp", "n").collect())  # a number per 1,024 sources
    total = sum(n for _, n in heads)
    if not total:
        return spark.createDataFrame([], "shard long, idx long, slot long, word_block long, words long, block_words long")
    shards = -(-total // slots)
    deal = _shares(shards, slots, total, seed, np.array([g for g, _ in heads]), np.array([float(n) for _, n in heads]))
    dealt = spark.range(shards).mapInPandas(deal, "shard long, grp long, n long")
    drawn = dealt.join(groups.select("grp", "members"), "grp").mapInPandas(_draws(seed), "shard long, idx long, n long")
    drawn, parts = running_sum(drawn, "idx", [F.col("shard")], "n", "mix-draws")

    quota = sources.select("idx", "n_slots")
    known = parts.join(quota, "idx")
    first = F.col("earlier") + F.col("before")
    runs = drawn.join(known.select("block", "idx", "earlier", "n_slots"), ["block", "idx"]).select("shard", "idx", first.alias("first"), F.least(first + F.col("n"), "n_slots").alias("to"), (first + F.col("n")).alias("end"))
    runs = written(runs, "mix-runs")
    free = runs.select("shard", "idx", (F.col("end") - F.greatest("first", "to")).alias("n")).where("n > 0").withColumn("all", F.lit(0))
    short = quota.join(parts.groupBy("idx").agg(F.sum("here").alias("got")), "idx", "left").select("idx", F.coalesce("got", F.lit(0)).alias("got"), (F.col("n_slots") - F.coalesce("got", F.lit(0))).alias("n")).where("n > 0").withColumn("all", F.lit(0))
    free, free_parts = running_sum(free, "all", [F.col("shard"), F.col("idx")], "n", "mix-free")
    short, short_parts = running_sum(short, "all", [F.col("idx")], "n", "mix-short")
    spare = free_parts.agg(F.sum("here")).first()[0] or 0
    free = free.join(free_parts.select("block", "earlier"), "block").select("shard", (F.col("earlier") + F.col("before")).alias("place"), "n").mapInPandas(_spread(spare, seed), "shard long, place long")
    short = short.join(short_parts.select("block", "earlier"), "block").select("idx", "got", (F.col("earlier") + F.col("before")).alias("place"), F.posexplode(F.sequence(F.lit(1), F.col("n"))).alias("k", "unused"))
    handed = free.join(short.select((F.col("place") + F.col("k")).alias("place"), "idx", (F.col("got") + F.col("k")).alias("first")), "place")

    every = runs.where("to > first").select("shard", "idx", "first", (F.col("to") - F.col("first")).alias("n")).unionByName(handed.select("shard", "idx", "first", F.lit(1).cast("long").alias("n")))
    every = every.join(sources.select("idx", "source_size", "source_key", "n_slots", "last_words"), "idx")
    return written(every.mapInPandas(_placed(block, seed), "shard long, idx long, slot long, word_block long, words long, block_words long"), "mix-slots")

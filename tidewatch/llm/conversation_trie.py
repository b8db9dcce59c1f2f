"""Conversation prefix trie: nodes of shared conversation beginnings and what sharing saves.

1. A turn is the digest of (role, text); a conversation is the sequence of its
   turns' digests, in rows of at most ``SEGMENT`` turns, so none is ever one value
   whole. ``rebuilt`` gives the conversations of the query their shared heads.
2. Shards: the rows are range-partitioned by (prefix before the row, turns,
   conversation), so a shard is a run of neighbouring conversations of bounded size
   and a prefix that a third of all conversations share is cut into many shards.
3. In a shard, the distinct turns get dense ids and the conversations become a
   double-array trie: the child of node s by turn c is cell ``BASE[s] + c``, valid where
   ``CHECK`` of the cell is s (``DoubleArray``). Walking the arrays gives each node its
   members, smallest member, children and, from below, its subtree's sums.
4. Only nodes on the paths to a shard's first and last row can lie in other
   shards too. Their partial aggregates are merged by prefix, and the merged
   nodes pass their sums up to their ancestors; all others are final as they are.
5. Prefixes of more than ``SEGMENT`` turns that several conversations share are
   worked from the deepest rows up, so their sums reach the rows above; a
   conversation that goes on alone needs no such round.

A prefix is named by its depth and four 32-bit sums of position-dependent hashes
of its turns (128 bits), so prefixes across rows and shards need no sequence.

Defined results: turns are ordered by turn number (null first), those that tie by
their digest. A null role or text counts as empty; rows with a null
conversation id belong to no conversation and are left out. Ids are whole
numbers. Repeated rows are turns of their own. An empty table gives no nodes, not
even a root. Other columns are not read.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..operators.ordering import rank_in_groups
from . import textscan as ts
from .common import shuffle_partitions, written

SEGMENT = 256        # turns of a conversation in one row
SHARD_ROWS = 16384   # rows of a shard at most
SHARD_TURNS = 1 << 18
BLOB_IDS = 512       # ids of one row of a list that spans shards
WORD = r"[^\x20\x09-\x0D]+"
U64 = np.uint64
LOW = U64(0xFFFFFFFF)
ROOT = b"\xff"
NO_ENDS = hashlib.sha256(b"").hexdigest()


class DoubleArray:
    """Trie over dense ids in two arrays. Cell 0 is the root."""

    def __init__(self, size: int = 1024):
        self.base = np.zeros(size, np.int64)
        self.check = np.full(size, -1, np.int64)   # -1: free
        self.check[0] = -2
        self.low, self.top = 1, 1                  # first cell that may be free, first of those never used

    def _reach(self, size: int) -> None:
        if size > len(self.check):
            more = max(size, 2 * len(self.check)) - len(self.check)
            self.base = np.append(self.base, np.zeros(more, np.int64))
            self.check = np.append(self.check, np.full(more, -1, np.int64))

    def _free(self, n: int) -> np.ndarray:
        """The first ``n`` free cells."""
        self._reach(self.top + n)
        return np.flatnonzero(self.check[self.low:self.top + n] == -1)[:n] + self.low

    def _fit(self, codes: np.ndarray) -> int:
        """A base by which all (rising) codes fall on free cells."""
        gap = codes - codes[0]
        self._reach(self.top + int(gap[-1]) + 1)
        for first in np.flatnonzero(self.check[self.low:self.top] == -1)[:16] + self.low:
            if (self.check[first + gap] == -1).all():
                return int(first - codes[0])
        return int(self.top - codes[0])

    def _take(self, cells: np.ndarray) -> None:
        self.top = max(self.top, int(cells.max()) + 1)
        while self.low < self.top and self.check[self.low] != -1:
            self.low += 1

    def place(self, parents: np.ndarray, codes: np.ndarray) -> np.ndarray:
        """Cells of new children; children of one parent come together."""
        cells = np.empty(len(codes), np.int64)
        first = np.flatnonzero(np.append(True, parents[1:] != parents[:-1]))
        count = np.diff(np.append(first, len(codes)))
        for a, n in zip(first[count > 1].tolist(), count[count > 1].tolist()):
            order = np.argsort(codes[a:a + n])
            base = self._fit(codes[a:a + n][order])
            at = base + codes[a:a + n]
            self.base[parents[a]], self.check[at], cells[a:a + n] = base, parents[a], at
            self._take(at)
        alone = first[count == 1]
        if len(alone):
            at = self._free(len(alone))
            self.base[parents[alone]], self.check[at], cells[alone] = at - codes[alone], parents[alone], at
            self._take(at)
        return cells

    def step(self, states: np.ndarray, codes: np.ndarray) -> np.ndarray:
        """Children of ``states`` by ``codes``; -1 where there is none."""
        to = self.base[states] + codes
        fine = (to >= 0) & (to < len(self.check))
        fine[fine] &= self.check[to[fine]] == states[fine]
        return np.where(fine, to, -1)


def lanes(low: np.ndarray, high: np.ndarray, place: np.ndarray) -> np.ndarray:
    """Four 32-bit hashes of each turn (two halves of its digest) at its place."""
    with np.errstate(over="ignore"):
        p = ts.mix(place.astype(U64) * U64(0x9E3779B97F4A7C15) + U64(1))
        a = ts.mix(low ^ p)
        b = ts.mix(high ^ ts.mix(a + p))
    return np.stack([a >> U64(32), a & LOW, b >> U64(32), b & LOW], axis=1)


def node_keys(depth: np.ndarray, sums: np.ndarray) -> np.ndarray:
    """Names of prefixes: 8 bytes of depth, 16 of lane sums."""
    return np.concatenate([depth.astype(">u8")[:, None].view(np.uint8), (sums & LOW).astype(">u4").view(np.uint8).reshape(-1, 16)], axis=1)


def _turn_halves(paths: list[str]) -> np.ndarray:
    return np.frombuffer(bytes.fromhex("".join(paths)), "<u8").astype(U64).reshape(-1, 2)


def _dense(halves: np.ndarray, order: np.ndarray) -> np.ndarray:
    """Dense ids of turns, numbered as they first appear in ``order``."""
    raw = pa.py_buffer(np.ascontiguousarray(halves[order]).tobytes())
    index = pa.FixedSizeBinaryArray.from_buffers(pa.binary(16), len(order), [None, raw]).dictionary_encode().indices
    out = np.empty(len(order), np.int64)
    out[order] = index.to_numpy(zero_copy_only=False)
    return out


def shard_trie(start: bytes, conv: np.ndarray, paths: list[str], words: np.ndarray, more: np.ndarray, below: np.ndarray, open_left: bool, open_right: bool, segment: int):
    """Nodes of one shard: (columns, chains, lists).

    Rows are sorted by path, then conversation. ``more`` marks rows whose
    conversation goes on in a further segment, ``below`` has (children, leaves,
    saved) under them. ``open_left`` and ``open_right`` say that the shard's prefix may have
    rows elsewhere. Columns: key, parent (index), conv, depth, n, words, edge (may
    lie in other shards too), and children, leaves, saved of final subtrees. Chains
    hold the edge nodes of a path from the top; lists (node, ids that end there)."""
    rows = len(conv)
    length = np.array([len(p) >> 5 for p in paths])
    off = np.append(0, np.cumsum(length))
    level = np.arange(off[-1]) - np.repeat(off[:-1], length)
    halves = _turn_halves(paths)
    code = _dense(halves, np.argsort(level, kind="stable")) if off[-1] else np.zeros(0, np.int64)
    above = int.from_bytes(start[:8], "big")
    sums = np.zeros((off[-1] + 1, 4), U64)
    np.cumsum(lanes(halves[:, 0], halves[:, 1], above + level), axis=0, out=sums[1:])
    top = np.frombuffer(start[8:], ">u4").astype(U64)

    trie, state = DoubleArray(off[-1] // 2 + 16), np.zeros(rows, np.int64)
    for d in range(length.max(initial=0)):
        act = np.flatnonzero(length > d)
        s, c = state[act], code[off[act] + d]
        new = np.append(True, (s[1:] != s[:-1]) | (c[1:] != c[:-1]))
        state[act] = trie.place(s[new], c[new])[np.cumsum(new) - 1]

    node_of = np.zeros(len(trie.check), np.int64)
    cols = {"row": [np.zeros(1, np.int64)], "parent": [np.array([-1])], "conv": [conv.min(keepdims=True)], "depth": [np.array([0])], "n": [np.array([rows])], "words": [np.array([0])], "edge": [np.array([open_left or open_right])]}
    chains: list[list[int]] = [[0]] * open_left + [[0]] * open_right
    lists = [(0, conv[length == 0])] if above == 0 and (length == 0).any() else []
    hangs: list[tuple[int, np.ndarray]] = []  # (node, below) where conversations go on
    made, state = 1, np.zeros(rows, np.int64)
    for d in range(1, length.max(initial=0) + 1):
        act = np.flatnonzero(length >= d)
        turn = off[act] + d - 1
        state[act] = cell = trie.step(state[act], code[turn])
        if (cell < 0).any():
            raise AssertionError("a conversation is not in its trie")
        first = np.flatnonzero(np.append(True, cell[1:] != cell[:-1]))
        here = made + np.arange(len(first))
        node_of[cell[first]] = here
        edge = np.zeros(len(first), bool)
        edge[0] |= open_left and act[0] == 0
        edge[-1] |= open_right and act[-1] == rows - 1
        if edge[0] and open_left and act[0] == 0:
            chains[0] = chains[0] + [int(here[0])]
        if edge[-1] and open_right and act[-1] == rows - 1:
            chains[-1] = chains[-1] + [int(here[-1])]
        for name, value in (("row", turn[first]), ("parent", node_of[trie.check[cell[first]]]), ("conv", np.minimum.reduceat(conv[act], first)), ("depth", np.full(len(first), d)), ("n", np.diff(np.append(first, len(act)))), ("words", words[turn[first]]), ("edge", edge)):
            cols[name].append(value)
        ends = np.flatnonzero((length[act] == d) & ~more[act])
        if len(ends):
            of = node_of[cell[ends]]
            cut = np.flatnonzero(of[1:] != of[:-1]) + 1
            lists += list(zip(of[np.append(0, cut)].tolist(), np.split(conv[act[ends]], cut)))
        if d == segment:
            on = np.flatnonzero((length[act] == d) & more[act])
            hangs += list(zip(node_of[cell[on]].tolist(), below[act[on]]))
        made += len(first)
    out = {k: np.concatenate(v) for k, v in cols.items()}
    at = np.where(out["depth"] > 0, out["row"] + 1, 0)
    begin = off[np.searchsorted(off, out["row"], side="right") - 1]
    total = np.where((out["depth"] > 0)[:, None], sums[at] - sums[begin], U64(0)) + top
    out["key"] = node_keys(above + out["depth"], total)
    children, leaves, saved = (np.zeros(made, np.int64) for _ in range(3))
    hung = np.zeros((made, 3), np.int64)
    for node, value in hangs:
        hung[node] = value
    final = ~out["edge"]
    out["hung"] = np.where(out["edge"][:, None], hung, 0)
    for d in range(int(out["depth"].max()), -1, -1):
        i = np.flatnonzero(out["depth"] == d)
        done = i[final[i]]
        for total_of, col in ((children, 0), (leaves, 1), (saved, 2)):
            total_of[done] += hung[done, col]
        leaves[done] += children[done] == 0
        saved[done] += (out["n"][done] - 1) * out["words"][done]
        up = done[out["parent"][done] >= 0]
        np.add.at(children, out["parent"][up], 1)
        np.add.at(leaves, out["parent"][up], leaves[up])
        np.add.at(saved, out["parent"][up], saved[up])
    return out | {"children": children, "leaves": leaves, "saved": saved}, chains, lists


_NODE = "kind string, shard long, key binary, parent binary, conv long, parent_conv long, depth long, n long, words long, children long, leaves long, saved long, hung_children long, hung_leaves long, hung_saved long, path array<binary>, first long, ids string, ends_sha256 string"
_ARROW = pa.schema([("kind", pa.string()), ("shard", pa.int64()), ("key", pa.binary()), ("parent", pa.binary()), ("conv", pa.int64()), ("parent_conv", pa.int64()), ("depth", pa.int64()), ("n", pa.int64()), ("words", pa.int64()), ("children", pa.int64()), ("leaves", pa.int64()), ("saved", pa.int64()), ("hung_children", pa.int64()), ("hung_leaves", pa.int64()), ("hung_saved", pa.int64()), ("path", pa.list_(pa.binary())), ("first", pa.int64()), ("ids", pa.string()), ("ends_sha256", pa.string())])


def _table(columns: dict, n: int) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(columns[f.name], f.type) if f.name in columns else pa.nulls(n, f.type) for f in _ARROW], schema=_ARROW)


def _joined(ids: np.ndarray) -> str:
    return ",".join(map(str, ids.tolist()))


def _shard_rows(shard: int, trie, chains, lists, above: int):
    """A shard's trie as rows: final nodes, edge nodes' parts, ids of edge nodes."""
    key = [k.tobytes() for k in trie["key"]]
    if above:  # the prefix itself is a node of the rows above; its name here must differ
        key[0] += ROOT
    parent = trie["parent"]
    final = np.flatnonzero(~trie["edge"])
    ends = {node: ids for node, ids in lists}
    inside = (parent >= 0) & ~trie["edge"][parent]
    if len(final):
        yield _table({
            "kind": ["node"] * len(final), "shard": [shard] * len(final), "key": [key[i] for i in final], "parent": [key[p] if p >= 0 else None for p in parent[final].tolist()],
            "conv": trie["conv"][final], "parent_conv": [int(trie["conv"][p]) if ok else None for p, ok in zip(parent[final].tolist(), inside[final].tolist())],
            "depth": above + trie["depth"][final], "n": trie["n"][final], "words": trie["words"][final], "children": trie["children"][final], "leaves": trie["leaves"][final], "saved": trie["saved"][final],
            "ends_sha256": [hashlib.sha256(_joined(ends[i]).encode()).hexdigest() if i in ends else NO_ENDS for i in final.tolist()]}, len(final))
    path: dict[int, list[bytes]] = {}
    for chain in chains:
        for i, node in enumerate(chain):
            path[node] = [key[c] for c in chain[:i + 1]]
    edge = sorted(path)
    if edge:
        yield _table({
            "kind": ["edge"] * len(edge), "shard": [shard] * len(edge), "key": [key[i] for i in edge], "parent": [key[parent[i]] if parent[i] >= 0 else None for i in edge],
            **{name: trie[name][edge] for name in ("conv", "n", "words", "children", "leaves", "saved")}, "depth": above + trie["depth"][edge],
            **{f"hung_{name}": trie["hung"][edge, j] for j, name in enumerate(("children", "leaves", "saved"))}, "path": [path[i] for i in edge]}, len(edge))
    blobs = [(key[i], int(ids[a]), _joined(ids[a:a + BLOB_IDS])) for i in edge if i in ends for ids in [ends[i]] for a in range(0, len(ids), BLOB_IDS)]
    if blobs:
        yield _table({"kind": ["ends"] * len(blobs), "key": [b[0] for b in blobs], "first": [b[1] for b in blobs], "ids": [b[2] for b in blobs]}, len(blobs))


def _tries(segment: int, shard_rows: int, shard_turns: int):
    """Task: sorted rows -> rows of the tries of its shards."""
    def shards(rows):
        """Runs of rows of bounded size."""
        out, turns = [], 0
        for r in rows:
            size = len(r[3]) >> 5
            if out and (len(out) >= shard_rows or turns + size > shard_turns):
                yield out
                out, turns = [], 0
            out.append(r)
            turns += size
        if out:
            yield out

    def run(batches):
        from pyspark import TaskContext

        def rows():
            for b in batches:
                yield from zip(*[b.column(c).to_pylist() for c in ("start", "conv", "more", "path", "words", "below")])

        number = TaskContext.get().partitionId() << 32
        for part in shards(rows()):
            cut = [0, *[i for i in range(1, len(part)) if part[i][0] != part[i - 1][0]], len(part)]
            for a, b in zip(cut, cut[1:]):
                start, conv, more, paths, words, below = zip(*part[a:b])
                flat = np.array([w for ws in words for w in ws], np.int64)
                trie = shard_trie(start[0], np.array(conv, np.int64), list(paths), flat, np.array(more, bool), np.array(below, np.int64).reshape(-1, 3), a == 0, b == len(part), segment)
                yield from _shard_rows(number, *trie, int.from_bytes(start[0][:8], "big"))
                number += 1

    return run


def _digests(batches):
    """Task: rows sorted by (key, first) -> SHA-256 of each key's ids, as they stream by."""
    key, sha = None, None

    def result():
        return pa.RecordBatch.from_pydict({"key": pa.array([key], pa.binary()), "ends_sha256": [sha.hexdigest()]})

    for b in batches:
        for k, ids in zip(b.column("key").to_pylist(), b.column("ids").to_pylist()):
            if k != key:
                if sha is not None:
                    yield result()
                key, sha = k, hashlib.sha256()
                sha.update(ids.encode())
            else:
                sha.update(("," + ids).encode())
    if sha is not None:
        yield result()


def _round(rows: DataFrame, segment: int, shard_rows: int, shard_turns: int) -> DataFrame:
    """Nodes of rows (start, conv, more, path, words, below), all their prefixes' roots among them."""
    by = ["start", "path", "conv"]
    n = shuffle_partitions(rows.sparkSession)
    found = written(rows.repartitionByRange(n, *by).sortWithinPartitions(*by).mapInArrow(_tries(segment, shard_rows, shard_turns), _NODE), "trie-shards")
    edges = found.where("kind = 'edge'")
    sums = [F.sum(c).alias(c) for c in ("n", "children", "leaves", "saved")]
    same = [F.max(c).alias(c) for c in ("parent", "depth", "words", "hung_children", "hung_leaves", "hung_saved")]
    merged = edges.groupBy("key").agg(F.min("conv").alias("conv"), *sums, *same, F.max("path").alias("path"))
    kids = edges.select("key", "parent").distinct().groupBy(F.col("parent").alias("key")).agg(F.count(F.lit(1)).alias("kids"))
    merged = merged.join(kids, "key", "left").withColumn("children", F.col("children") + F.col("hung_children") + F.coalesce("kids", F.lit(0)))
    merged = written(merged, "trie-edges")
    own = merged.select("path", (F.col("leaves") + F.col("hung_leaves") + (F.col("children") == 0).cast("long")).alias("leaves"), (F.col("saved") + F.col("hung_saved") + (F.col("n") - 1) * F.col("words")).alias("saved"))
    sums = own.select(F.explode("path").alias("key"), "leaves", "saved").groupBy("key").agg(F.sum("leaves").alias("leaves"), F.sum("saved").alias("saved"))
    blobs = found.where("kind = 'ends'").select("key", "first", "ids").repartition(n, "key").sortWithinPartitions("key", "first")
    ends = blobs.mapInArrow(_digests, "key binary, ends_sha256 string")
    tops = merged.select(F.col("key").alias("parent"), F.col("conv").alias("parent_conv"))
    result = ["key", "parent", "conv", "parent_conv", "depth", "n", "children", "leaves", "saved", "ends_sha256"]
    edge = merged.drop("leaves", "saved").join(sums, "key").join(tops, "parent", "left").join(ends, "key", "left").withColumn("ends_sha256", F.coalesce("ends_sha256", F.lit(NO_ENDS)))
    # Final nodes below an edge node: its merged smallest member goes back to each of its shards first.
    whole = found.where("kind = 'node'")
    back = edges.select("shard", "key").join(merged.select("key", "conv"), "key").select("shard", F.col("key").alias("parent"), F.col("conv").alias("merged_conv"))
    hang = whole.where("parent_conv is null").drop("parent_conv").join(back, ["shard", "parent"], "left").withColumnRenamed("merged_conv", "parent_conv")
    return written(edge.select(result).unionAll(whole.where("parent_conv is not null").select(result)).unionAll(hang.select(result)), "trie-nodes")


def _start_key(depth, sums):
    """The name of a prefix from its depth and lane sums, as Spark columns."""
    part = [F.lpad(F.hex(F.pmod(c, F.lit(1 << 32))), 8, "0") for c in sums]
    return F.unhex(F.concat(F.lpad(F.hex(depth), 16, "0"), *part))


def _segment_sums(segment: int):
    def run(batches):
        for b in batches:
            seg, paths = b.column("seg").to_numpy(), b.column("path").to_pylist()
            out = []
            for s, p in zip(seg.tolist(), paths):
                h = _turn_halves([p])
                out.append((lanes(h[:, 0], h[:, 1], s * segment + np.arange(len(h))).sum(axis=0) & LOW).astype(np.int64))
            total = np.array(out).reshape(-1, 4)
            yield pa.RecordBatch.from_arrays([b.column("conv"), b.column("seg"), *[pa.array(total[:, j]) for j in range(4)]], names=["conv", "seg", "s0", "s1", "s2", "s3"])

    return run


def trie(turns: DataFrame, *, segment: int = SEGMENT, shard_rows: int = SHARD_ROWS, shard_turns: int = SHARD_TURNS) -> DataFrame:
    """Nodes of conversations given as turns (conv, place from 0, token: 32 hex digits,
    words, total: turns of the conversation); a conversation without turns has one
    row with a null place. Per node: key, parent, conv (smallest member), parent_conv,
    depth, n (members), children, leaves, saved, ends_sha256."""
    row = F.when(F.col("place").isNotNull(), F.struct("place", "token", F.col("words").cast("long").alias("words")))
    got = turns.groupBy("conv", F.coalesce(F.floor(F.col("place") / segment), F.lit(0)).alias("seg")).agg(F.sort_array(F.collect_list(row)).alias("t"), F.max("total").alias("total"))
    rows = written(got.select("conv", "seg", "total", F.array_join("t.token", "").alias("path"), F.col("t.words").alias("words"), (F.col("total") > (F.col("seg") + 1) * segment).alias("more")), "trie-rows")
    zero, nothing = F.lit(b"\0" * 24), F.array(*[F.lit(x).cast("long") for x in (1, 1, 0)])  # alone below: one child, one leaf, nothing saved
    deepest = rows.agg(F.max("seg")).first()[0]
    if not deepest:
        return _round(rows.select(zero.alias("start"), "conv", "more", "path", "words", nothing.alias("below")), segment, shard_rows, shard_turns)
    long = rows.where(f"total > {segment}").select("conv", "seg", "path").mapInArrow(_segment_sums(segment), "conv long, seg long, s0 long, s1 long, s2 long, s3 long")
    w = Window.partitionBy("conv").orderBy("seg").rowsBetween(Window.unboundedPreceding, 0)
    stop = long.select("conv", "seg", *[F.sum(f"s{j}").over(w).alias(f"e{j}") for j in range(4)], *[F.col(f"s{j}") for j in range(4)])
    ends = [F.col(f"e{j}") for j in range(4)]
    names = written(stop.select("conv", "seg", _start_key(F.col("seg") * segment, [F.col(f"e{j}") - F.col(f"s{j}") for j in range(4)]).alias("start"), _start_key((F.col("seg") + 1) * segment, ends).alias("stop")), "trie-names")
    shared = names.where("seg > 0").groupBy("start").agg(F.count(F.lit(1)).alias("sharing"))
    all_rows = rows.join(names, ["conv", "seg"], "left").join(shared, "start", "left").withColumn("start", F.coalesce("start", zero))
    all_rows = written(all_rows.withColumn("alone", (F.col("seg") > 0) & (F.col("sharing") == 1)), "trie-named")
    pick = ["start", "conv", "more", "path", "words", "below"]
    own = _round(all_rows.where("alone").withColumn("below", nothing).select(pick), segment, shard_rows, shard_turns).where("parent is not null")
    down = None
    for s in range(all_rows.where("not alone").agg(F.max("seg")).first()[0], -1, -1):
        part = all_rows.where(f"not alone and seg = {s}")
        part = part.withColumn("below", nothing) if down is None else part.join(down, "stop", "left").withColumn("below", F.coalesce("below", nothing))
        nodes = _round(part.select(pick), segment, shard_rows, shard_turns)
        down = written(nodes.where("parent is null").select(F.substring("key", 1, 24).alias("stop"), F.array("children", "leaves", "saved").alias("below")), "trie-below")
        own = own.unionAll(nodes.where("parent is not null") if s else nodes)
    own = written(own, "trie-all")
    over = own.where(f"depth % {segment} = 0").select(F.col("key").alias("parent"), F.col("conv").alias("over"))
    first = F.col("depth") % segment == 1 % segment
    fixed = own.where(first & (F.col("depth") > 1)).withColumn("parent", F.substring("parent", 1, 24)).join(over, "parent").withColumn("parent_conv", F.col("over")).select(own.columns)
    return own.where(~first | (F.col("depth") <= 1)).unionAll(fixed)


def rebuilt(conversations: DataFrame, *, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text", family: int = 20, heads: int = 4) -> DataFrame:
    """Turns of the rebuilt conversations, as ``trie`` takes them.

    Conversation c begins with the first h turns of conversation c - c % ``family``
    (as many as it has), then has its own turns after its first h; h is the crc32
    of c's decimal digits modulo ``heads``, and % keeps the sign of c, as in SQL."""
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in (role_col, text_col))
    own = conversations.select(F.col(conv_col).cast("long").alias("conv"), F.col(turn_col).alias("turn"), F.substring(F.sha2(F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text), 256), 1, 32).alias("token"), F.regexp_count(text, F.lit(WORD)).cast("long").alias("words")).where("conv is not null")
    ranked = rank_in_groups(own, ["conv"], ["turn", "token"], rank_col="rank", size_col="n")
    ranked = written(ranked.select("conv", "token", "words", "rank", "n"), "trie-turns")
    each = ranked.where("rank = 1").select("conv", "n", (F.crc32(F.col("conv").cast("string").cast("binary")) % heads).alias("h"), (F.col("conv") - F.col("conv") % family).alias("base"))
    base = ranked.where((F.col("conv") % family == 0) & (F.col("rank") < heads)).select(F.col("conv").alias("base"), "rank", "token", "words", F.col("n").alias("n_base"))
    each = each.join(base.where("rank = 1").select("base", "n_base"), "base", "left").withColumn("k", F.least("h", F.coalesce("n_base", F.lit(0))))
    each = written(each.withColumn("total", F.col("k") + F.greatest(F.col("n") - F.col("h"), F.lit(0))), "trie-conversations")
    begun = each.where("k > 0").join(base.drop("n_base"), "base").where("rank <= k").select("conv", (F.col("rank") - 1).alias("place"), "token", "words", "total")
    rest = ranked.drop("n").join(each.select("conv", "h", "k", "total"), "conv").where("rank > h").select("conv", (F.col("k") + F.col("rank") - F.col("h") - 1).alias("place"), "token", "words", "total")
    none = each.where("total = 0").select("conv", F.lit(None).cast("long").alias("place"), F.lit(None).cast("string").alias("token"), F.lit(None).cast("long").alias("words"), "total")
    return begun.unionAll(rest).unionAll(none)

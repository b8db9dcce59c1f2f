"""N-gram Jaccard self-join by universe partition and pigeonhole, with exact verification.

A document's set holds the 64-bit hashes of its distinct ``shingle``-word
shingles. Sets a and b link when 100 |a & b| >= percent |a | b|, that is when they
differ in at most H = floor((100 - percent)(|a| + |b|) / (100 + percent)) hashes.

1. *Classes.* Documents with equal sets are one class from here on, so a group of
   copies, however large, is one set with one row per input task.
2. *Size bands.* Sizes fall into bands that grow by 100/percent; a set links only
   inside its band and the next, so it takes part in the scheme of its own band
   and in that of the band below. A scheme has one H for all its pairs.
3. *Segments.* A scheme cuts the universe of hashes into m equal ranges. By the
   pigeonhole principle linked sets agree on at least m - H segments.
   Allocation ``exact``: m = H + 1 + E, and every set leaves out its E costliest
   segments (those with the fewest hashes, which many sets share; equal segments
   cost the same on both sides). Of the E + 1 equal segments at least one is left
   in by both sides, so nothing is lost and H + 1 signatures remain, without
   the empty and tiny ones.
   Allocation ``deletion``: m = ceil((H + 1) / 2), where some segment differs in at
   most one hash; a set gives each segment and each segment less one hash (its
   one-deletion neighbourhood). Larger segments are far more selective
   but give a signature per hash. ``allocate`` picks the cheaper one per band from
   the number of classes that the band really has.
4. *Candidates.* Signatures travel as packed blocks to the partition of their hash.
   A signature that many sets of a block share goes to a partition of that block's
   own, with one marker in the common one, so no partition gathers a hot
   signature whole. Signatures of one set alone end here.
5. *Links.* Every member is compared with its group's smallest one: sizes, then a
   512-bit parity sketch (whose distance never exceeds the sets' distance), then
   the sets themselves. Linked members become components. Groups that still
   hold two components then compare members of different components, sketch
   against sketch in blocks of bounded size inside the task; what passes is
   verified on the sets. So links inside a component are not spelled out, and
   no link between components is lost. Members of large groups share many
   signatures; each carries the smallest ``LISTED`` ones of its large groups, and a
   pair leaves only the group of the smallest signature that both list (or
   every group beyond the lists), not all that it shares.

Words are ``[^\\x20\\x09-\\x0D]+`` after lower-casing A-Z. A text of fewer words than
a shingle is one shingle of all its words; null or wordless texts have none and
link with nothing. Rows with a null id link with nothing and have a null
component. Rows that share id and text are one document listed twice; rows that
share an id alone are documents of their own. Ids are of any type. An empty
table gives an empty result.
"""

from __future__ import annotations

from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import textscan as ts
from .common import shuffle_partitions, written
from .components import components

SHINGLE = 4
PERCENT = 85
SKIPPED = 0.3            # costliest segments left out, as a share of H + 1
FLUSH = 1 << 18          # signatures per block
HOT = 64                 # rows of one signature in a block that go to a partition of their own
GROUP_BLOCK = 2048       # members compared at once
LISTED_GROUP = 32        # members from which on a group's pairs are told apart by signature lists
LISTED = 64              # signatures in a member's list
SEPARATOR = ts.separators(lambda b: b != 32 and not 9 <= b <= 13)
FOLD = ts.fold_ascii()
U64 = ts.U64
_STEP = U64(0xD1342543DE82EF95)
SKETCH = [f"s{i}" for i in range(8)]


def bound(sizes: int, percent: int) -> int:
    """H for two sets of that many hashes together."""
    return (100 - percent) * sizes // (100 + percent)


@lru_cache(maxsize=None)
def band_edges(percent: int) -> np.ndarray:
    """Smallest size of each band, far beyond any text."""
    edges = [1]
    while edges[-1] < 1 << 40:
        edges.append(max(edges[-1] + 1, -(-edges[-1] * 100 // percent)))
    return np.array(edges, dtype=np.int64)


def allocate(band: int, classes: int, percent: int = PERCENT) -> tuple[str, int, int]:
    """(allocation, segments, segments left out) of a band's scheme.

    Cost per set: its signatures, plus the unrelated sets it meets. Of the
    band's classes one in a thousand is taken to share a quarter of its hashes,
    which makes a segment of x hashes meet it with probability 0.25 ** x."""
    edges = band_edges(percent)
    low, high = int(edges[band]), int(edges[band + 1]) - 1
    h = bound(high + high * 100 // percent, percent)
    left = int(SKIPPED * (h + 1))
    exact, deletion = h + 1 + left, (h + 2) // 2
    meet = lambda m, x: classes / 1000 * m * 0.25 ** x
    if deletion + low + meet(deletion, low / deletion) < h + 1 + meet(h + 1, 1.2 * low / exact):
        return "deletion", deletion, 0
    return "exact", exact, left


def shingle_sets(batch: pa.RecordBatch, text: str, shingle: int):
    """(row, sorted distinct shingle hashes) of every row of a batch."""
    row = 0
    for part in ts.slices(batch, text):
        words = ts.scan(part.column(text), SEPARATOR, FOLD)
        h = words.hashes()
        n = max(0, len(h) - shingle + 1)
        rolled = h[:n].copy()
        for j in range(1, shingle):
            rolled = rolled * _STEP + h[j:j + n]
        rolled = ts.mix(rolled)
        for first, last in zip(words.first[:-1].tolist(), words.first[1:].tolist()):
            if last - first >= shingle:
                yield row, np.unique(rolled[first:last - shingle + 1])
            elif last > first:
                one = np.array([last - first], dtype=U64)
                for i in range(first, last):
                    one = one * _STEP + h[i:i + 1]
                yield row, ts.mix(one ^ U64(0xA0761D6478BD642F))
            else:
                yield row, rolled[:0]
            row += 1


def set_key(s: np.ndarray) -> tuple[int, bytes]:
    """(64-bit key, 128-bit key that starts with it) of a set."""
    a, b = (int(ts.mix(s ^ U64(c)).sum(dtype=U64)) for c in (0x1D8E4E27C47D124F, 0xEB44ACCAB455D165))
    return a - (1 << 64) if a >> 63 else a, a.to_bytes(8, "big") + b.to_bytes(8, "big")


class Scheme:
    """Segment ranges and signature salts of one band."""

    def __init__(self, band: int, kind: str, segments: int, left: int):
        self.kind, self.keep = kind, segments - left
        self.range = np.array([(i << 64) // segments for i in range(segments)], dtype=U64)
        self.index = np.arange(segments)
        self.salt = ts.mix(self.index.astype(U64) + U64((band + 1) << 32))

    def signatures(self, s: np.ndarray, mixed: np.ndarray, sums: np.ndarray) -> np.ndarray:
        at = np.append(np.searchsorted(s, self.range), len(s))
        size = np.diff(at)
        total = sums[at[1:]] - sums[at[:-1]]
        if self.kind == "exact":
            if self.keep < len(size):
                kept = np.lexsort((self.index, -size))[: self.keep]
                return ts.mix(total[kept] + self.salt[kept])
            return ts.mix(total + self.salt)
        of = np.repeat(self.index, size)
        return np.concatenate([ts.mix(total + self.salt), ts.mix(total[of] - mixed + self.salt[of])])


def _classes(shingle: int):
    def run(batches):
        for batch in batches:
            n, keys = [], []
            for _, s in shingle_sets(batch, "text", shingle):
                n.append(len(s))
                keys.append(set_key(s)[1] if len(s) else None)
            yield pa.RecordBatch.from_arrays([batch.column("id"), batch.column("mark"), pa.array(n, pa.int64()), pa.array(keys, pa.binary())], names=["id", "mark", "n", "key"])

    return run


def _signatures(shingle: int, percent: int, schemes: dict[int, tuple[str, int, int]], parts: int):
    names = ["part", "signatures", "keys"]

    def run(batches):
        from pyspark import TaskContext

        made: dict[int, Scheme] = {}
        edges = band_edges(percent)
        seen: set[bytes] = set()
        sigs: list[np.ndarray] = []
        owners: list[np.ndarray] = []
        held, flushes = 0, 0

        def flush():
            nonlocal held, flushes
            sig, key = np.concatenate(sigs), np.concatenate(owners)
            sigs.clear()
            owners.clear()
            held, flushes = 0, flushes + 1
            order = np.lexsort((key.view(U64), sig))
            sig, key = sig[order], key[order]
            first = np.flatnonzero(np.append(True, sig[1:] != sig[:-1]))
            size = np.diff(np.append(first, len(sig)))
            salt = np.where(np.repeat(size, size) > HOT, U64((TaskContext.get().partitionId() << 20) + flushes), U64(0))
            marks = first[size > HOT]  # the smallest key of each hot signature also goes the common way
            sig, key = np.append(sig, sig[marks]), np.append(key, key[marks])
            dest = ts.mix(sig ^ ts.mix(np.append(salt, np.zeros(len(marks), U64))))
            part = ((dest >> U64(32)) * U64(parts) >> U64(32)).astype(np.int32)
            order = np.argsort(part, kind="stable")
            part, sig, key = part[order], sig[order], key[order]
            first = np.flatnonzero(np.append(True, part[1:] != part[:-1]))
            last = np.append(first[1:], len(part))
            for lo in range(0, len(first), 256):
                spans = list(zip(first[lo:lo + 256].tolist(), last[lo:lo + 256].tolist()))
                yield pa.RecordBatch.from_arrays([
                    pa.array(part[first[lo:lo + 256]]),
                    pa.array([sig[a:b].tobytes() for a, b in spans], pa.binary()),
                    pa.array([key[a:b].tobytes() for a, b in spans], pa.binary())], names=names)

        for batch in batches:
            for _, s in shingle_sets(batch, "text", shingle):
                if not len(s):
                    continue
                key, long_key = set_key(s)
                if long_key in seen:
                    continue
                seen.add(long_key)
                mixed = ts.mix(s ^ U64(0x8EBC6AF09C88C6E3))
                sums = np.zeros(len(s) + 1, dtype=U64)
                np.cumsum(mixed, out=sums[1:])
                band = int(np.searchsorted(edges, len(s), side="right")) - 1
                for b in (band, band - 1):
                    if b not in schemes:  # no class of that band: no pair
                        continue
                    if b not in made:
                        made[b] = Scheme(b, *schemes[b])
                    sigs.append(made[b].signatures(s, mixed, sums))
                    owners.append(np.full(len(sigs[-1]), key, dtype=np.int64))
                    held += len(sigs[-1])
                if held >= FLUSH:
                    yield from flush()
        if held:
            yield from flush()

    return run


def _groups(batches):
    """Signatures that two sets or more share: (signature, key, smallest key of the group)."""
    blocks: dict[int, list] = {}
    for batch in batches:
        for part, sig, key in zip(batch.column("part").to_pylist(), batch.column("signatures").to_pylist(), batch.column("keys").to_pylist()):
            blocks.setdefault(part, []).append((sig, key))
    while blocks:
        _, got = blocks.popitem()
        sig = np.frombuffer(b"".join(x for x, _ in got), dtype=U64)
        key = np.frombuffer(b"".join(x for _, x in got), dtype=U64)
        order = np.lexsort((key, sig))
        sig, key = sig[order], key[order]
        new = np.append(True, (sig[1:] != sig[:-1]) | (key[1:] != key[:-1]))
        sig, key = sig[new], key[new]
        first = np.flatnonzero(np.append(True, sig[1:] != sig[:-1]))
        size = np.diff(np.append(first, len(sig)))
        shared = np.repeat(size > 1, size)
        pivot = np.repeat(key[first], size)[shared]
        for lo in range(0, len(pivot), 1 << 17):
            at = slice(lo, lo + (1 << 17))
            yield pa.RecordBatch.from_arrays([pa.array(x[at].view(np.int64)) for x in (sig[shared], key[shared], pivot)], names=["sig", "key", "pivot"])


def _sets(shingle: int):
    """The sets of wanted classes with their sketches."""
    names = ["key", "long_key", "n", *SKETCH, "hashes"]

    def run(batches):
        seen: set[bytes] = set()
        for batch in batches:
            wanted, rows, size = batch.column("key").to_pylist(), [], 0
            for row, s in shingle_sets(batch, "text", shingle):
                if not len(s):
                    continue
                key, long_key = set_key(s)
                if long_key != wanted[row] or long_key in seen:  # another text under the same id, or the same again
                    continue
                seen.add(long_key)
                odd = np.bincount((s & U64(511)).astype(np.int64), minlength=512) & 1
                rows.append((key, long_key, len(s), *np.packbits(odd.astype(np.uint8)).view(np.int64).tolist(), s.view(np.int64)))
                size += len(s)
                if size > 1 << 19:
                    yield pa.RecordBatch.from_arrays([pa.array(c, pa.list_(pa.int64())) if n == "hashes" else pa.array(c, pa.binary() if n == "long_key" else pa.int64()) for n, c in zip(names, zip(*rows))], names=names)
                    rows, size = [], 0
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.list_(pa.int64())) if n == "hashes" else pa.array(c, pa.binary() if n == "long_key" else pa.int64()) for n, c in zip(names, zip(*rows))], names=names)

    return run


def _cross(percent: int):
    """Pairs of members of different components whose sizes and sketches allow a link."""
    names = ["a", "b"]

    def compare(rows: dict[str, np.ndarray]):
        lab = np.unique(rows["lab"], return_inverse=True)[1]
        n, side, sketch, key = rows["n"], rows["blk"], rows["sketch"], rows["long_key"]
        sig, listed = rows["sig"][0], [None if x is None else frozenset(x.tolist()) for x in rows["listed"]]
        same = rows["bi"][0] == rows["bj"][0]
        left = np.arange(len(n)) if same else np.flatnonzero(side == rows["bi"][0])
        right = left if same else np.flatnonzero(side == rows["bj"][0])
        for lo in range(0, len(left), 64):
            i = left[lo:lo + 64]
            far = np.zeros((len(i), len(right)), dtype=np.int64)
            for w in range(sketch.shape[1]):
                far += np.bitwise_count(sketch[i, w][:, None] ^ sketch[right, w][None, :])
            both = n[i][:, None] + n[right][None, :]
            h = (100 - percent) * both // (100 + percent)
            ok = (far <= h) & (np.abs(n[i][:, None] - n[right][None, :]) <= h) & (lab[i][:, None] != lab[right][None, :])
            if same:
                ok &= i[:, None] < right[None, :]
            for x, y in zip(*np.nonzero(ok)):
                a, b = key[i[x]], key[right[y]]
                if listed[i[x]] is not None and min(listed[i[x]] & listed[right[y]], default=sig) < sig:
                    continue  # leaves the group of that signature
                yield (a, b) if a < b else (b, a)

    def run(batches):
        found: set[tuple[bytes, bytes]] = set()
        held: dict[str, np.ndarray] | None = None

        def out():
            pairs = sorted(found)
            found.clear()
            return pa.RecordBatch.from_arrays([pa.array(c, pa.binary()) for c in zip(*pairs)], names=names)

        for batch in batches:
            rows = {c: batch.column(c).to_numpy(zero_copy_only=False) for c in ("sig", "bi", "bj", "blk", "n", "lab", "long_key", "listed")}
            rows["sketch"] = np.column_stack([batch.column(c).to_numpy() for c in SKETCH]).view(U64) if batch.num_rows else np.zeros((0, 8), U64)
            if held is not None:
                rows = {c: np.concatenate([held[c], rows[c]]) for c in rows}
            total = len(rows["sig"])
            if not total:
                continue
            new = np.append(True, (rows["sig"][1:] != rows["sig"][:-1]) | (rows["bi"][1:] != rows["bi"][:-1]) | (rows["bj"][1:] != rows["bj"][:-1]))
            first = np.append(np.flatnonzero(new), total)
            for lo, hi in zip(first[:-2].tolist(), first[1:-1].tolist()):  # the last group may go on
                found.update(compare({c: x[lo:hi] for c, x in rows.items()}))
                if len(found) > 100_000:
                    yield out()
            held = {c: x[first[-2]:].copy() for c, x in rows.items()}
        if held is not None:
            found.update(compare(held))
        if found:
            yield out()

    return run


def _verified(pairs: DataFrame, sets: DataFrame, by: str, percent: int) -> DataFrame:
    """Links (a, b: 128-bit keys) among pairs (a, b) of class keys ``by``."""
    narrow = sets.select("key", "long_key", "n", *SKETCH)
    side = lambda p, *cols: sets.select(*[F.col(c).alias(p + c) for c in cols])
    cols = ["long_key", "n", *SKETCH]
    near = pairs.join(narrow.select(F.col(by).alias("a"), *[F.col(c).alias("a_" + c) for c in cols]), "a").join(narrow.select(F.col(by).alias("b"), *[F.col(c).alias("b_" + c) for c in cols]), "b")
    h = F.expr(f"({100 - percent} * (a_n + b_n)) div {100 + percent}")
    far = sum((F.bit_count(F.col("a_" + c).bitwiseXOR(F.col("b_" + c))) for c in SKETCH), F.lit(0))
    near = near.where((F.abs(F.col("a_n") - F.col("b_n")) <= h) & (far <= h)).select("a_long_key", "b_long_key", "a_n", "b_n")
    full = near.join(side("a_", "long_key", "hashes"), "a_long_key").join(side("b_", "long_key", "hashes"), "b_long_key")
    common = F.size(F.array_intersect("a_hashes", "b_hashes")).cast("long")
    return full.where(100 * common >= percent * (F.col("a_n") + F.col("b_n") - common)).select(F.col("a_long_key").alias("a"), F.col("b_long_key").alias("b"))


def _components(docs: DataFrame, id_col: str, text_col: str, *, shingle: int = SHINGLE, percent: int = PERCENT, allocation: str | None = None) -> DataFrame:
    """Per row: id, mark (hash of the text), n, component_id, and ``first``: whether
    the row is its component's document of the smallest id (of these the smallest
    set key)."""
    spark = docs.sparkSession
    src = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    marked = src.withColumn("mark", F.xxhash64("text"))
    known = written(marked.mapInArrow(_classes(shingle), f"id {src.schema['id'].dataType.simpleString()}, mark long, n long, key binary"), "jaccard-documents")
    classes = written(known.where("key IS NOT NULL AND id IS NOT NULL").groupBy("key").agg(F.min("id").alias("id"), F.first("n").alias("n")), "jaccard-classes")

    edges = band_edges(percent)
    band = F.aggregate(F.array(*[F.lit(int(e)) for e in edges]), F.lit(-1), lambda a, e: a + F.when(F.col("n") >= e, 1).otherwise(0)).alias("band")
    counts = {r.band: (r.classes, r.hashes) for r in classes.select(band, "n").groupBy("band").agg(F.count(F.lit(1)).alias("classes"), F.sum("n").alias("hashes")).collect()}
    schemes = {}
    for b, (n, _) in counts.items():
        schemes[b] = allocate(b, n, percent)
        if allocation and allocation != schemes[b][0]:
            h = bound(int(edges[b + 1] - 1) * (100 + percent) // percent, percent)
            left = int(SKIPPED * (h + 1))
            schemes[b] = ("exact", h + 1 + left, left) if allocation == "exact" else ("deletion", (h + 2) // 2, 0)
    hashes = sum(x for _, x in counts.values())
    per_hash = 2 if any(x[0] == "deletion" for x in schemes.values()) else 0.4
    parts = 2 * shuffle_partitions(spark, rows=int(per_hash * hashes), rows_per_task=4_000_000)

    blocks = src.where("id IS NOT NULL").mapInArrow(_signatures(shingle, percent, schemes, parts), "part int, signatures binary, keys binary")
    groups = written(blocks.repartition(parts, "part").mapInArrow(_groups, "sig long, key long, pivot long"), "jaccard-groups")

    # The sets of the classes that share a signature, read once more from one document of each.
    members = groups.select("key").distinct().withColumnRenamed("key", "short")
    short = F.conv(F.hex(F.substring("key", 1, 8)), 16, -10).cast("long")
    wanted = classes.select("id", "key", short.alias("short")).join(members, "short", "left_semi").select("id", "key")
    sets = written(src.join(wanted.hint("shuffle_hash"), "id").select("text", "key").mapInArrow(_sets(shingle), "key long, long_key binary, n long, " + ", ".join(f"{c} long" for c in SKETCH) + ", hashes array<long>").dropDuplicates(["long_key"]), "jaccard-sets")  # rows that repeat an id and its text: one set

    star = written(groups.where("key <> pivot").select(F.col("key").alias("a"), F.col("pivot").alias("b")).distinct(), "jaccard-star")
    links = written(_verified(star, sets, "key", percent), "jaccard-links")
    label = components(links)

    named = written(sets.select("key", "long_key").distinct().join(label.withColumnRenamed("id", "long_key"), "long_key", "left").select("key", "long_key", F.coalesce("lab", "long_key").alias("lab")), "jaccard-named")
    members = written(groups.select("sig", "key").distinct().join(named, "key").select("sig", "long_key", "lab"), "jaccard-members")
    mixed = written(members.groupBy("sig").agg(F.min("lab").alias("low"), F.max("lab").alias("high"), F.count(F.lit(1)).alias("g")).where("low <> high").select("sig", (F.col("g") > LISTED_GROUP).alias("large"), F.ceil(F.col("g") / GROUP_BLOCK).cast("int").alias("blocks")), "jaccard-mixed")
    open_ = written(members.join(mixed, "sig"), "jaccard-open")
    lists = open_.where("large").groupBy("long_key").agg(F.slice(F.sort_array(F.collect_set("sig")), 1, LISTED).alias("listed"))
    plain = sets.select("long_key", "n", *SKETCH)
    open_ = open_.where("NOT large").withColumn("listed", F.lit(None).cast("array<bigint>")).unionByName(open_.where("large").join(lists, "long_key")).join(plain, "long_key")
    open_ = open_.withColumn("blk", F.pmod(F.xxhash64("long_key"), F.col("blocks")).cast("int")).withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    open_ = open_.select("sig", F.least("blk", "other").alias("bi"), F.greatest("blk", "other").alias("bj"), "blk", "n", "lab", "long_key", "listed", *SKETCH)
    pairs = open_.repartition(shuffle_partitions(spark), "sig", "bi", "bj").sortWithinPartitions("sig", "bi", "bj").mapInArrow(_cross(percent), "a binary, b binary")
    crossed = written(_verified(written(pairs.distinct(), "jaccard-cross"), sets, "long_key", percent), "jaccard-cross-links")

    # Components of the components.
    of = label.select(F.col("id"), F.col("lab"))
    up = lambda df, c: df.join(of.select(F.col("id").alias(c), F.col("lab").alias("to_" + c)), c, "left").withColumn(c, F.coalesce("to_" + c, c)).drop("to_" + c)
    top = components(up(up(crossed, "a"), "b"))
    named = named.select("long_key", "lab").distinct().join(top.select(F.col("id").alias("lab"), F.col("lab").alias("top")), "lab", "left").select(F.col("long_key").alias("key"), F.coalesce("top", "lab").alias("root"))
    root = written(classes.join(named, "key", "left").select("key", "id", F.coalesce("root", "key").alias("root")), "jaccard-roots")
    least = written(root.groupBy("root").agg(F.min(F.struct("id", "key")).alias("least")), "jaccard-least")
    component = written(root.join(least, "root").select("key", F.col("least.id").alias("component_id"), F.col("least.key").alias("first_key")), "jaccard-components")
    linked = known.where("key IS NOT NULL AND id IS NOT NULL").join(component, "key").select("id", "mark", "n", "component_id", ((F.col("id") == F.col("component_id")) & (F.col("key") == F.col("first_key"))).alias("first"))
    alone = known.where("key IS NULL OR id IS NULL").select("id", "mark", "n", F.col("id").alias("component_id"), F.lit(True).alias("first"))
    return linked.unionAll(alone)


def join_components(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """Per row: id, n_shingles, component_id (smallest id reachable by links).

    Options: ``shingle``, ``percent``, and for tests ``allocation`` ('exact' or
    'deletion' in place of the cost model's choice)."""
    return _components(docs, id_col, text_col, **options).select(F.col("id").alias(id_col), F.col("n").alias("n_shingles"), "component_id")


def representatives(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """The documents without near copies: of each component the one with the smallest id stays.

    A document is its id and text: of two texts under one id each stays or goes by
    itself, also when they are near copies of each other; rows that repeat both
    stay or go together."""
    found = _components(docs, id_col, text_col, **options)
    drop = written(found.where(~F.col("first")).select(F.col("id").alias("drop_id"), "mark").distinct(), "jaccard-drop")
    columns = [F.col(f"d.`{c}`") for c in docs.columns]
    return docs.alias("d").join(drop.alias("x"), (F.col(f"d.`{id_col}`") == F.col("x.drop_id")) & (F.xxhash64(F.col(f"d.`{text_col}`").cast("string")) == F.col("x.mark")), "left_anti").select(*columns)

"""Benchmark windows and the Jaccard join against brute force."""
import random
import re

import pytest
from conftest import SF_SMALL

from tidewatch.llm import decontaminate, jaccard_join
from tidewatch.llm.components import components

from .conftest import EDGE
from .test_dedup_warc import lower

WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def brute_hits(rows, items, n=10):
    windows = {}
    for item, t in items:
        w = re.findall(WORD, lower(t))
        size = min(n, len(w))
        for i in range(len(w) - size + 1 if w else 0):
            windows.setdefault(tuple(w[i:i + size]), set()).add("null" if item is None else str(item))
    out = []
    for d, t in rows:
        w = re.findall(WORD, lower(t))
        hit, ids = set(), set()
        for size in {len(k) for k in windows}:
            for i in range(len(w) - size + 1):
                found = windows.get(tuple(w[i:i + size]))
                if found:
                    hit.update(range(i, i + size))
                    ids |= found
        out.append((d, len(w), len(hit), len(ids), sorted(ids), bool(hit)))
    return sorted(out, key=str)


def bench_of(spark, items):
    return spark.createDataFrame([(i, t, 1) for i, t in items], "item_id long, text string, id int")


PASSAGE = " ".join(f"p{i}" for i in range(25))
ITEMS = [(1, PASSAGE), (2, "Short Item"), (3, None), (4, "..."), (5, PASSAGE + " tail"), (None, "null item here"), (10, "北京 😀"), (1, "another text of item one"), (6, "x " * 12)]
TEXTS = [*EDGE, (20, "before, " + PASSAGE.upper() + "; after"), (21, "p0 p1 p2 p3 p4 p5 p6 p7 p8"), (22, "a short-item! b"), (23, "x " * 11), (24, "a null, item here. short item" + " gap" * 50 + " " + PASSAGE[9:60])]


@pytest.mark.parametrize("block_words", [4_000_000, 12])
def test_hits(spark, docs_of, block_words):
    got = decontaminate.report(docs_of(TEXTS).repartition(3), bench_of(spark, ITEMS), block_words=block_words)
    rows = got.select("doc_id", "n_words", "n_hit", "n_items", "items", "contaminated").collect()
    assert sorted(((*r[:4], list(r[4]), r[5]) for r in rows), key=str) == brute_hits(TEXTS, ITEMS)


def test_blocks_and_long_items(spark, docs_of, monkeypatch):
    monkeypatch.setattr(decontaminate, "CHUNK_WORDS", 7)
    got = decontaminate.report(docs_of(TEXTS), bench_of(spark, ITEMS), block_words=20).select("doc_id", "n_words", "n_hit", "n_items", "items", "contaminated").collect()
    assert sorted(((*r[:4], list(r[4]), r[5]) for r in got), key=str) == brute_hits(TEXTS, ITEMS)


def test_actions(spark, docs_of):
    bench = bench_of(spark, ITEMS)
    clean = decontaminate.decontaminate(docs_of(TEXTS), bench)
    want = sorted((r[0] for r in brute_hits(TEXTS, ITEMS) if not r[5]), key=str)
    assert clean.columns == docs_of([]).columns and sorted((r.doc_id for r in clean.collect()), key=str) == want
    cut = {r.doc_id: r.text for r in decontaminate.decontaminate(docs_of(TEXTS), bench, action="span").collect()}
    assert cut[20] == "before, ; after" and cut[22] == "a ! b" and cut[21] == TEXTS[-4][1] and cut[1] is None
    assert cut[9].endswith("straße  text")
    with pytest.raises(ValueError):
        decontaminate.decontaminate(docs_of([]), bench, action="x")


def test_empty_sides(spark, docs_of):
    assert decontaminate.report(docs_of([]), bench_of(spark, ITEMS)).collect() == []
    got = decontaminate.report(docs_of(TEXTS), bench_of(spark, [])).select("doc_id", "n_words", "n_hit").collect()
    assert {r.n_hit for r in got} == {0} and {r.doc_id: r.n_words for r in got}[15] == 10


# ---- Jaccard join

def shingles(t, k=4):
    w = re.findall(r"[^\x20\x09-\x0D]+", lower(t))
    return {tuple(w[i:i + k]) for i in range(len(w) - k + 1)} if len(w) >= k else {tuple(w)} if w else set()


def brute_components(rows, percent=85, k=4):
    sets = [shingles(t, k) for _, t in rows]
    up = list(range(len(rows)))

    def top(x):
        while up[x] != x:
            x = up[x]
        return x

    for i in range(len(rows)):
        for j in range(i):
            a, b = sets[i], sets[j]
            if a and b and rows[i][0] is not None and rows[j][0] is not None and 100 * (c := len(a & b)) >= percent * (len(a) + len(b) - c):
                up[top(i)] = top(j)
    least = {}
    for i, (d, _) in enumerate(rows):
        if d is not None:
            least[top(i)] = min(d, least.get(top(i), d))
    return sorted(((d, len(sets[i]), least[top(i)] if d is not None else None) for i, (d, _) in enumerate(rows)), key=str)


def near_copies(seed=5):
    """Groups of edited copies around the threshold, of sets of many sizes, and unrelated texts."""
    random.seed(seed)
    vocabulary = [f"v{i}" for i in range(400)]
    rows, common = [], [random.choice(vocabulary) for _ in range(30)]
    for g in range(14):
        base = [random.choice(vocabulary) for _ in range(random.choice((3, 4, 5, 6, 9, 14, 25, 40, 80, 150, 400)))]
        for _ in range(random.choice((1, 2, 3, 8, 20))):
            text = list(base)
            for _ in range(random.randint(0, max(1, len(base) // 30))):
                at = random.randrange(len(text))
                if random.random() < 0.5:
                    text[at] = random.choice(vocabulary)
                else:
                    text[at:at] = [random.choice(vocabulary)]
            if random.random() < 0.2:
                text += common
            rows.append((len(rows) * 3 % 1009, " ".join(text)))
    return rows


@pytest.mark.parametrize("allocation", [None, "exact", "deletion"])
def test_components(spark, docs_of, allocation):
    rows = near_copies() + [(i and i + 5000, t) for i, t in EDGE]
    got = jaccard_join.join_components(docs_of(rows).repartition(5), allocation=allocation).collect()
    assert sorted(map(tuple, got), key=str) == brute_components(rows)


def test_hot_signatures_and_blocks(spark, docs_of, monkeypatch):
    """Small bounds: hot signatures in partitions of their own, groups compared in blocks."""
    monkeypatch.setattr(jaccard_join, "GROUP_BLOCK", 4)
    rows = near_copies(6) + near_copies(6)[:40]
    rows = [(i, t) for i, (_, t) in enumerate(rows)]
    got = jaccard_join.join_components(docs_of(rows).repartition(3)).collect()
    assert sorted(map(tuple, got), key=str) == brute_components(rows)


def test_flush_sends_hot_signatures_apart(monkeypatch):
    """Every shared signature survives the split of hot ones, with no part holding them whole."""
    import numpy as np
    import pyarrow as pa
    import pyspark

    monkeypatch.setattr(jaccard_join, "HOT", 4)
    monkeypatch.setattr(jaccard_join, "FLUSH", 300)
    monkeypatch.setattr(pyspark.TaskContext, "get", staticmethod(lambda: type("T", (), {"partitionId": staticmethod(lambda: 3)})))
    base = [f"b{i}" for i in range(60)]
    texts = [" ".join(base[:50] + [f"x{i}"] + base[50:]) for i in range(40)]
    schemes = {b: jaccard_join.allocate(b, 40) for b in range(40)}
    blocks = list(jaccard_join._signatures(4, 85, schemes, 64)(iter([pa.RecordBatch.from_pydict({"text": texts})])))
    load = {}
    for b in blocks:
        for part, sigs in zip(b.column("part").to_pylist(), b.column("signatures").to_pylist()):
            values, counts = np.unique(np.frombuffer(sigs, "<u8"), return_counts=True)
            load[part] = max(load.get(part, 0), int(counts.max()))
    assert len({p for p, m in load.items() if m > 4}) > 1
    found, want = {}, {}
    for g in jaccard_join._groups(iter(blocks)):
        for s, k, p in zip(*(c.to_pylist() for c in g.columns)):
            found.setdefault(s, set()).add(k)
    monkeypatch.setattr(jaccard_join, "HOT", 10**9)  # the same without any split
    for b in jaccard_join._signatures(4, 85, schemes, 64)(iter([pa.RecordBatch.from_pydict({"text": texts})])):
        for sigs, keys in zip(b.column("signatures").to_pylist(), b.column("keys").to_pylist()):
            for x, k in zip(np.frombuffer(sigs, "<i8").tolist(), np.frombuffer(keys, "<i8").tolist()):
                want.setdefault(x, set()).add(k)
    assert max(map(len, want.values())) > 20
    assert found == {x: k for x, k in want.items() if len(k) > 1}


def test_allocation_covers_every_pair():
    """Segments and left-out segments fulfil the pigeonhole bound in every band."""
    edges = jaccard_join.band_edges(85)
    for band in range(60):
        low, high = int(edges[band]), int(edges[band + 1]) - 1
        worst = max(jaccard_join.bound(a + b, 85) for a in {low, high} for b in (a, a * 100 // 85))
        for classes in (10, 10**6, 10**10):
            kind, m, left = jaccard_join.allocate(band, classes)
            assert m - left >= worst + 1 if kind == "exact" else 2 * m >= worst + 1
    assert jaccard_join.allocate(30, 10**10)[0] == "deletion"


def test_representatives(spark, docs_of):
    rows = near_copies(8)
    kept = jaccard_join.representatives(docs_of(rows))
    assert kept.columns == docs_of([]).columns
    assert sorted(r.doc_id for r in kept.collect()) == sorted({c for _, _, c in brute_components(rows)} & {d for d, _, c in brute_components(rows) if d == c})


def test_empty_and_alone(spark, docs_of):
    assert jaccard_join.join_components(docs_of([])).collect() == []
    assert [tuple(r) for r in jaccard_join.join_components(docs_of([(5, None)])).collect()] == [(5, 0, 5)]


def test_components_of_a_long_chain(spark):
    edges = [(i, i + 1) for i in range(200)] + [(1000, 1000 + i) for i in range(1, 50)]
    random.shuffle(edges)
    got = {r.id: r.lab for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {**{i: 0 for i in range(201)}, **{1000 + i: 1000 for i in range(50)}}


def test_small_table_brute_force(spark):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    assert sorted(map(tuple, jaccard_join.join_components(docs).collect()), key=str) == brute_components(rows)

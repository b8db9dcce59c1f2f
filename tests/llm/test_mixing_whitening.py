"""Mixing and whitening against brute force, with edge cases."""
import math
import random

import numpy as np
import pytest
from conftest import SF_SMALL
from pyspark.sql import functions as F

from tidewatch.llm import mixing, whitening
from tidewatch.llm.prefix_sums import running_sum

from .conftest import EDGE


def test_running_sum(spark):
    random.seed(3)
    rows = [(None if i % 11 == 0 else "hot" if i % 3 else f"k{i % 7}", i, random.randrange(5)) for i in range(3000)]
    df = spark.createDataFrame(rows, "k string, o long, v long").repartition(9)
    placed, blocks = running_sum(df, "k", [F.col("o")], "v", "test-sums")
    p, b = placed.collect(), {(r.block, r.k): (r.here, r.earlier) for r in blocks.collect()}
    want, seen = {}, {}
    for k, o, v in sorted(rows, key=lambda r: r[1]):
        want[o] = seen.get(k, 0)
        seen[k] = want[o] + v
    assert {r.o: b[r.block, r.k][1] + r.before for r in p} == want
    assert len({r.row_no for r in p}) == len(rows)
    assert len({r.block for r in p if r.k == "hot"}) > 1


@pytest.mark.parametrize("n", [1, 2, 3, 5, 16, 17, 1000, 70001])
def test_permutation(n):
    place = mixing.permute(np.arange(n), n, 12345 * n)
    assert sorted(place) == list(range(n))
    assert (mixing.permute(place, n, 12345 * n, back=True) == np.arange(n)).all()


def test_slots_of_every_quota():
    for size in (1, 3, 4, 5, 11, 12, 13):
        n = -(-size // 4)
        def key(turn):
            return 77 + turn
        order = [int(b) for turn in range(3) for b in mixing.permute(np.arange(n), n, key(turn))]
        words = [size - 4 * (n - 1) if b == n - 1 else 4 for b in order]
        for quota in range(3 * size + 1):
            k, last = mixing.slots_of(quota, size, 4, key)
            assert sum(words[:k - 1]) + last == quota if quota else k == 0
            assert quota == 0 or 0 < last <= words[k - 1]


def shares(sizes, cap=3):
    """Targets by resharing until none is above."""
    names = sorted((s for s in sizes if s is not None), key=lambda s: s.encode()) + [None] * (None in sizes)
    weight = {s: 1 + i % 3 for i, s in enumerate(names)}
    target, left, open_ = {}, sum(sizes.values()), set(names)
    while open_:
        w = sum(weight[s] for s in open_)
        over = [s for s in open_ if left * weight[s] / w >= cap * sizes[s]]
        if not over:
            return target | {s: left * weight[s] / w for s in open_}
        for s in over:
            target[s] = float(cap * sizes[s])
            open_.discard(s)
        left = sum(sizes.values()) - sum(target.values())
    return target


def check_mix(rows, m):
    taken = m.taken().collect()
    assert sorted(((r.id, r["size"]) for r in taken), key=str) == sorted(((i, len(split(t))) for i, s, t in rows), key=str)
    sizes = {}
    for i, s, t in rows:
        sizes[s] = sizes.get(s, 0) + len(split(t))
    want = shares(sizes)
    d = {r.row_no: r for r in m.documents.collect()}
    for r in m.sources.collect():
        assert r.source_size == sizes[r.source] and math.isclose(r.target, want[r.source], rel_tol=1e-9, abs_tol=1e-9)
        assert abs(r.quota - r.target) <= 0.5
    assert all(0 <= r.taken <= 3 * r["size"] for r in taken)
    spans, by_row, by_source = m.sequences().collect(), {}, {}
    for r in spans:
        doc = d[r.row_no]
        assert 0 <= r.first_word and r.first_word + r.n_words <= doc["size"] and r.n_words > 0
        by_row[r.row_no] = by_row.get(r.row_no, 0) + r.n_words
        by_source[doc.source] = by_source.get(doc.source, 0) + r.n_words
    assert sorted((d[k].id, v) for k, v in by_row.items() if d[k].id is not None) == sorted((r.id, r.taken) for r in taken if r.taken and r.id is not None)
    for r in m.sources.collect():
        assert by_source.get(r.source, 0) == r.quota
    return sorted(map(tuple, taken), key=str), spans


def split(t):
    import re
    return re.findall(r"[^\x20\x09-\x0D]+", t or "")


def test_mix_edges(spark):
    rows = [(i, s, t) for k, (i, t) in enumerate(EDGE) for s in [["b", "a", None, "ä", "Z", "c"][k % 6]]] + [(1, "tiny", "one"), (1, "tiny", "one"), (2, "wordless", " ")]
    kind = "doc_id long, source string, text string, idx int, block int, size string, before int, row_no int"
    df = spark.createDataFrame([(i, s, t, 1, 2, "x", 3, 4) for i, s, t in rows], kind)
    # small blocks and shards: several passes, partial last blocks, slots handed on
    a, spans = check_mix(rows, mixing.mix(df, block=7, slots=16))
    b, again = check_mix(rows, mixing.mix(df.repartition(5), block=7, slots=16))
    assert a == b
    assert sorted((r.shard, r.position, r["at"], str(r.id), r.first_word, r.n_words) for r in spans) == sorted((r.shard, r.position, r["at"], str(r.id), r.first_word, r.n_words) for r in again)
    per_shard = {}
    for r in spans:
        per_shard.setdefault(r.shard, set()).add(r.position)
    assert all(len(v) == 16 for k, v in per_shard.items() if k < max(per_shard))
    other, _ = check_mix(rows, mixing.mix(df, block=7, slots=16, seed=5))
    assert other != a


def test_mix_string_ids_and_empty(spark):
    df = spark.createDataFrame([("x", "s", "a b c"), ("y", None, "d e"), (None, "s", None)], "doc_id string, source string, text string")
    assert {(r.id, r["size"]) for r in mixing.mix(df).taken().collect()} == {("x", 3), ("y", 2), (None, 0)}
    assert mixing.mix(df.where("false")).taken().collect() == []
    none = mixing.mix(df.select("doc_id", "source", F.lit("").alias("text"))).taken().collect()
    assert [(r.target, r.taken) for r in none] == [(0.0, 0)] * 3


def test_mix_documents(spark):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    rows = [(r.doc_id, r.source, r.text) for r in docs.collect()]
    check_mix(rows, mixing.mix(docs, block=64, slots=32))


def brute_whiten(rows, components=16):
    def fine(v):
        return v is not None and all(c is not None and math.isfinite(c) for c in v)
    kept = [(i, [math.floor(64 * float(c)) + 1_000_000 for c in v]) for i, v in rows if fine(v)]
    fit = sorted({tuple(x) for _, x in kept})
    n, total = len(fit), [sum(c) for c in zip(*fit)]
    d = np.array([[n * a - s for a, s in zip(x, total)] for x in fit], float) / n
    e, u = np.linalg.eigh(d.T @ d / n)
    e, u = e[::-1][:components], u[:, ::-1][:, :components]
    good = e > 1e-12 * e[0] if e[0] > 0 else np.zeros(len(e), bool)
    e, u = e[good], u[:, good]
    out = {}
    for i, x in kept:
        dev = [n * a - s for a, s in zip(x, total)]
        w = np.array(dev, float) / n @ u / np.sqrt(e)
        out.setdefault(i, []).append((n, sum(c * c for c in dev), w, e / np.trace(d.T @ d / n)))
    return out


def check_whiten(df, rows, **kw):
    got = whitening.whiten(df, **kw).collect()
    want = brute_whiten(rows, kw.get("components", 16))
    by = {}
    for r in got:
        by.setdefault((r.vec_id, r.component), []).append(r)
        assert r.identity_error < 1e-9
    k = len(next(iter(want.values()))[0][2])
    assert {c for _, c in by} == set(range(1, k + 1)) and len(got) == k * sum(map(len, want.values()))
    sign = {}
    for c in range(k):
        i = next(iter(want))
        sign[c] = 1 if abs(by[i, c + 1][0].whitened - want[i][0][2][c]) < abs(by[i, c + 1][0].whitened + want[i][0][2][c]) else -1
    for i, rs in want.items():
        for c in range(k):
            a = sorted((r.n, int(r.deviation), round(r.whitened * sign[c], 6)) for r in by[i, c + 1])
            b = sorted((n, d, round(float(w[c]), 6)) for n, d, w, _ in rs)
            assert all(x[:2] == y[:2] and abs(x[2] - y[2]) < 1e-5 for x, y in zip(a, b)) and len(a) == len(b)
            assert abs(by[i, c + 1][0].explained - rs[0][3][c]) <= 1e-9


def test_whiten_edges(spark):
    rng = np.random.default_rng(1)
    rows = [(i, (rng.standard_normal(6) * np.array([9, 5, 3, 2, 1, 0.5])).tolist()) for i in range(300)]
    rows += [(7, rows[3][1])] * 50 + [(None, rows[4][1]), (900, None), (901, [1.0] * 5 + [None]), (902, [float("nan")] * 6), (903, [float("inf")] * 6)]
    kind = "vec_id long, embedding array<double>, n int, component int, x string, id int, v int"
    df = spark.createDataFrame([(i, v, 1, 1, "x", 1, 1) for i, v in rows], kind)
    check_whiten(df, rows, components=4)
    check_whiten(df, rows)
    odd = df.unionByName(spark.createDataFrame([(904, [1.0] * 5, 1, 1, "x", 1, 1), (905, [], 1, 1, "x", 1, 1), (906, [1e300] * 6, 1, 1, "x", 1, 1)], kind))
    check_whiten(odd, rows, components=3)
    assert whitening.whiten(df.where("false")).collect() == []
    assert whitening.whiten(df.where("vec_id = 7")).select("n").distinct().count() == 1
    assert whitening.whiten(df.where("vec_id = 5")).collect() == []


def test_whiten_table(spark):
    df = spark.read.parquet(f"{SF_SMALL}/embeddings.parquet")
    check_whiten(df, [(r.vec_id, r.embedding) for r in df.collect()])


def test_large_whole_numbers():
    x = np.array([[10**12, 1], [3, 4]])
    n, total = 10**8, [10**20 + 7, 5]
    d = whitening.exact_deviation(x, n, total)
    assert d.tolist() == [[10**20 - 10**20 - 7, 10**8 - 5], [3 * 10**8 - 10**20 - 7, 4 * 10**8 - 5]]
    assert whitening.squares(d) == [sum(int(c) ** 2 for c in r) for r in d.tolist()]


@pytest.mark.parametrize("dims,spread", [(400, 0.97), (300, 0.999), (64, 0.9999), (200, 0.5)])
def test_jacobi_davidson(dims, spread):
    rng = np.random.default_rng(dims)
    u, _ = np.linalg.qr(rng.standard_normal((dims, dims)))
    e = spread ** np.arange(dims)
    e[5] = e[4]  # a pair of equal eigenvalues
    v = (u * e) @ u.T
    passes = []
    value, vector, residual = whitening.largest(lambda y: passes.append(1) or v @ y, dims, 16, basis=64)
    assert np.abs(value - np.sort(e)[::-1][:16]).max() < 1e-12 and residual.max() < 5e-14
    assert np.abs(vector.T @ vector - np.eye(16)).max() < 1e-12
    assert len(passes) < 400

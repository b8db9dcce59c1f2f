"""DBSCAN over cells, the Lloyd chain and the block silhouette against brute force."""
import itertools

import numpy as np
import pandas as pd
import pytest
from pyspark.ml.clustering import KMeans
from pyspark.ml.functions import array_to_vector

from tidewatch.operators import modeling as MD


def brute_dbscan(x, w, eps, least):
    d = np.sqrt(((x[:, None, :] - x[None, :, :]) ** 2).sum(2)) <= eps
    core = (d * w[None, :]).sum(1) >= least
    lab = np.full(len(x), -1)
    k = 0
    for i in range(len(x)):
        if core[i] and lab[i] < 0:
            todo, lab[i] = [i], k
            while todo:
                p = todo.pop()
                for q in np.flatnonzero(d[p] & core & (lab < 0)):
                    lab[q] = k
                    todo.append(q)
            k += 1
    for i in np.flatnonzero(~core):
        near = lab[d[i] & core]
        lab[i] = near.min() if len(near) else -1
    return lab


def frame(spark, x):
    df = spark.createDataFrame([(i, [float(v) for v in r]) for i, r in enumerate(x)], "id long, v array<double>")
    return df.select("id", array_to_vector("v").alias("features"))


def dense(seed, dims):
    """A region in which nearly all points are within eps of each other, a chain, copies and strays."""
    rng = np.random.default_rng(seed)
    hot = rng.normal(0, 0.12, (150, dims))
    chain = np.zeros((20, dims))
    chain[:, 0] = 2 + 0.29 * np.arange(20)
    stray = rng.uniform(-6, 6, (25, dims))
    return np.concatenate([hot, chain, np.repeat(stray[:1], 6, axis=0), stray])[rng.permutation(201)]


@pytest.mark.parametrize("dims,chunk", [(2, 512), (3, 8), (7, 16)])
def test_dbscan_grid_in_a_dense_region(spark, dims, chunk):
    x = dense(dims, dims)
    grid = [(0.3, 2), (0.3, 5), (0.8, 5)]
    out = MD.dbscan_grid(frame(spark, x), "id", grid=grid, chunk=chunk).collect()
    assert len(out) == len(x) * len(grid)
    for g, (eps, least) in enumerate(grid):
        got = {r["id"]: r["cluster_id"] for r in out if r["g"] == g}
        assert [got[i] for i in range(len(x))] == brute_dbscan(x, np.ones(len(x)), eps, least).tolist()


def test_dbscan_edges(spark):
    one = frame(spark, np.zeros((7, 3)))
    assert {r.cluster_id for r in MD.dbscan(one, "id", eps=0.5, min_samples=5).collect()} == {0}
    assert {r.cluster_id for r in MD.dbscan(one.limit(3), "id", eps=0.5, min_samples=5).collect()} == {-1}
    assert MD.dbscan(one.where("false"), "id").collect() == []


def test_dbscan_writes_no_pairs(spark, monkeypatch):
    """Every written table of a run over a dense region has rows for points or cells, none for pairs."""
    sizes = []
    kind = type(spark.range(1))
    kept = kind.checkpoint

    def checkpoint(self, eager=True):
        out = kept(self, eager)
        sizes.append(out.count())
        return out

    monkeypatch.setattr(kind, "checkpoint", checkpoint)
    x = np.random.default_rng(3).normal(0, 0.05, (600, 2))
    MD.dbscan(frame(spark, x), "id", eps=0.5, min_samples=5).count()
    assert max(sizes) <= 600


def test_block_silhouette(spark):
    rng = np.random.default_rng(5)
    x = np.concatenate([rng.normal(1000, 1, (70, 4)), rng.normal(1003, 1, (60, 4)), np.full((5, 4), 1000.5)])
    lab = np.array([0] * 70 + [1] * 60 + [2] * 4 + [3])
    d = np.sqrt(((x[:, None] - x[None]) ** 2).sum(2))
    s = []
    for i in range(len(x)):
        own = lab == lab[i]
        own[i] = False
        if own.any():
            a, b = d[i, own].mean(), min(d[i, lab == c].mean() for c in set(lab) if c != lab[i])
            s.append((b - a) / max(a, b) if max(a, b) else 0.0)
        else:
            s.append(0.0)
    df = spark.createDataFrame([(i % 9, int(c), [float(v) for v in r]) for i, (r, c) in enumerate(zip(x, lab))], "id long, cluster_id int, features array<double>")
    for size in (1024, 16):
        got, method = MD.silhouette(df, id_col="id", method="euclidean", block_size=size)
        assert method == "euclidean" and got == pytest.approx(np.mean(s), abs=1e-9)


def test_lloyd_chain(spark):
    rng = np.random.default_rng(8)
    x = np.concatenate([rng.normal(c, 0.7, (60, 3)) for c in (-4, 0, 4)])
    df = frame(spark, x)
    fits = MD.kmeans_fits(df, "id", [1, 2, 3, 4], n_init=5, seed=7)
    for k, m in fits.items():
        d = ((x[:, None] - m.centers[None]) ** 2).sum(2)
        near = d.argmin(1)
        assert m.cost == pytest.approx(d.min(1).sum())
        assert np.allclose(m.centers, [x[near == c].mean(0) for c in range(k)])          # a fixed point
        assert m.centers.tolist() == sorted(m.centers.tolist())
        assert [r.cluster_id for r in m.assign(df).orderBy("id").collect()] == near.tolist()
    for k in (2, 3):
        other = min(KMeans(k=k, seed=s, tol=1e-6).fit(df).summary.trainingCost for s in range(3))
        assert fits[k].cost <= other * (1 + 1e-6)
    again = MD.kmeans_fits(df.repartition(7), "id", [3], n_init=5, seed=7)[3]
    assert np.allclose(again.centers, fits[3].centers)
    assert MD.kmeans_fits(df.where("false"), "id", [3]) == {}
    back = MD.Centers.of(fits[4].rows(spark))
    assert back.centers.tolist() == fits[4].centers.tolist()


def test_starts_are_rows_of_their_own():
    for n, k, init in itertools.product((3, 10, 101), (1, 2, 3), (1, 10)):
        for i in range(init):
            places = MD.start_places(n, k, i, init, 42)
            assert len(set(places)) == k and 0 <= min(places) and max(places) < n


def test_scattered_points_in_blocks(spark):
    """Scattered points are compared in few pairs of blocks, not in pairs of cells, and the labels are exact."""
    x = np.random.default_rng(11).normal(0, 1, (700, 3))
    placed, boxes = MD.spatial_blocks(frame(spark, x).selectExpr("id AS uid").withColumn("vec", MD.F.array(*[MD.F.lit(0.0)] * 3)), ["uid"], 3, 100)
    assert placed.groupBy("blk").count().agg({"count": "max"}).first()[0] <= 200      # identical points, still cut
    pts = frame(spark, x).select("id", MD.vector_to_array("features").alias("vec"))
    placed, boxes = MD.spatial_blocks(pts, ["id"], 3, 100)
    sizes = [r["n"] for r in boxes.collect()]
    assert sum(sizes) == 700 and max(sizes) <= 200 and len(sizes) <= 32
    pairs = [(r.p, r.a, r.b) for r in MD.near_blocks(boxes, 0.5).collect()]
    assert sorted(p for p, _, _ in pairs) == list(range(len(pairs)))
    blk = {r["id"]: r["blk"] for r in placed.collect()}
    met = {(a, b) for _, a, b in pairs}
    d = np.sqrt(((x[:, None, :] - x[None, :, :]) ** 2).sum(2))
    for i, j in zip(*np.nonzero(d <= 0.5)):
        assert tuple(sorted((blk[i], blk[j]))) in met
    grid = [(0.3, 2), (0.5, 5)]
    out = MD.dbscan_grid(frame(spark, x), "id", grid=grid, chunk=200).collect()
    for g, (eps, least) in enumerate(grid):
        got = {r["id"]: r["cluster_id"] for r in out if r["g"] == g}
        assert [got[i] for i in range(len(x))] == brute_dbscan(x, np.ones(len(x)), eps, least).tolist()


def test_neighbours_across_blocks(spark, monkeypatch):
    monkeypatch.setattr(MD, "CELL_CHUNK", 40)
    x = np.concatenate([np.random.default_rng(4).normal(0, 0.4, (150, 4)), np.zeros((9, 4))])
    d = np.sqrt(((x[:, None, :] - x[None, :, :]) ** 2).sum(2))
    want = {(f"c{i}", f"c{j}") for i, j in zip(*np.nonzero(d <= 0.5)) if i != j}
    df = frame(spark, x).selectExpr("'c' || id AS id", "features")
    got = MD.eps_neighbours(df, "id", "features", 0.5).collect()
    assert len(got) == len(want) and {(r["i"], r["j"]) for r in got} == want
    assert all(r["distance"] == pytest.approx(d[int(r["i"][1:]), int(r["j"][1:])], abs=1e-12) for r in got)


def test_silhouette_of_many_clusters(spark):
    """A point has rows for its own cluster, clusters that blocks cut and one per block, not one per cluster."""
    rng = np.random.default_rng(6)
    x, lab = rng.normal(0, 1, (240, 3)), np.sort(rng.integers(0, 80, 240))
    d = np.sqrt(((x[:, None] - x[None]) ** 2).sum(2))
    s = []
    for i in range(len(x)):
        own = lab == lab[i]
        own[i] = False
        a = d[i, own].mean() if own.any() else None
        b = min(d[i, lab == c].mean() for c in set(lab) if c != lab[i])
        s.append(0.0 if a is None else (b - a) / max(a, b))
    df = spark.createDataFrame([(i, int(c), [float(v) for v in r]) for i, (r, c) in enumerate(zip(x, lab))], "id long, cluster_id int, features array<double>")
    for size in (None, 50):
        assert MD.silhouette(df, id_col="id", method="euclidean", block_size=size)[0] == pytest.approx(np.mean(s), abs=1e-9)
    import pandas as pd
    block = pd.DataFrame({"p": [0], "blk": [0], "cl": [lab], "ct": [np.array([(lab == c).sum() for c in lab])], "vec": [x.ravel()]})
    assert len(MD._block_sums((0,), block)) <= 2 * len(x)


def test_distances_come_in_small_tiles(monkeypatch):
    """Tiles of bounded size cover all pairs, with equal and close points exact, and a pair of
    blocks sums to the same over any tiles, also where a cluster's rows lie in several."""
    rng = np.random.default_rng(8)
    a, b = rng.normal(0, 1, (53, 4)), rng.normal(0, 1, (17, 4))
    b[3], b[4] = a[5], a[6] + 1e-9
    cl = (np.sort(rng.integers(0, 5, 53)), np.sort(rng.integers(0, 5, 17)))
    blocks = pd.DataFrame([{"p": 0, "blk": i, "cl": c, "ct": np.bincount(c)[c], "vec": v.ravel()} for i, (c, v) in enumerate(zip(cl, (a, b)))])
    brute, found = np.sqrt(((a[:, None] - b[None]) ** 2).sum(2)), []
    for cached, tile in ((1 << 16, 1 << 21), (40, 200), (1, 17)):
        monkeypatch.setattr(MD, "CACHED", cached)
        monkeypatch.setattr(MD, "TILE", tile)
        d = np.zeros((53, 17))
        for at, part in MD._distances(a, b):
            assert part.size <= max(cached, 17)
            d[at:at + len(part)] = part
        assert np.allclose(d, brute, rtol=1e-9, atol=1e-12) and d[5, 3] == 0
        rows = MD._block_sums((0,), blocks)
        found.append(rows.fillna({"cl": -1}).groupby(["pid", "cl"]).agg({"dsum": "sum", "n": "sum", "least": "min"}).sort_index())
    assert all(np.allclose(f.to_numpy(dtype=float), found[0].to_numpy(dtype=float), equal_nan=True) and (f.index == found[0].index).all() for f in found)

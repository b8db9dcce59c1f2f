"""Modelling invariants and brute-force checks (reference clustering tests)."""
import numpy as np
import pandas as pd
import pytest
from pyspark.ml.functions import array_to_vector
from pyspark.sql import functions as F

from tidewatch.functions import rules as R
from tidewatch.operators import modeling as MD


def blobs(n=300, d=7, centers=3, std=2.0, seed=42):
    rng = np.random.default_rng(seed)
    c = rng.uniform(-10, 10, size=(centers, d))
    lab = rng.integers(0, centers, size=n)
    return c[lab] + rng.normal(scale=std, size=(n, d)), lab


def features_frame(spark, x):
    rows = [(f"c{i}",) + tuple(float(v) for v in row) + (False,) for i, row in enumerate(x)]
    return spark.createDataFrame(rows, "channel_id string, " + ", ".join(f"{c} double" for c in R.FEATURE_COLUMNS)
                                 + ", insufficient_history boolean")


def brute_silhouette(x, lab, squared=False):
    d = ((x[:, None, :] - x[None, :, :]) ** 2).sum(axis=2)
    d = d if squared else np.sqrt(d)
    s = []
    for i in range(len(x)):
        own = (lab == lab[i])
        own[i] = False
        if own.sum() == 0:
            s.append(0.0)
            continue
        a = d[i, own].mean()
        b = min(d[i, lab == c].mean() for c in set(lab) if c != lab[i])
        s.append((b - a) / max(a, b))
    return float(np.mean(s))


def test_preprocess_matches_numpy(spark):
    x, _ = blobs()
    df = features_frame(spark, x)
    out, prep = MD.preprocess(df)
    z = np.array([[r[c] for c in prep.out_cols] for r in out.orderBy("channel_id").collect()])
    order = sorted(range(len(x)), key=lambda i: f"c{i}")
    xs = x[order]
    cols = R.FEATURE_COLUMNS
    j = cols.index("days_since_last_upload")
    assert np.allclose(z[:, 0], np.log1p(np.clip(xs[:, j], 0, None)))
    for k, c in enumerate(prep.scale_cols, start=1):
        v = xs[:, cols.index(c)]
        q1, med, q3 = np.quantile(v, [0.25, 0.5, 0.75])
        assert np.allclose(z[:, k], (v - med) / (q3 - q1))


def test_silhouette_exact_vs_bruteforce(spark):
    x, lab = blobs(n=120)
    df = spark.createDataFrame([(i, int(l), [float(v) for v in row]) for i, (row, l) in enumerate(zip(x, lab))],
                               "id long, label int, vec array<double>")
    val, method = MD.silhouette(df, "vec", "label", id_col="id", method="euclidean", block_size=32)
    assert method == "euclidean"
    assert val == pytest.approx(brute_silhouette(x, lab), abs=1e-9)
    want = brute_silhouette(x, lab, squared=True)
    floats = df.withColumn("vec", F.col("vec").cast("array<double>"))
    for frame in (df.withColumn("vec", array_to_vector("vec")), floats):
        sq, m2 = MD.silhouette(frame, "vec", "label")
        assert m2 == "squared_euclidean" and sq == pytest.approx(want, abs=1e-9)


def brute_dbscan(x, eps, ms):
    n = len(x)
    d = np.sqrt(((x[:, None, :] - x[None, :, :]) ** 2).sum(axis=2))
    nb = d <= eps
    core = nb.sum(axis=1) >= ms
    comp = -np.ones(n, dtype=int)
    cid = 0
    for i in range(n):                      # components in order of lowest core index
        if core[i] and comp[i] < 0:
            stack = [i]
            comp[i] = cid
            while stack:
                p = stack.pop()
                for q in np.where(nb[p] & core)[0]:
                    if comp[q] < 0:
                        comp[q] = cid
                        stack.append(q)
            cid += 1
    lab = comp.copy()
    for i in range(n):
        if not core[i]:
            adj = [comp[q] for q in np.where(nb[i] & core)[0]]
            lab[i] = min(adj) if adj else -1
    return lab


def test_dbscan_and_neighbours_vs_bruteforce(spark):
    x, _ = blobs(n=150, d=3, std=0.6, seed=7)
    x = np.vstack([x, x[:5]])               # exact copies must not change the rule
    df = spark.createDataFrame([(i, [float(v) for v in row]) for i, row in enumerate(x)], "id long, vec array<double>")
    got = {r["id"]: r["cluster_id"] for r in MD.dbscan(df, "id", "vec", 0.8, 4, grid_dims=2).collect()}
    exp = brute_dbscan(x, 0.8, 4)
    assert [got[i] for i in range(len(x))] == list(exp)
    pairs = {(r["i"], r["j"]) for r in MD.eps_neighbours(df, "id", "vec", 0.8, grid_dims=2).collect()}
    d = np.sqrt(((x[:, None, :] - x[None, :, :]) ** 2).sum(axis=2))
    assert pairs == {(i, j) for i in range(len(x)) for j in range(len(x)) if i != j and d[i, j] <= 0.8}


def test_kmeans_deterministic_and_scoring(spark):
    x, _ = blobs()
    df = features_frame(spark, x)
    out, _ = MD.preprocess(df)
    a = [r["cluster_id"] for r in MD.predict(MD.fit_kmeans(out, 3, 42, 3), out).orderBy("channel_id").collect()]
    b = [r["cluster_id"] for r in MD.predict(MD.fit_kmeans(out, 3, 42, 3), out).orderBy("channel_id").collect()]
    assert a == b and len(set(a)) == 3
    res = MD.score_creators(df, F.current_timestamp(), "kmeans", n_boot=3, n_init=2)
    rows = res.clusters.collect()
    assert {r["risk_flag"] for r in rows} == {"Healthy", "Watch", "At-Risk"}
    assert all(0 <= r["risk_score"] <= 1 for r in rows)
    assert all(0 <= r["confidence"] <= 1 for r in rows)
    assert all(r["distance_to_centroid"] is not None for r in rows)
    assert res.metrics["k"] == 3


def test_two_handmade_clusters_and_empty(spark):
    rng = np.random.default_rng(3)
    x = np.vstack([rng.normal(0, 0.1, (25, 7)), rng.normal(5, 0.1, (25, 7))])
    df = features_frame(spark, x)
    out, _ = MD.preprocess(df)
    lab = MD.predict(MD.fit_kmeans(out, 2, 42, 2), out).toPandas()
    assert lab.groupby("cluster_id").size().sorted_values().tolist() == [25, 25] if hasattr(pd.Series, "sorted_values") \
        else sorted(lab.groupby("cluster_id").size().tolist()) == [25, 25]
    empty = df.withColumn("insufficient_history", F.lit(True))
    res = MD.score_creators(empty, F.current_timestamp(), "kmeans", n_boot=2)
    assert {r["risk_flag"] for r in res.clusters.collect()} == {"Unscored"}


def test_bootstrap_confidence(spark):
    x, _ = blobs(n=200, centers=3, std=0.5, seed=11)
    df = features_frame(spark, x)
    out, _ = MD.preprocess(df)
    f = MD.fit_model(out, "channel_id", "kmeans", 3, 3, 42, n_init=2)
    conf, st = MD.bootstrap_confidence(out, f, "channel_id", n_iter=8)
    vals = [r["confidence"] for r in conf.collect()]
    assert len(vals) == 200 and all(0 < v <= 1 for v in vals)
    assert st["stability_mean"] > 0.9 and st["n_unconverged"] == 0     # well separated blobs are stable
    _, loose = MD.bootstrap_confidence(out, f, "channel_id", n_iter=8, align=False)
    assert loose["stability_mean"] < st["stability_mean"]              # own cluster numbers of each refit
    g = MD.fit_model(out, "channel_id", "gmm", 3, 3, 42)
    conf2, st2 = MD.bootstrap_confidence(out, g, "channel_id", n_iter=2)
    assert conf2.count() == 200 and 0 < st2["stability_mean"] <= 1
    one = MD.Fitted("dbscan", 1, None, out.select("channel_id", F.lit(0).alias("cluster_id")))
    assert {r["confidence"] for r in MD.bootstrap_confidence(out, one, "channel_id")[0].collect()} == {0.5}


def test_bootstrap_against_plain_lloyd(spark):
    """Weights, starts and steps of the distributed refits against numpy on one machine."""
    x, _ = blobs(n=90, d=3, centers=3, std=1.0, seed=5)
    df = spark.createDataFrame([(i, [float(v) for v in r]) for i, r in enumerate(x)], "id long, v array<double>") \
        .select("id", array_to_vector("v").alias("features")).repartition(4)
    pts, centers, moving = MD.bootstrap_kmeans(df, "id", 3, n_iter=4, n_init=3, seed=7)
    assert moving == 0 and centers.shape == (4, 3, 3)
    rows = sorted((r["_id"], r["h"], r["v"]) for r in pts.collect())
    h, v = np.array([r[1] for r in rows]), np.array([r[2] for r in rows])
    w = MD.poisson_draws(h, np.arange(4), 7)
    assert 0.8 < w.mean() < 1.2 and w.max() > 2
    for it in range(4):                                                # each result is a fixed point of its own weights
        near = ((v[:, None, :] - centers[it][None]) ** 2).sum(2).argmin(1)
        for c in range(3):
            m = w[:, it] * (near == c)
            assert np.allclose((m[:, None] * v).sum(0) / m.sum(), centers[it][c], atol=1e-5)


def plain_em(v, w, means, reg=1e-6, tol=1e-3):
    """EM on one machine, from the clusters around ``means``, with the density written out."""
    k, d = means.shape
    near = ((v[:, None] - means[None]) ** 2).sum(2).argmin(1)
    share, before = np.eye(k)[near], -np.inf
    while True:
        a = share * w[:, None]
        weights, means = a.sum(0) / a.sum(), (a.T @ v) / a.sum(0)[:, None]
        covs = [((v - means[c]) * a[:, c:c + 1]).T @ (v - means[c]) / a[:, c].sum() + reg * np.eye(d) for c in range(k)]
        dens = np.stack([weights[c] * np.exp(-0.5 * np.einsum("ni,ij,nj->n", v - means[c], np.linalg.inv(covs[c]), v - means[c]))
                         / np.sqrt((2 * np.pi) ** d * np.linalg.det(covs[c])) for c in range(k)], 1)
        now = (w * np.log(dens.sum(1))).sum() / w.sum()
        share = dens / dens.sum(1, keepdims=True)
        if abs(now - before) <= tol:
            a = share * w[:, None]
            means = (a.T @ v) / a.sum(0)[:, None]
            return a.sum(0) / a.sum(), means, np.array([((v - means[c]) * a[:, c:c + 1]).T @ (v - means[c]) / a[:, c].sum() + reg * np.eye(d) for c in range(k)])
        before = now


def test_bootstrap_mixtures_against_plain_em(spark):
    x, _ = blobs(n=150, d=3, centers=3, std=4.0, seed=8)               # overlapping, so that shares matter
    df = spark.createDataFrame([(i, [float(v) for v in r]) for i, r in enumerate(x)], "id long, v array<double>") \
        .select("id", array_to_vector("v").alias("features")).repartition(4)
    pts, mix, moving = MD.bootstrap_mixtures(df, "id", 3, n_iter=3, n_init=2, seed=7)
    _, starts, _ = MD.bootstrap_kmeans(df, "id", 3, n_iter=3, n_init=2, seed=7)
    rows = sorted((r["_id"], r["h"], r["v"]) for r in pts.collect())
    h, v = np.array([r[1] for r in rows]), np.array([r[2] for r in rows])
    w = MD.poisson_draws(h, np.arange(3), 7)
    assert moving == 0
    for it in range(3):
        weights, means, covs = plain_em(v, w[:, it], starts[it])
        assert np.allclose(mix.weights[it], weights, atol=1e-8) and np.allclose(mix.means[it], means, atol=1e-6)
        assert np.allclose(mix.covs[it], covs, atol=1e-6)


def test_bootstrap_mixtures_edges(spark):
    """Equal points, fewer points than components, no points."""
    for rows in ([(i, [1.0, 2.0]) for i in range(9)], [(0, [1.0, 2.0]), (1, [3.0, 1e6])], []):
        df = spark.createDataFrame(rows, "id long, v array<double>").select("id", array_to_vector("v").alias("features"))
        pts, mix, moving = MD.bootstrap_mixtures(df, "id", 3, n_iter=2, n_init=1)
        assert moving == 0 and (mix is None) == (not rows) and pts.count() == len(rows)
        if rows:
            assert np.isfinite(mix.density()(np.array([r[1] for r in rows]))).all()


def test_poisson_table_reaches_the_tail():
    cdf = MD._POISSON1_CDF
    assert len(cdf) > 15 and 1 - cdf[-1] <= 2.0 ** -53 and (np.diff(cdf) >= 0).all()


def test_components_on_a_long_chain(spark):
    x = np.array([[i * 0.5, 0.0, 0.0] for i in range(60)] + [[100.0 + i * 0.5, 0.0, 0.0] for i in range(7)])
    df = spark.createDataFrame([(i, [float(v) for v in row]) for i, row in enumerate(x)], "id long, vec array<double>")
    got = [r["cluster_id"] for r in MD.dbscan(df, "id", "vec", 0.6, 2, grid_dims=1).orderBy("id").collect()]
    assert got == list(brute_dbscan(x, 0.6, 2))
    assert set(got[:60]) == {0} and set(got[60:]) == {1}


def test_silhouette_with_singleton_cluster(spark):
    x = np.array([[0.0, 0.0], [0.1, 0.0], [5.0, 5.0], [5.1, 5.0], [20.0, 0.0]])
    lab = np.array([0, 0, 1, 1, 2])
    df = spark.createDataFrame([(i, int(l), [float(v) for v in r]) for i, (r, l) in enumerate(zip(x, lab))],
                               "id long, label int, vec array<double>")
    val, _ = MD.silhouette(df, "vec", "label", id_col="id", method="euclidean")
    assert val == pytest.approx(brute_silhouette(x, lab), abs=1e-12)
    val, _ = MD.silhouette(df, "vec", "label")
    assert val == pytest.approx(brute_silhouette(x, lab, squared=True), abs=1e-9)


def test_selection_scores_all_labellings_in_one_chain(spark, monkeypatch):
    x, _ = blobs(n=90, d=3, std=1.0, seed=3)
    df = spark.createDataFrame([(i, [float(v) for v in row]) for i, row in enumerate(x)], "id long, vec array<double>")
    df = df.select("id", array_to_vector("vec").alias("features")).checkpoint(eager=True)
    calls, whole = [], MD.silhouettes
    monkeypatch.setattr(MD, "silhouettes", lambda pts, rows: calls.append(rows) or whole(pts, rows, block_size=16))
    grid = [(0.01, 2), (0.8, 2), (1.0, 5)]             # the first leaves nothing but noise
    f = MD.select_best_model(df, "id", 2, 3, grid=grid, kinds=("kmeans",))
    assert len(calls) == 1
    fits = MD.kmeans_fits(df, "id", [2, 3])
    want = []
    for k in (2, 3):
        lab = {r["id"]: r["cluster_id"] for r in fits[k].assign(df).collect()}
        want.append((brute_silhouette(x, np.array([lab[i] for i in range(len(x))])), None))
    for eps, ms in grid:
        lab = brute_dbscan(x, eps, ms)
        own = lab >= 0
        want.append((brute_silhouette(x[own], lab[own]) if len(set(lab[own])) > 1 else 0.0, (~own).mean()))
    for t, (sil, noise) in zip(f.trials, want, strict=True):
        assert t["silhouette"] == pytest.approx(sil, abs=1e-9)
        assert noise is None or t["noise_frac"] == pytest.approx(noise)


def test_pairs_of_blocks_are_dealt_in_turn(spark):
    """No task has two pairs while another has none, and there are no more tasks than pairs."""
    blocks = spark.range(6).select(F.col("id").alias("blk"), F.array(F.col("id")).alias("uid"))
    pairs = spark.createDataFrame([(p, p, p) for p in range(6)], "p long, a long, b long")
    met = MD._meeting(blocks, pairs, ["uid"], 6)
    per = [r[0] for r in met.groupBy(F.spark_partition_id()).agg(F.countDistinct("p")).select("count(DISTINCT p)").collect()]
    assert met.rdd.getNumPartitions() <= 6 and per == [1] * 6


def test_starts_of_an_iteration_share_its_draws(monkeypatch):
    """A task draws a row's weight once for an iteration, whatever starts it has, and its
    sums are those of plain numpy; the fits' costs add up over their rows."""
    rng, drawn = np.random.default_rng(4), []
    v, h, centers = rng.normal(size=(70, 3)), rng.integers(0, 1 << 62, 70), rng.normal(size=(6, 2, 3))
    centers[4, 1] = centers[4, 0]                                      # equally near: the first centre has all rows
    its, draw = np.repeat(np.arange(2), 3), MD.poisson_draws
    monkeypatch.setattr(MD, "poisson_draws", lambda h, it, seed: drawn.append(len(it)) or draw(h, it, seed))
    pdf = pd.DataFrame({"h": h, "v": list(v)})
    got = pd.concat(MD._lloyd_step(centers, np.arange(6) + 10, its, 7)(iter([pdf, pdf[:0]])))
    assert set(drawn) == {2}
    w = draw(h, np.arange(2), 7)[:, its]
    d2 = ((v[:, None, None] - centers[None]) ** 2).sum(3)
    near, cost = d2.argmin(2), np.zeros(6)
    for r in got.itertuples():
        f = r.refit - 10
        m = w[:, f] * (near[:, f] == r.cl)
        assert np.allclose(r.sums[:4], [*(m[:, None] * v).sum(0), m.sum()])
        cost[f] += r.sums[4]
    assert np.allclose(cost, (w * d2.min(2)).sum(0)) and len(got) == 11 and not len(got[(got.refit == 14) & (got.cl == 1)])


def test_starts_are_the_rows_of_the_least_hash(spark):
    """The rows that a refit begins at, wherever in the rows they lie."""
    df = spark.range(0, 700, 1, 2).select("id", array_to_vector(F.array(F.col("id").cast("double"))).alias("features"))
    pts, centers, _ = MD.bootstrap_kmeans(df, "id", 3, n_iter=2, n_init=2, seed=5, max_steps=0)
    rows = sorted((r["_id"], r["h"]) for r in pts.collect())
    with np.errstate(over="ignore"):
        key = np.array([r[1] for r in rows]).astype(np.uint64)[:, None] ^ ((np.arange(4, dtype=np.uint64) + np.uint64(5)) * np.uint64(0xA24BAED4963EE407))[None]
        key = (key ^ (key >> np.uint64(29))) * np.uint64(0x94D049BB133111EB)
        key ^= key >> np.uint64(32)
    first = np.sort(np.argsort(key, axis=0)[:3].T, axis=1)
    assert [sorted(c[:, 0].tolist()) for c in centers] == [first[0].tolist(), first[2].tolist()]   # of equal costs the first start

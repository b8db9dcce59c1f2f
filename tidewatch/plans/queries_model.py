"""Modelling queries (M1-M11, J9, K10). The k-means sweep, DBSCAN, the silhouettes, the
choice among them, forced fits, scoring with k-means and the model's round trip
have SQL twins that fit again from the same starts; mixtures and the bootstrap
are checked by invariants in the tests."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import rules as R
from ..functions import scalar as S
from ..operators import modeling as MD
from ..operators import scoring as SC
from ..session import scratch_path
from ..sources import bindings as BD
from . import oracle as O
from .catalog import register
from .queries_core import features_for

LOG_COLS = [c for c in R.FEATURE_COLUMNS if "days_since" in c]
STD_COLS = [c for c in R.FEATURE_COLUMNS if "days_since" not in c]
Z_COLS = [f"z_{c}" for c in LOG_COLS + STD_COLS]


def prepared(spark, sf_dir):
    """Scored B1 channels with the preprocessed feature vector."""
    scored, _ = SC.split_scored(features_for(spark, sf_dir, "b1"))
    x, prep = MD.preprocess(scored)
    return x.checkpoint(eager=True), prep


def scoring_result(spark, sf_dir):
    return MD.score_creators(features_for(spark, sf_dir, "b1"), S.ts_lit(BD.B1.ref), "auto", n_boot=500)


def prep_sql(f: str) -> str:
    """Scored rows with z columns: log1p for idle days, (x - median) / IQR else."""
    filled = ", ".join(f"coalesce(CAST({c} AS DOUBLE), 0.0) AS {c}" for c in R.FEATURE_COLUMNS)
    qs = ", ".join(f"quantile_cont({c}, 0.5) AS med_{c}, quantile_cont({c}, 0.75) - quantile_cont({c}, 0.25) AS iqr_{c}"
                   for c in STD_COLS)
    z = [f"ln(1 + greatest({c}, 0.0)) AS z_{c}" for c in LOG_COLS]
    z += [f"({c} - q.med_{c}) / (CASE WHEN abs(q.iqr_{c}) < {10 * MD.EPS64!r} THEN 1.0 ELSE q.iqr_{c} END) AS z_{c}"
          for c in STD_COLS]
    return f"""
WITH s AS (SELECT channel_id, {filled} FROM ({f}) f WHERE NOT coalesce(insufficient_history, true)),
q AS (SELECT {qs} FROM s)
SELECT s.channel_id, {', '.join(z)} FROM s CROSS JOIN q"""


_PREP_SQL = prep_sql(O.binding_features_sql("b1"))


@register("robust_scale", _PREP_SQL)
def q_robust_scale(spark, sf_dir):
    """M1: log1p idle days, exact median/IQR scaling of the rest (B1 scored rows)."""
    x, _ = prepared(spark, sf_dir)
    return x.select("channel_id", *Z_COLS)


def _dist_sql(a: str, b: str) -> str:
    terms = " + ".join(f"({a}.{z} - {b}.{z}) * ({a}.{z} - {b}.{z})" for z in Z_COLS)
    return f"sqrt(0.0 + {terms})"


@register("eps_neighbours", f"""
WITH p AS ({_PREP_SQL})
SELECT a.channel_id AS i, b.channel_id AS j, {_dist_sql('a', 'b')} AS distance
FROM p a JOIN p b ON a.channel_id <> b.channel_id WHERE {_dist_sql('a', 'b')} <= 0.5""")
def q_eps_neighbours(spark, sf_dir):
    """Pairs of preprocessed channels within eps = 0.5 (grid range join)."""
    x, _ = prepared(spark, sf_dir)
    return MD.eps_neighbours(x, "channel_id", "features", 0.5)


@register("silhouette", """
WITH p AS (SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS v FROM embeddings),
m AS (SELECT a.vec_id AS i, a.label AS li, b.label AS lj, avg(list_distance(a.v, b.v) ** 2) AS md
      FROM p a JOIN p b ON a.vec_id <> b.vec_id GROUP BY a.vec_id, a.label, b.label),
s AS (SELECT i, max(CASE WHEN lj = li THEN md END) AS a, min(CASE WHEN lj <> li THEN md END) AS b FROM m GROUP BY i)
SELECT avg(CASE WHEN a IS NULL THEN 0.0 ELSE (b - a) / greatest(a, b) END) AS silhouette, 'squared_euclidean' AS method FROM s""")
def q_silhouette(spark, sf_dir):
    """M5: silhouette of the labelled embeddings, closed form per cluster (the SQL goes over all pairs)."""
    emb = BD.table(spark, sf_dir, "embeddings")
    val, method = MD.silhouette(emb, "embedding", "label", id_col="vec_id")
    return spark.createDataFrame([(val, method)], "silhouette double, method string")


def _fixed_scored(spark, sf_dir):
    x, _ = prepared(spark, sf_dir)
    s = SC.with_risk_score(x.withColumn("cluster_id", (F.col("channel_id") % 3).cast("int")))
    return SC.assign_tiers(s)


_DIST_SQL = f"""
WITH p AS ({_PREP_SQL}),
f AS (SELECT * FROM ({O.binding_features_sql('b1')}) x WHERE NOT coalesce(insufficient_history, true)),
s AS (SELECT p.*, CAST(p.channel_id % 3 AS INTEGER) AS cluster_id, {O.risk_score_sql()} AS risk_score
      FROM p JOIN f ON f.channel_id = p.channel_id),
th AS ({O.thresholds_sql('SELECT risk_score FROM s')}),
t AS (SELECT s.*, {O.tier_sql('s.risk_score')} AS risk_flag FROM s CROSS JOIN th),
h AS (SELECT cluster_id FROM t WHERE risk_flag = 'Healthy' GROUP BY cluster_id ORDER BY count(*) DESC, cluster_id LIMIT 1),
c AS (SELECT {', '.join(f'avg({z}) AS {z}' for z in Z_COLS)} FROM t WHERE cluster_id = (SELECT cluster_id FROM h))
SELECT t.channel_id, t.cluster_id, t.risk_flag, {_dist_sql('t', 'c')} AS distance_to_centroid FROM t CROSS JOIN c"""


@register("distance_to_healthy", _DIST_SQL)
def q_distance_to_healthy(spark, sf_dir):
    """M8: distance of each scored channel to the healthy cluster's centre
    (fixed clusters channel_id % 3, centre = mean preprocessed vector)."""
    t = _fixed_scored(spark, sf_dir)
    c = {r["cluster_id"]: [r[z] for z in Z_COLS] for r in t.groupBy("cluster_id").agg(*[F.avg(z).alias(z) for z in Z_COLS]).collect()}
    center = MD.healthy_centroid([c.get(i, [0.0] * len(Z_COLS)) for i in range(3)], t)
    return t.select("channel_id", "cluster_id", "risk_flag", MD.distance_to(Z_COLS, center).alias("distance_to_centroid"))


def lloyd_sql(ks, n_init: int = 10, seed: int = 42, steps: int = 60) -> str:
    """The k-means sweep in SQL, after WITH RECURSIVE: ``v`` (channel_id, r, v), ``best``
    (k, c: sorted centres, cost) and ``lab`` (k, channel_id, v, cluster_id). All starts
    run ``steps`` steps, which is beyond where they stand still."""
    most, dims = max(ks), len(Z_COLS)
    shifts = ", ".join(f"({i}, CAST({((i + 0.5) / n_init + (seed % 1000) / 1000) % 1.0!r} AS DOUBLE))" for i in range(n_init))
    mean = ", ".join("[" + ", ".join(f"coalesce(avg(v[{x + 1}]) FILTER (WHERE j = {j + 1}), any_value(c)[{j + 1}][{x + 1}])" for x in range(dims)) + "]" for j in range(most))
    near = "list_transform(c, lambda x: list_distance(x, v.v))"
    return f"""p AS ({_PREP_SQL}),
v AS (SELECT channel_id, row_number() OVER (ORDER BY channel_id) - 1 AS r, [{", ".join(f"CAST({z} AS DOUBLE)" for z in Z_COLS)}] AS v FROM p),
s(i, shift) AS (VALUES {shifts}),
st AS (SELECT k, i, j, v.v AS c FROM (SELECT k, unnest(range(k)) AS j FROM (SELECT unnest({list(ks)}) AS k) ks) kj, s, (SELECT count(*) AS n FROM v) n
       JOIN v ON v.r = CAST(floor(n.n * (j + s.shift) / k) AS BIGINT)),
lloyd(k, i, step, c) AS (
  SELECT k, i, 0, list(c ORDER BY j) FROM st GROUP BY k, i
  UNION ALL
  SELECT k, i, step + 1, list_slice([{mean}], 1, k)
  FROM (SELECT k, i, step, c, v.v AS v, list_position({near}, list_min({near})) AS j FROM lloyd, v WHERE step < {steps}) a
  GROUP BY k, i, step, c),
cost AS (SELECT k, i, c, sum(list_min({near}) ** 2) AS cost FROM lloyd, v WHERE step = {steps} GROUP BY k, i, c),
best AS (SELECT k, list_sort(arg_min(c, (cost, i))) AS c, min(cost) AS cost FROM cost GROUP BY k),
lab AS (SELECT k, channel_id, v, CAST(list_position(d, list_min(d)) - 1 AS INTEGER) AS cluster_id FROM (SELECT k, channel_id, v.v AS v, {near} AS d FROM best, v) x)"""


def silhouettes_sql(labels: str, by: str) -> str:
    """(by, silhouette) over all pairs of ``labels`` (by, channel_id, v, cluster_id)."""
    return f"""SELECT {by}, CASE WHEN count(DISTINCT li) > 1 THEN avg(CASE WHEN a IS NULL THEN 0.0 ELSE (b - a) / greatest(a, b) END) END AS silhouette
FROM (SELECT {by}, i, li, max(CASE WHEN lj = li THEN md END) AS a, min(CASE WHEN lj <> li THEN md END) AS b
      FROM (SELECT x.{by}, x.channel_id AS i, x.cluster_id AS li, y.cluster_id AS lj, avg(list_distance(x.v, y.v)) FILTER (WHERE x.channel_id <> y.channel_id) AS md
            FROM ({labels}) x JOIN ({labels}) y ON x.{by} = y.{by} GROUP BY x.{by}, x.channel_id, x.cluster_id, y.cluster_id) m GROUP BY {by}, i, li) q GROUP BY {by}"""


@register("kmeans_sweep", f"""
WITH RECURSIVE {lloyd_sql((3, 4, 5))}
SELECT CAST(best.k AS INTEGER) AS k, best.cost AS training_cost, s.silhouette, 'euclidean' AS method
FROM best JOIN ({silhouettes_sql('SELECT * FROM lab', 'k')}) s ON s.k = best.k""")
def q_kmeans_sweep(spark, sf_dir):
    """M2: k-means for k = 3..5, best of 10 starts, all in one Lloyd chain; cost and silhouette."""
    x, _ = prepared(spark, sf_dir)
    rows = []
    for k, m in MD.kmeans_fits(x, "channel_id", range(3, 6), 10, 42).items():
        sil, meth = MD.silhouette(m.assign(x), id_col="channel_id", method="euclidean")
        rows.append((k, m.cost, sil, meth))
    return spark.createDataFrame(rows, "k int, training_cost double, silhouette double, method string")


@register("kmeans_centers", f"""
WITH RECURSIVE {lloyd_sql((3, 4, 5))}
SELECT CAST(k AS INTEGER) AS k, CAST(j - 1 AS INTEGER) AS cluster_id, {", ".join(f"c[j][{i + 1}] AS {z}" for i, z in enumerate(Z_COLS))}
FROM (SELECT k, c, unnest(range(1, k + 1)) AS j FROM best) x""")
def q_kmeans_centers(spark, sf_dir):
    """The fitted centres as rows."""
    x, _ = prepared(spark, sf_dir)
    fits = MD.kmeans_fits(x, "channel_id", range(3, 6), 10, 42)
    rows = [(k, i, *c) for k, m in fits.items() for i, c in enumerate(m.centers.tolist())]
    return spark.createDataFrame(rows, "k int, cluster_id int, " + ", ".join(f"{z} double" for z in Z_COLS))


@register("gmm_sweep")
def q_gmm_sweep(spark, sf_dir):
    """M3: Gaussian mixtures k = 3..5 with (Euclidean) silhouettes."""
    x, _ = prepared(spark, sf_dir)
    rows = []
    for k in range(3, 6):
        m = MD.fit_gmm(x, k, 42)
        lab = MD.predict(m, x)
        sil, meth = MD.silhouette(lab, id_col="channel_id", method="euclidean")
        rows.append((k, sil, meth, lab.select("cluster_id").distinct().count()))
    return spark.createDataFrame(rows, "k int, silhouette double, method string, n_used int")


def dbscan_sql(grid) -> str:
    """DBSCAN in SQL for every (eps, min_samples), after WITH RECURSIVE: ``dlab`` (g, channel_id, v, cluster_id)."""
    tries = ", ".join(f"({g}, CAST({eps!r} AS DOUBLE), {m})" for g, (eps, m) in enumerate(grid))
    return f"""dp AS ({_PREP_SQL}),
di AS (SELECT channel_id, [{", ".join(f"CAST({z} AS DOUBLE)" for z in Z_COLS)}] AS v, row_number() OVER (ORDER BY channel_id) AS r FROM dp),
grid(g, eps, least) AS (VALUES {tries}),
dn AS (SELECT g, least, a.r AS x, b.r AS y FROM grid, di a JOIN di b ON list_distance(a.v, b.v) <= eps),
dcore AS (SELECT g, x FROM dn GROUP BY g, x, least HAVING count(*) >= least),
de AS (SELECT dn.g, dn.x, dn.y FROM dn JOIN dcore c ON c.g = dn.g AND c.x = dn.x JOIN dcore d ON d.g = dn.g AND d.x = dn.y),
reach(g, x, y) AS (SELECT g, x, y FROM de UNION SELECT r.g, r.x, e.y FROM reach r JOIN de e ON e.g = r.g AND e.x = r.y),
comp AS (SELECT g, x, min(y) AS root FROM reach GROUP BY g, x),
num AS (SELECT g, root, row_number() OVER (PARTITION BY g ORDER BY root) - 1 AS k FROM (SELECT DISTINCT g, root FROM comp) t),
core_lab AS (SELECT comp.g, comp.x, num.k FROM comp JOIN num ON num.g = comp.g AND num.root = comp.root),
border AS (SELECT dn.g, dn.x, min(l.k) AS k FROM dn JOIN core_lab l ON l.g = dn.g AND l.x = dn.y GROUP BY dn.g, dn.x),
dlab AS (SELECT grid.g, di.channel_id, di.v, CAST(coalesce(l.k, border.k, -1) AS INTEGER) AS cluster_id
         FROM grid CROSS JOIN di LEFT JOIN core_lab l ON l.g = grid.g AND l.x = di.r LEFT JOIN border ON border.g = grid.g AND border.x = di.r)"""


@register("dbscan", f"""
WITH RECURSIVE {dbscan_sql([(0.5, 5)])}
SELECT channel_id, cluster_id FROM dlab""")
def q_dbscan(spark, sf_dir):
    """M4: DBSCAN(eps 0.5, min_samples 5) labels of the preprocessed channels."""
    x, _ = prepared(spark, sf_dir)
    return MD.dbscan(x, "channel_id", "features", 0.5, 5)


@register("dbscan_grid", f"""
WITH RECURSIVE {dbscan_sql(MD.DBSCAN_GRID)}
SELECT eps, CAST(least AS INTEGER) AS min_samples, channel_id, cluster_id FROM dlab JOIN grid ON grid.g = dlab.g""")
def q_dbscan_grid(spark, sf_dir):
    """M4: labels for the whole grid of eps and min_samples, in one chain of jobs."""
    x, _ = prepared(spark, sf_dir)
    grid = spark.createDataFrame([(g, float(e), m) for g, (e, m) in enumerate(MD.DBSCAN_GRID)], "g int, eps double, min_samples int")
    return MD.dbscan_grid(x, "channel_id").join(F.broadcast(grid), "g").drop("g")


@register("silhouette_euclidean", """
WITH p AS (SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS v FROM embeddings),
m AS (SELECT a.vec_id AS i, a.label AS li, b.label AS lj, avg(list_distance(a.v, b.v)) AS md
      FROM p a JOIN p b ON a.vec_id <> b.vec_id GROUP BY a.vec_id, a.label, b.label),
s AS (SELECT i, max(CASE WHEN lj = li THEN md END) AS a, min(CASE WHEN lj <> li THEN md END) AS b FROM m GROUP BY i)
SELECT avg(CASE WHEN a IS NULL THEN 0.0 ELSE (b - a) / greatest(a, b) END) AS silhouette, 'euclidean' AS method FROM s""")
def q_silhouette_euclidean(spark, sf_dir):
    """M5: the Euclidean silhouette of the labelled embeddings, each pair of blocks once."""
    val, method = MD.silhouette(BD.table(spark, sf_dir, "embeddings"), "embedding", "label", id_col="vec_id", method="euclidean")
    return spark.createDataFrame([(val, method)], "silhouette double, method string")


def _trials(spark, f: MD.Fitted):
    rows = [(t["model_type"], t["param"], float(t["silhouette"]), t.get("noise_frac")) for t in f.trials]
    df = spark.createDataFrame(rows, "model_type string, param string, silhouette double, noise_frac double")
    won = f"k={f.params['k']}" if f.model_type != "dbscan" else f"eps={f.params['eps']},min_samples={f.params['min_samples']}"
    return df.withColumn("selected", (F.col("model_type") == F.lit(f.model_type)) & (F.col("param") == F.lit(won)))


@register("model_selection")
def q_model_selection(spark, sf_dir):
    """M6: every trial of the automatic selection and the winner."""
    x, _ = prepared(spark, sf_dir)
    return _trials(spark, MD.fit_model(x, "channel_id", "auto"))


@register("model_choice", f"""
WITH RECURSIVE {lloyd_sql((3, 4, 5))}, {dbscan_sql(MD.DBSCAN_GRID)},
t AS (SELECT 'kmeans' AS model_type, 'k=' || lab.k AS param, any_value(s.silhouette) AS sil, CAST(NULL AS DOUBLE) AS noise_frac, lab.k AS o
      FROM lab JOIN ({silhouettes_sql('SELECT * FROM lab', 'k')}) s ON s.k = lab.k GROUP BY lab.k
      UNION ALL
      SELECT 'dbscan', 'eps=' || any_value(eps) || ',min_samples=' || any_value(least), any_value(s.silhouette), avg(CASE WHEN cluster_id = -1 THEN 1.0 ELSE 0.0 END), 100 + dlab.g
      FROM dlab JOIN grid ON grid.g = dlab.g LEFT JOIN ({silhouettes_sql('SELECT * FROM dlab WHERE cluster_id <> -1', 'g')}) s ON s.g = dlab.g GROUP BY dlab.g),
u AS (SELECT *, coalesce(sil, 0.0) AS silhouette FROM t),
bm AS (SELECT arg_min(o, (-silhouette, o)) AS o, max(silhouette) AS silhouette FROM u WHERE o < 100),
bd AS (SELECT arg_min(o, (-silhouette, o)) AS o, max(silhouette) AS silhouette, arg_min(noise_frac, (-silhouette, o)) AS noise_frac FROM u WHERE o >= 100)
SELECT model_type, param, u.silhouette, u.noise_frac,
       u.o = CASE WHEN bd.silhouette > bm.silhouette AND bd.noise_frac <= 0.2 THEN bd.o ELSE bm.o END AS selected
FROM u CROSS JOIN bm CROSS JOIN bd""")
def q_model_choice(spark, sf_dir):
    """M6: the choice among k-means k = 3..5 and the DBSCAN grid (no mixtures)."""
    x, _ = prepared(spark, sf_dir)
    return _trials(spark, MD.select_best_model(x, "channel_id", kinds=("kmeans",)))


@register("forced_models", f"""
WITH RECURSIVE {dbscan_sql([(0.5, 5)])},
d AS (SELECT avg(CASE WHEN cluster_id = -1 THEN 1.0 ELSE 0.0 END) > 0.2 AS noisy, count(DISTINCT CASE WHEN cluster_id <> -1 THEN cluster_id END) AS k FROM dlab)
SELECT 'kmeans' AS requested, 'kmeans' AS selected, CAST(3 AS INTEGER) AS k, '{{''k'': 3}}' AS params
UNION ALL SELECT 'gmm', 'gmm', 3, '{{''k'': 3}}'
UNION ALL SELECT 'dbscan', CASE WHEN noisy THEN 'kmeans' ELSE 'dbscan' END, CASE WHEN noisy THEN 3 ELSE CAST(k AS INTEGER) END,
                 CASE WHEN noisy THEN '{{''k'': 3, ''fallback_from'': ''dbscan''}}' ELSE '{{''eps'': 0.5, ''min_samples'': 5}}' END FROM d""")
def q_forced_models(spark, sf_dir):
    """M7: forced kmeans / gmm / dbscan fits (dbscan falls back above 20% noise)."""
    x, _ = prepared(spark, sf_dir)
    rows = []
    for mt in ("kmeans", "gmm", "dbscan"):
        f = MD.fit_model(x, "channel_id", mt, 3, 5, 42, n_init=10)
        rows.append((mt, f.model_type, int(f.k), str(f.params)))
    return spark.createDataFrame(rows, "requested string, selected string, k int, params string")


@register("bootstrap_confidence")
def q_bootstrap_confidence(spark, sf_dir):
    """M9: per-channel stability over 500 Poisson-weighted k-means refits (k = 3),
    all refits in one distributed Lloyd loop."""
    x, _ = prepared(spark, sf_dir)
    f = MD.fit_model(x, "channel_id", "kmeans", 3, 5, 42, n_init=10)
    conf, _ = MD.bootstrap_confidence(x, f, "channel_id", n_iter=500, seed=42)
    return conf


@register("creator_clusters")
def q_creator_clusters(spark, sf_dir):
    """Full scoring with automatic model choice (B1), unscored rows included."""
    return scoring_result(spark, sf_dir).clusters


def kmeans_result(spark, sf_dir):
    """Scoring with k-means, k = 3, without the bootstrap."""
    return MD.score_creators(features_for(spark, sf_dir, "b1"), S.ts_lit(BD.B1.ref), "kmeans", n_boot=0)


_FEATS = O.binding_features_sql("b1")
_KMEANS_CLUSTERS = f"""
WITH RECURSIVE {lloyd_sql((3,))},
f AS ({_FEATS}),
sc AS (SELECT {", ".join("f." + c.strip() for c in O.FEATURE_NAMES.split(","))}, {O.risk_score_sql()} AS risk_score, lab.cluster_id, lab.v FROM f JOIN lab ON lab.channel_id = f.channel_id),
names AS (SELECT cluster_id, {O.label_sql('i', 'n')} AS cluster_label FROM (
          SELECT cluster_id, row_number() OVER (ORDER BY avg(risk_score) DESC NULLS LAST, cluster_id) - 1 AS i, count(*) OVER () AS n FROM sc GROUP BY cluster_id) c),
th AS ({O.thresholds_sql('SELECT risk_score FROM sc')}),
t AS (SELECT sc.*, {O.tier_sql('sc.risk_score')} AS risk_flag FROM sc CROSS JOIN th),
healthy AS (SELECT cluster_id FROM t WHERE risk_flag = 'Healthy' GROUP BY cluster_id ORDER BY count(*) DESC, cluster_id LIMIT 1),
center AS (SELECT c[(SELECT cluster_id FROM healthy) + 1] AS c FROM best)
SELECT {", ".join("t." + c.strip() for c in O.FEATURE_NAMES.split(","))}, t.risk_score, t.cluster_id, names.cluster_label, t.risk_flag, 'kmeans_v1' AS model_version, {O.ts(BD.B1.ref)} AS scored_at,
       list_distance(t.v, center.c) AS distance_to_centroid, CAST(NULL AS DOUBLE) AS confidence
FROM t JOIN names ON names.cluster_id = t.cluster_id CROSS JOIN center
UNION ALL
SELECT {O.FEATURE_NAMES}, CAST(NULL AS DOUBLE), CAST(-1 AS INTEGER), 'Unscored', 'Unscored', 'kmeans_v1', {O.ts(BD.B1.ref)}, CAST(NULL AS DOUBLE), CAST(NULL AS DOUBLE)
FROM f WHERE coalesce(insufficient_history, true)"""


@register("creator_clusters_kmeans", _KMEANS_CLUSTERS)
def q_creator_clusters_kmeans(spark, sf_dir):
    """Full scoring with k-means (B1): fit, risk, labels, tiers, distance to the healthy centre."""
    return kmeans_result(spark, sf_dir).clusters


@register("model_summary")
def q_model_summary(spark, sf_dir):
    """Per-cluster profile with the model's metrics."""
    return MD.model_summary(scoring_result(spark, sf_dir))


@register("model_roundtrip", f"""
WITH RECURSIVE {lloyd_sql((3,))}
SELECT channel_id, cluster_id, cluster_id AS reloaded_cluster_id, true AS same FROM lab""")
def q_model_roundtrip(spark, sf_dir):
    """Save the fitted model + preprocessor, load, re-assign: labels agree."""
    x, prep = prepared(spark, sf_dir)
    res = MD.ScoringResult(x, MD.fit_model(x, "channel_id", "kmeans", 3, 5, 42, n_init=10), prep, {})
    path = scratch_path(spark, "model")
    MD.save_model(res, path)
    fitted, prep, _ = MD.load_model(spark, path)
    again = fitted.assign(prep.transform(x.drop("features", *Z_COLS)), "channel_id").select(
        "channel_id", F.col("cluster_id").alias("reloaded_cluster_id"))
    first = res.fitted.assign(x, "channel_id").select("channel_id", "cluster_id")
    return first.join(again, "channel_id").withColumn("same", F.col("cluster_id") == F.col("reloaded_cluster_id"))

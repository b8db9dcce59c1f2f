"""Modelling over a features table.

* M1 ``preprocess``: NULL -> 0, log1p for idle-days columns, exact robust
  scaling (median / IQR from distributed exact quantiles) for the rest, then a
  ``VectorAssembler`` column. Only 3 scalars per column reach the driver.
* M2: k-means for all k and starts of a sweep in one Lloyd chain (``kmeans_fits``);
  M3: MLlib ``GaussianMixture``.
* M4/J9: DBSCAN over pairs of blocks of points that lie together (``dbscan_grid``), for
  a whole grid of parameters in one chain of jobs; components by min-label
  propagation with a reliable checkpoint per round, deterministic numbering
  (N17). ``eps_neighbours`` lists the pairs themselves (J9).
* M5 ``silhouette``: the Euclidean one over all pairs of points, in blocks of
  which each pair meets once (no point-pair rows), which is what M6, M7 and M10
  choose and report by; ``method="squared_euclidean"`` is the closed form in O(n k).
* M8 distance to the healthy centroid; M9 bootstrap confidence with Poisson(1)
  weights from a hash of (id, iteration), all refits in one chain of Lloyd or EM steps.
"""

from __future__ import annotations

import json
import math
from concurrent.futures import ThreadPoolExecutor
from collections.abc import Sequence
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark.ml.clustering import GaussianMixture, GaussianMixtureModel
from pyspark.ml.evaluation import ClusteringEvaluator
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import rules as R
from ..functions import scalar as S
from ..session import saved
from . import scoring as SC
from .eda import long_form
from .ordering import exact_quantiles, global_index, rank_in_groups

EPS64 = float(np.finfo(np.float64).eps)
FIT_THREADS = 4   # concurrent model fits submitted from the driver
# Fixed values that must equal the reference's for the same results: eps x min_samples.
DBSCAN_GRID = [(eps, n) for eps in (0.3, 0.5, 0.8, 1.0) for n in (2, 3, 5)]


# ---- M1 ------------------------------------------------------------------------

@dataclass
class Preprocessor:
    cols: list[str]
    log_cols: list[str]
    scale_cols: list[str]
    center: dict[str, float]
    scale: dict[str, float]

    @property
    def out_cols(self) -> list[str]:
        return [f"z_{c}" for c in self.log_cols + self.scale_cols]

    def transform(self, df: DataFrame, out: str = "features") -> DataFrame:
        z = []
        for c in self.log_cols:
            z.append(S.log1p_clipped(F.coalesce(F.col(c).cast("double"), F.lit(0.0))).alias(f"z_{c}"))
        for c in self.scale_cols:
            v = F.coalesce(F.col(c).cast("double"), F.lit(0.0))
            z.append(((v - F.lit(self.center[c])) / F.lit(self.scale[c])).alias(f"z_{c}"))
        d = df.select("*", *z)
        return VectorAssembler(inputCols=self.out_cols, outputCol=out).transform(d)

    def to_json(self) -> str:
        return json.dumps(self.__dict__)

    @staticmethod
    def from_json(s: str) -> Preprocessor:
        return Preprocessor(**json.loads(s))


def fit_preprocessor(df: DataFrame, cols: Sequence[str] = R.FEATURE_COLUMNS) -> Preprocessor:
    """M1 fit: exact linear quartiles of the zero-filled columns."""
    cols = list(cols)
    log_cols = [c for c in cols if "days_since" in c]
    scale_cols = [c for c in cols if "days_since" not in c]
    center, scale = {}, {}
    if scale_cols:
        filled = df.select(*[F.coalesce(F.col(c).cast("double"), F.lit(0.0)).alias(c) for c in scale_cols])
        q = exact_quantiles(long_form(filled, scale_cols), "value", [0.25, 0.5, 0.75], ["feature"]).collect()
        qs = {(r["feature"], round(r["p"], 2)): r["q"] for r in q}
        for c in scale_cols:
            med = qs.get((c, 0.5), 0.0) or 0.0
            iqr = (qs.get((c, 0.75), 0.0) or 0.0) - (qs.get((c, 0.25), 0.0) or 0.0)
            center[c] = float(med)
            scale[c] = float(iqr) if abs(iqr) >= 10 * EPS64 else 1.0
    return Preprocessor(cols, log_cols, scale_cols, center, scale)


def preprocess(df: DataFrame, cols: Sequence[str] = R.FEATURE_COLUMNS, out: str = "features"):
    p = fit_preprocessor(df, cols)
    return p.transform(df, out), p


# ---- M2 / M3 ---------------------------------------------------------------------

class Centers:
    """A k-means model as a table: one centre per cluster id, ids in the order of the
    centres, so equal solutions carry the same ids wherever they started."""

    def __init__(self, centers, cost: float | None = None):
        self.centers = np.array(sorted(map(tuple, np.asarray(centers, dtype=float).tolist())))
        self.cost = cost

    def rows(self, spark: SparkSession) -> DataFrame:
        """cluster_id, center."""
        return spark.createDataFrame([(i, c) for i, c in enumerate(self.centers.tolist())], "cluster_id int, center array<double>")

    @staticmethod
    def of(rows: DataFrame) -> Centers:
        return Centers([r["center"] for r in rows.collect()])   # k rows

    def assign(self, df: DataFrame, features: str = "features") -> DataFrame:
        """Adds ``cluster_id``: the nearest centre, the first of equally near ones."""
        d = F.transform(F.array(*[F.array(*[F.lit(float(v)) for v in c]) for c in self.centers]), lambda c: _dist(F.col("_v"), c))
        return df.withColumn("_v", _vec_array(df, features)).withColumn("_d", d) \
            .withColumn("cluster_id", (F.array_position("_d", F.array_min("_d")) - 1).cast("int")).drop("_v", "_d")


def start_places(n: int, k: int, start: int, n_init: int, seed: int) -> list[int]:
    """Places (in id order, from 0) of the rows that a start begins at: evenly spread,
    each start and seed by a shift of its own."""
    shift = ((start + 0.5) / n_init + (seed % 1000) / 1000) % 1.0
    return [int(math.floor(n * (j + shift) / k)) for j in range(k)]


def kmeans_fits(x: DataFrame, id_col: str, ks: Sequence[int], n_init: int = 10, seed: int = 42, features: str = "features",
                tol: float = 1e-9, max_steps: int = 300) -> dict[int, Centers]:
    """M2: the best of ``n_init`` starts for every k, all of them in one chain of jobs.

    A step sends the centres of all fits that still move to the tasks (sum of
    ks x n_init points, whatever the rows), each task adds up its rows by (fit,
    nearest centre), and only those sums are reduced. Starts are rows at fixed
    places of the id order. Of equal costs the lowest start wins."""
    ks = list(ks)
    pts = x.select(F.col(id_col).alias("_id"), F.xxhash64(F.col(id_col).cast("string")).alias("h"), _vec_array(x, features).alias("v")).checkpoint(eager=True)
    n = pts.count()
    if not n:
        return {}
    fits = [(k, i) for k in ks for i in range(max(1, n_init))]
    places = [start_places(n, k, i, max(1, n_init), seed) for k, i in fits]
    wanted = sorted({p for ps in places for p in ps})
    at = {r["_gidx"]: r["v"] for r in global_index(pts, ["_id", "h"]).where(F.col("_gidx").isin(wanted)).collect()}
    d, most = len(next(iter(at.values()))), max(ks)
    centers = np.full((len(fits), most, d), FAR)
    for f, ps in enumerate(places):
        centers[f, :len(ps)] = [at[p] for p in ps]
    cost, moving, steps = np.full(len(fits), np.inf), np.ones(len(fits), bool), 0
    while moving.any() and steps < max_steps:
        live = np.flatnonzero(moving)
        centers[live], cost[live], moved = _step(pts, centers[live], live, None, seed)
        moving[live] = moved > tol
        steps += 1
    out = {}
    for k in ks:
        mine = [f for f, (kk, _) in enumerate(fits) if kk == k]
        best = min(mine, key=lambda f: (cost[f], f))
        out[k] = Centers(centers[best, :k], float(cost[best]))
    return out


def fit_kmeans(df: DataFrame, k: int, seed: int = 42, n_init: int = 10, features: str = "features", id_col: str = "channel_id") -> Centers:
    """One k of :func:`kmeans_fits`."""
    return kmeans_fits(df, id_col, [k], n_init, seed, features)[k]


def fit_gmm(df: DataFrame, k: int, seed: int = 42, features: str = "features") -> GaussianMixtureModel:
    gm = GaussianMixture(k=k, seed=seed, featuresCol=features, predictionCol="cluster_id",
                         probabilityCol="_prob", maxIter=100, tol=1e-3)
    return gm.fit(df)


def canonical_order(model) -> dict[int, int]:
    """Model cluster index -> canonical id (centres sorted lexicographically),
    so equal solutions found from different seeds carry the same ids."""
    if isinstance(model, GaussianMixtureModel):
        centers = [tuple(float(v) for v in r[0].toArray()) for r in model.gaussiansDF.select("mean").collect()]
    else:
        return {}
    ranked = sorted(range(len(centers)), key=lambda i: centers[i])
    return {old: new for new, old in enumerate(ranked)}


def predict(model, df: DataFrame) -> DataFrame:
    if isinstance(model, Centers):
        return model.assign(df)
    out = model.transform(df)
    if "_prob" in out.columns:
        out = out.drop("_prob")
    mp = canonical_order(model)
    cid = F.col("cluster_id").cast("int")
    if mp and any(a != b for a, b in mp.items()):
        expr = F.lit(None).cast("int")
        for a, b in mp.items():
            expr = F.when(cid == a, F.lit(b)).otherwise(expr)
        cid = expr
    return out.withColumn("cluster_id", cid)


# ---- M5 -----------------------------------------------------------------------------

SIL_BLOCKS = 32      # blocks of the all-pairs silhouette, while they stay between SIL_LEAST and SIL_BLOCK points
SIL_LEAST = 1024     # fewer points are not worth a block of their own
SIL_BLOCK = 16384    # most points of a block
TILE = 1 << 21       # distances whose sums are held at once
CACHED = 1 << 16     # distances of a tile


def _distances(a: np.ndarray, b: np.ndarray):
    """(first row of ``a``, Euclidean distances of some of its rows to all of ``b``) in tiles that
    stay in a core's cache, by a matrix product; pairs so close that it loses digits are
    taken from their differences. A tile holds only until the next one."""
    nb = (b * b).sum(1)
    right, low = np.ascontiguousarray(np.column_stack([b, np.ones(len(b)), nb]).T), 1e-4 * nb
    step = max(1, min(len(a), CACHED // max(1, len(b))))
    held, bound = np.empty((step, len(b))), np.empty((step, len(b)))
    for at in range(0, len(a), step):
        rows = a[at:at + step]
        na, m = (rows * rows).sum(1), len(rows)
        d2 = np.matmul(np.column_stack([-2.0 * rows, na, np.ones(m)]), right, out=held[:m])
        close = d2 < np.add.outer(1e-4 * na, low, out=bound[:m])           # all below 0 are among them
        if close.any():
            i, j = np.nonzero(close)
            for some in range(0, len(i), 1 << 16):
                x, y = i[some:some + (1 << 16)], j[some:some + (1 << 16)]
                d2[x, y] = ((rows[x] - b[y]) ** 2).sum(1)
        yield at, np.sqrt(d2, out=d2)


def _meeting(blocks: DataFrame, pairs: DataFrame, columns: Sequence[str], many: int | None = None) -> DataFrame:
    """Rows (p, blk, columns) of both blocks of each pair (p: its number from 0, a <= b)
    of ``pairs``, dealt in turn by that number, to no more tasks than there are pairs
    (``many``, if known); a block paired with itself comes once."""
    ends = pairs.select(F.col("p").cast("int").alias("p"), F.explode(F.array_distinct(F.array("a", "b"))).alias("blk"))
    n = int(blocks.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    n = n if many is None else max(1, min(n, many))
    return blocks.join(ends, "blk").select("p", "blk", *columns).repartitionById(n, F.col("p"))


def _both(pdf: pd.DataFrame):
    """The two blocks of a pair in order, or the one twice."""
    rows = sorted(pdf.itertuples(index=False), key=lambda r: r.blk)
    return rows[0], rows[-1]


def _runs(cl: np.ndarray) -> np.ndarray:
    """Starts of the runs of equal values."""
    return np.flatnonzero(np.r_[True, cl[1:] != cl[:-1]])


def _block_sums(key, pdf):
    """A pair of blocks, each sorted by cluster -> rows of their points: the sum of
    distances to the other block's points of a cluster and how many they are (the point
    itself apart), for the point's own cluster and for those that go on in another block;
    and the least mean distance to the other clusters, which are whole in the block."""
    left, right = _both(pdf)
    same = left.blk == right.blk
    side = [(np.int64(r.blk) << 32) + np.arange(len(r.cl)) for r in (left, right)]
    (lc, lt, lv), (rc, rt, rv) = [(np.asarray(r.cl), np.asarray(r.ct), np.asarray(r.vec, dtype=float).reshape(len(r.cl), -1)) for r in (left, right)]
    out = []

    def add(pid, cl, dsum, n, least):
        out.append(pd.DataFrame({"pid": pid, "cl": cl, "dsum": dsum, "n": n, "least": least}))

    def judged(pid, own, sums, names, sizes, whole):
        """``sums``: points x clusters of the other block, the clusters' distances added up."""
        n = sizes[None, :] - ((own[:, None] == names[None, :]) if same else 0)
        told = (~whole)[None, :] | (own[:, None] == names[None, :])
        i, j = np.nonzero(told)
        add(pid[i], pd.array(names[j], "Int64"), sums[i, j], np.broadcast_to(n, sums.shape)[i, j], np.nan)
        if not told.all():
            least = np.where(told, np.inf, sums / sizes[None, :]).min(1)
            held = np.isfinite(least)
            add(pid[held], pd.array([pd.NA] * int(held.sum()), "Int64"), 0.0, 0, least[held])

    starts = _runs(rc)
    names, sizes = rc[starts], np.diff(np.r_[starts, len(rc)])
    whole = rt[starts] == sizes
    l_starts = _runs(lc)
    l_sizes = dict(zip(lc[l_starts].tolist(), np.diff(np.r_[l_starts, len(lc)]).tolist()))
    carry = np.zeros(len(rc))
    step = max(1, TILE // len(rc))
    for at in range(0, len(lc), step):
        here = lc[at:at + step]
        runs = _runs(here)
        to_right, sums = np.empty((len(here), len(starts))), np.zeros((0 if same else len(runs), len(rc)))
        for low, d in _distances(lv[at:at + step], rv):
            if same:
                d[np.arange(len(d)), at + low + np.arange(len(d))] = 0.0
            to_right[low:low + len(d)] = np.add.reduceat(d, starts, axis=1)
            if not same:
                first, end = np.searchsorted(runs, [low, low + len(d) - 1], side="right")
                run = np.searchsorted(runs[first:end], low + np.arange(len(d)), side="right")
                sums[first - 1:end] += (np.arange(end - first + 1)[:, None] == run) @ d if end > first else d.sum(0)
        judged(side[0][at:at + step], here, to_right, names, sizes, whole)
        if same:
            continue
        # The other way: a cluster's rows may lie in several tiles.
        sums[0] += carry
        carry = np.zeros(len(rc))
        done = len(runs)
        if at + step < len(lc) and lc[at + step] == here[-1]:
            carry, done = sums[-1], done - 1
        if done:
            mine = here[runs[:done]]
            size = np.array([l_sizes[c] for c in mine.tolist()])
            judged(side[1], rc, sums[:done].T, mine, size, lt[at + runs[:done]] == size)
    return pd.concat(out)


def silhouette(df: DataFrame, features: str = "features", label: str = "cluster_id", id_col: str | None = None,
               exclude_noise: bool = False, method: str = "squared_euclidean",
               block_size: int | None = None) -> tuple[float | None, str]:
    """M5: mean silhouette and the distance it used. None with fewer than 2 labels.

    ``squared_euclidean`` (for every size, O(n k)): the closed form over one sum
    of points and of squared norms per cluster. ``euclidean``: scikit's
    definition over all pairs, in blocks, only when asked for. Blocks are cut from
    the rows in the order of their clusters, so of most clusters a block holds all
    points or none, and a point's rows do not grow with the clusters. There are
    ``SIL_BLOCKS`` blocks, each sent to as many pairs, more only where a block would
    exceed ``SIL_BLOCK`` points, fewer where it would hold less than ``SIL_LEAST``."""
    d = df.where(F.col(label) != -1) if exclude_noise else df
    stats = d.agg(F.count(F.lit(1)).alias("n"), F.countDistinct(label).alias("k")).collect()[0]
    n, k = stats["n"], stats["k"]
    if k < 2 or n < 3 or k > n - 1:
        return None, "undefined"
    if method == "squared_euclidean":
        v = d.select(array_to_vector(_vec_array(d, features)).alias("features"), F.col(label).cast("double").alias("label"))
        ev = ClusteringEvaluator(featuresCol="features", predictionCol="label", metricName="silhouette",
                                 distanceMeasure="squaredEuclidean")
        return float(ev.evaluate(v)), method
    if method != "euclidean":
        raise ValueError(method)
    pid = F.xxhash64(id_col) if id_col else F.lit(0)
    pts = d.select(F.lit(0).alias("g"), pid.alias("h"), F.col(label).cast("long").alias("cl"), _vec_array(d, features, keep=True).alias("vec"))
    return silhouettes(pts, {0: n}, block_size)[0], "euclidean"


def silhouettes(pts: DataFrame, rows: dict[int, int], block_size: int | None = None) -> dict[int, float | None]:
    """The Euclidean silhouettes of several labellings in one chain of jobs: ``pts`` has
    (g: the labelling, h: a hash of the id, cl, vec), ``rows`` how many rows each labelling
    has. Every labelling has blocks and pairs of blocks of its own, numbered on."""
    spark = pts.sparkSession
    # Every row is a point of its own: ids are positions in a block.
    plan, first, base, many = [], 0, 0, 0
    for g, n in sorted(rows.items()):
        size = int(block_size or min(SIL_BLOCK, max(SIL_LEAST, math.ceil(n / SIL_BLOCKS))))
        nb = math.ceil(n / size)
        plan.append((g, first, size, base, nb, many))
        first, base, many = first + n, base + nb, many + nb * (nb + 1) // 2
    plan = F.broadcast(spark.createDataFrame(plan, "g int, first long, size long, base long, nb long, met long"))   # a row per labelling
    placed = global_index(pts, ["g", "cl", "h", "vec"], index_col="row")
    totals = pts.groupBy("g", "cl").agg(F.count(F.lit(1)).alias("ct"))
    placed = placed.join(totals, ["g", "cl"]).join(plan, "g").withColumn("blk", F.col("base") + F.floor((F.col("row") - F.col("first")) / F.col("size")).cast("long"))
    blocks = placed.groupBy("g", "blk").agg(F.sort_array(F.collect_list(F.struct("row", "cl", "ct", "vec"))).alias("p"))
    blocks = blocks.select("g", "blk", F.col("p.cl").alias("cl"), F.col("p.ct").alias("ct"), F.flatten("p.vec").alias("vec")).checkpoint(eager=True)
    # Each pair of a labelling's blocks once: its distances serve both sides.
    pairs = plan.select("*", F.explode(F.sequence(F.lit(0).cast("long"), F.col("nb") - 1)).alias("a")).select("*", F.explode(F.sequence("a", F.col("nb") - 1)).alias("b"))
    place = F.col("met") + F.col("a") * F.col("nb") - F.floor(F.col("a") * (F.col("a") + 1) / 2) + F.col("b")
    pairs = pairs.select(place.alias("p"), (F.col("base") + F.col("a")).alias("a"), (F.col("base") + F.col("b")).alias("b"))
    part = _meeting(blocks, pairs, ["cl", "ct", "vec"], many).groupBy("p").applyInPandas(_block_sums, "pid long, cl long, dsum double, n long, least double")
    per = part.groupBy("pid", "cl").agg(F.sum("dsum").alias("dsum"), F.sum("n").alias("n"), F.min("least").alias("least"))
    own = blocks.select("g", "blk", F.posexplode("cl").alias("pos", "own")).select("g", (F.col("blk") * F.lit(1 << 32) + F.col("pos")).alias("pid"), "own")
    j = per.join(own, "pid")
    mean_d = F.try_divide(F.col("dsum"), F.col("n"))   # n = 0: alone in its cluster
    agg = j.groupBy("g", "pid").agg(
        F.max(F.when(F.col("cl") == F.col("own"), mean_d)).alias("a"),
        F.max(F.when(F.col("cl") == F.col("own"), F.col("n"))).alias("n_own"),
        F.min(F.when(F.col("cl").isNull(), F.col("least")).when((F.col("cl") != F.col("own")) & (F.col("n") > 0), mean_d)).alias("b"))
    s = F.when(F.coalesce(F.col("n_own"), F.lit(0)) == 0, F.lit(0.0)).otherwise(
        F.try_divide(F.col("b") - F.col("a"), F.greatest("a", "b")))
    found = agg.groupBy("g").agg(F.avg(F.coalesce(s, F.lit(0.0))).alias("s")).collect()   # a row per labelling
    return {g: None for g in rows} | {r["g"]: None if r["s"] is None else float(r["s"]) for r in found}


# ---- J9 / M4 ---------------------------------------------------------------------------

def _vec_array(df: DataFrame, features: str, keep: bool = False) -> Column:
    """The vector as an array of doubles; ``keep`` leaves an array of floats as it is."""
    if isinstance(df.schema[features].dataType, T.UserDefinedType):
        return vector_to_array(F.col(features))
    if keep and df.schema[features].dataType.simpleString() == "array<float>":
        return F.col(features)
    return F.col(features).cast("array<double>")


def _dist(a: Column, b: Column) -> Column:
    sq = F.aggregate(F.zip_with(a, b, lambda x, y: (x - y) * (x - y)), F.lit(0.0), lambda acc, v: acc + v)
    return F.sqrt(sq)


def eps_neighbours(df: DataFrame, id_col: str, features: str, eps: float, grid_dims: int = 3,
                   include_self: bool = False) -> DataFrame:
    """All ordered pairs (i, j), i != j, with Euclidean distance <= eps.

    Points are cut into blocks of about equal size by the ``grid_dims`` coordinates of
    the largest variance (``spatial_blocks``). Blocks whose boxes come within eps meet,
    each pair of them in one task, which writes the true neighbours only; so tasks are
    of bounded size however dense a region is."""
    pts = df.select(F.col(id_col).alias("pid"), _vec_array(df, features).alias("vec"))
    placed, boxes = spatial_blocks(pts, ["pid"], grid_dims, CELL_CHUNK)
    blocks = placed.groupBy("blk").agg(F.collect_list(F.struct("pid", "vec")).alias("_p")) \
        .select("blk", F.col("_p.pid").alias("pid"), F.flatten("_p.vec").alias("vec")).checkpoint(eager=True)
    id_type = pts.schema["pid"].dataType.simpleString()

    def found(key, pdf):
        left, right = _both(pdf)
        a, b = _points(left, len(left.pid)), _points(right, len(right.pid))
        names = (pd.Series(left.pid, dtype=object).to_numpy(), pd.Series(right.pid, dtype=object).to_numpy())
        out = []
        for at, d2 in _tiles(a, b):
            x, y = np.nonzero(d2 <= _square(eps))
            i, j, d = names[0][at + x], names[1][y], np.sqrt(d2[x, y])
            out.append((i, j, d))
            if left.blk != right.blk:
                out.append((j, i, d))
        i, j, d = (np.concatenate([o[c] for o in out]) for c in range(3))
        keep = np.ones(len(i), bool) if include_self else i != j
        return pd.DataFrame({"i": i[keep], "j": j[keep], "distance": d[keep]})

    return _meeting(blocks, near_blocks(boxes, eps), ["pid", "vec"]).groupBy("p").applyInPandas(found, f"i {id_type}, j {id_type}, distance double")


def _points(block, n: int) -> np.ndarray:
    return np.asarray(block.vec, dtype=float).reshape(n, -1)


def _square(eps: float) -> float:
    """The largest square whose root is at most eps, so that squares compare as distances do."""
    t = np.float64(eps) * np.float64(eps)
    while np.sqrt(t) > eps:
        t = np.nextafter(t, -np.inf)
    while np.sqrt(np.nextafter(t, np.inf)) <= eps:
        t = np.nextafter(t, np.inf)
    return float(t)


def _tiles(a: np.ndarray, b: np.ndarray):
    """(first row of ``a``, squared distances of some of its rows to all of ``b``), added up coordinate by coordinate."""
    step = max(1, TILE // 8 // max(1, len(b)))
    for at in range(0, len(a), step):
        rows = a[at:at + step]
        d2 = np.zeros((len(rows), len(b)))
        for c in range(a.shape[1]):
            one = rows[:, c][:, None] - b[:, c][None, :]
            one *= one
            d2 += one
        yield at, d2


def spatial_blocks(points: DataFrame, key: Sequence[str], grid_dims: int, size: int) -> tuple[DataFrame, DataFrame]:
    """(points with ``blk``, boxes: blk, lo, hi): points (key, vec) in blocks of at most
    about ``size`` of them that lie together.

    The coordinates of the largest variance are halved in turn at the medians of a sample of
    32 points a block, drawn by a hash; a leaf that still has more points, as where
    coordinates tie, is dealt over several blocks by the hash. Points without a vector are left out."""
    points = points.where(F.col("vec").isNotNull())
    stats = points.agg(F.count(F.lit(1)).alias("n"), F.max(F.size("vec")).alias("dim")).first()
    n, dim = stats["n"], stats["dim"] or 0
    var = points.agg(*[F.var_pop(F.get("vec", F.lit(i))).alias(f"v{i}") for i in range(dim)]).first() if dim else None
    spread = [var[f"v{i}"] if var[f"v{i}"] is not None and math.isfinite(var[f"v{i}"]) else 0.0 for i in range(dim)]
    dims = sorted(range(dim), key=lambda i: (-spread[i], i))[:max(0, grid_dims)]
    levels = max(0, math.ceil(math.log2(max(1, n / size)))) if dims else 0
    h = F.xxhash64(*key, "vec")
    some = points.select(h.alias("_h"), "vec").orderBy("_h").limit(32 << levels).collect() if levels else []
    cuts = _halves(np.array([[r["vec"][i] for i in dims] for r in some], dtype=float).reshape(len(some), len(dims)), levels)
    kept = points.columns

    def leaves(it):
        for pdf in it:
            x = np.array([[v[i] for i in dims] for v in pdf["vec"]], dtype=float).reshape(len(pdf), len(dims))
            at = np.zeros(len(pdf), int)                                 # node of the level
            for level in cuts:
                dim_of, cut_of = np.array([c for c, _ in level]), np.array([t for _, t in level])
                at = 2 * at + (x[np.arange(len(x)), dim_of[at]] > cut_of[at])
            yield pdf.assign(_leaf=at.astype("int64"))

    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in points.schema.fields)
    placed = points.mapInPandas(leaves, f"{fields}, _leaf long") if levels else points.withColumn("_leaf", F.lit(0).cast("long"))
    counts = placed.groupBy("_leaf").agg(F.count(F.lit(1)).alias("_n"))
    placed = placed.join(counts, "_leaf").withColumn("_part", F.pmod(h, F.ceil(F.col("_n") / size)))
    placed = placed.select(*kept, (F.col("_leaf") * F.lit(1 << 32) + F.col("_part")).alias("blk")).checkpoint(eager=True)
    known = lambda i: F.nanvl(F.get("vec", F.lit(i)), F.lit(None).cast("double"))
    ends = [[f(known(i)).alias(f"{f.__name__}{i}") for i in range(dim)] for f in (F.min, F.max)]
    boxes = placed.groupBy("blk").agg(F.count(F.lit(1)).alias("n"), *ends[0], *ends[1])
    row = lambda name: F.array(*[F.col(f"{name}{i}") for i in range(dim)]).cast("array<double>")
    return placed, boxes.select("blk", "n", row("min").alias("lo"), row("max").alias("hi"))


def _halves(x: np.ndarray, levels: int) -> list[list[tuple[int, float]]]:
    """Per level, per node: the coordinate that is cut (that of the largest spread) and where."""
    parts, out = [x], []
    for _ in range(levels):
        level, below = [], []
        for p in parts:
            if len(p):
                wide = np.nan_to_num(np.ptp(p, axis=0), nan=0.0)
                c = int(np.argmax(wide))
                t = float(np.median(p[:, c]))
                t = t if (p[:, c] > t).any() or not (p[:, c] < t).any() else float(p[p[:, c] < t, c].max())
            else:
                c, t = 0, 0.0
            level.append((c, t))
            below += [p[~(p[:, c] > t)], p[p[:, c] > t]] if len(p) else [p, p]
        out.append(level)
        parts = below
    return out


def near_blocks(boxes: DataFrame, eps: float) -> DataFrame:
    """Pairs (p: number from 0, a, b; a <= b) of blocks whose boxes come within eps."""
    a = boxes.select(F.col("blk").alias("a"), F.col("lo").alias("al"), F.col("hi").alias("ah"))
    b = boxes.select(F.col("blk").alias("b"), F.col("lo").alias("bl"), F.col("hi").alias("bh"))
    met = a.join(b, F.col("a") <= F.col("b"))
    gap = F.zip_with(F.arrays_zip("al", "ah"), F.arrays_zip("bl", "bh"), lambda x, y: F.coalesce(F.greatest(x["al"] - y["bh"], y["bl"] - x["ah"], F.lit(0.0)), F.lit(0.0)))
    met = met.where((F.col("a") == F.col("b")) | (F.sqrt(F.aggregate(gap, F.lit(0.0), lambda t, v: t + v * v)) <= F.lit(float(eps) * (1 + 1e-9))))
    return global_index(met.select("a", "b"), ["a", "b"], index_col="p").select("p", "a", "b")


def connected_components(nodes: DataFrame, edges: DataFrame) -> DataFrame:
    """Min-label propagation with pointer jumping. nodes(id, lab) with lab a
    node id (initially the node itself), edges(src, dst) symmetric. Each round
    takes the smallest label among neighbours, then jumps lab <- lab(lab), so
    long chains shrink geometrically instead of one hop per round. Every round
    is a table in the shared folder (short lineage; a lost executor recomputes
    one round)."""
    edges, labels = saved(edges, "component-edges"), saved(nodes.select("id", "lab"), "component-labels")
    while True:
        nb = edges.join(labels.withColumnRenamed("id", "dst"), "dst").groupBy("src").agg(F.min("lab").alias("nl"))
        step = labels.join(nb.withColumnRenamed("src", "id"), "id", "left") \
            .select("id", F.col("lab").alias("old"), F.least("lab", F.coalesce("nl", "lab")).alias("lab"))
        parent = step.select(F.col("id").alias("lab"), F.col("lab").alias("pl"))
        labels = saved(step.join(parent, "lab", "left").select("id", F.least("lab", F.coalesce("pl", "lab")).alias("lab"), "old"), "component-labels")
        if labels.where("lab <> old").isEmpty():
            return labels.select("id", "lab")
        labels = labels.select("id", "lab")


def collapse_points(df: DataFrame, id_col: str, features: str, order_col: str | None = None):
    """(points, unique points): every row gets a dense row index over
    (order, id); identical vectors collapse to one weighted point whose uid is
    the smallest row index among its copies (N17's 'lowest row index')."""
    order = F.col(order_col) if order_col else F.col(id_col)
    pts = df.select(F.col(id_col).alias("pid"), order.alias("ord"), _vec_array(df, features).alias("vec"))
    pts = global_index(pts, ["ord", "pid"], index_col="row", nulls_last=True)
    uniq = pts.groupBy("vec").agg(F.count(F.lit(1)).alias("w"), F.min("row").alias("uid")).checkpoint(eager=True)
    return pts, uniq


CELL_CHUNK = 2048   # points of a block


def _reach(near: np.ndarray, core: np.ndarray) -> np.ndarray:
    """Of the core points of a block, the first point of each one's component; -1 for the others."""
    lab = np.full(len(core), -1)
    for i in np.flatnonzero(core):
        if lab[i] < 0:
            todo = np.array([i])
            lab[i] = i
            while len(todo):
                todo = np.flatnonzero(near[todo].any(0) & core & (lab < 0))
                lab[todo] = i
    return lab


def dbscan_grid(df: DataFrame, id_col: str, features: str = "features", grid=DBSCAN_GRID, order_col: str | None = None,
                grid_dims: int = 3, chunk: int = CELL_CHUNK) -> DataFrame:
    """M4 / N17 for every (eps, min_samples) of ``grid`` in one chain of jobs:
    g (place in the grid), id, cluster_id; -1 = noise. min_samples counts the point itself.

    Points lie in blocks of about ``chunk`` (``spatial_blocks``); only blocks whose boxes
    come within the largest eps meet, each pair in one task. A first pass adds up the
    weights within each eps, which tells the core points. Each block then joins its own
    core points into components, and a second pass over the pairs gives the links
    between components of two blocks and, for points that are not core, the components
    near them: no pair of points is ever written. Identical points are one weighted point."""
    pts, uniq = collapse_points(df, id_col, features, order_col)
    grid = [(float(e), int(m)) for e, m in grid]
    eps_of = sorted({e for e, _ in grid})
    square = [_square(e) for e in eps_of]
    tries = [(eps_of.index(e), m) for e, m in grid]
    placed, boxes = spatial_blocks(uniq.select("uid", "w", "vec"), ["uid"], grid_dims, chunk)
    pairs = near_blocks(boxes, eps_of[-1]).checkpoint(eager=True)
    many = pairs.count()
    blocked = lambda p, *cols: p.groupBy("blk").agg(F.sort_array(F.collect_list(F.struct("uid", *cols, "vec"))).alias("_p")).select(
        "blk", F.col("_p.uid").alias("uid"), *[F.col(f"_p.{c}").alias(c) for c in cols], F.flatten("_p.vec").alias("vec"))

    def weights(key, pdf):
        left, right = _both(pdf)
        a, b = _points(left, len(left.uid)), _points(right, len(right.uid))
        wa, wb = np.asarray(left.w, dtype=float), np.asarray(right.w, dtype=float)   # whole numbers below 2^53
        na, nb = np.zeros((len(a), len(square))), np.zeros((len(b), len(square)))
        for at, d2 in _tiles(a, b):
            for e, most in enumerate(square):
                near = (d2 <= most).astype(float)
                na[at:at + len(d2), e] += near @ wb
                nb[:, e] += wa[at:at + len(d2)] @ near
        sums = [(left.uid, na)] + ([(right.uid, nb)] if left.blk != right.blk else [])
        return pd.concat([pd.DataFrame({"uid": np.asarray(u), **{f"n{e}": n[:, e].astype("int64") for e in range(len(square))}}) for u, n in sums])

    near = [f"n{e}" for e in range(len(eps_of))]
    counted = _meeting(blocked(placed, "w"), pairs, ["uid", "w", "vec"], many).groupBy("p").applyInPandas(weights, "uid long, " + ", ".join(f"{c} long" for c in near))
    counted = counted.groupBy("uid").agg(*[F.sum(c).alias(c) for c in near])
    # The core points of each (eps, min_samples): one bit per place in the grid.
    bits = [F.when(F.col(near[e]) >= m, F.lit(1 << g)).otherwise(F.lit(0)).cast("long") for g, (e, m) in enumerate(tries)]
    judged = placed.join(counted, "uid").select("blk", "uid", "vec", sum(bits[1:], bits[0]).alias("core"))

    def within(it):
        """Per point of a block, for each place in the grid, the least uid of its component in the block; -1: not core."""
        for pdf in it:
            for r in pdf.itertuples(index=False):
                uid, x, core = np.asarray(r.uid), _points(r, len(r.uid)), np.asarray(r.core)
                out = np.full((len(uid), len(tries)), -1, dtype="int64")
                found = [np.zeros((len(x), len(x)), bool) for _ in square]
                for at, d2 in _tiles(x, x):
                    for e, most in enumerate(square):
                        found[e][at:at + len(d2)] = d2 <= most
                for g, (e, _) in enumerate(tries):
                    lab = _reach(found[e], (core >> g) & 1 == 1)
                    out[:, g] = np.where(lab >= 0, uid[lab], -1)             # uids rise in a block
                yield pd.DataFrame({"blk": [r.blk], "uid": [uid], "vec": [np.asarray(r.vec)], "loc": [out.ravel()]})

    parts = blocked(judged, "core").mapInPandas(within, "blk long, uid array<long>, vec array<double>, loc array<long>").checkpoint(eager=True)

    def links(key, pdf):
        """g, a, b: of two components of core points, or of a point that is not core (its
        uid, ``border``) and a component near it."""
        left, right = _both(pdf)
        a, b = _points(left, len(left.uid)), _points(right, len(right.uid))
        la, lb = (np.asarray(r.loc).reshape(-1, len(tries)) for r in (left, right))
        ua, ub = np.asarray(left.uid), np.asarray(right.uid)
        names = [(np.unique(la[:, g], return_inverse=True), np.unique(lb[:, g], return_inverse=True)) for g in range(len(tries))]
        linked, on_a, on_b = ([set() for _ in tries] for _ in range(3))
        same = left.blk == right.blk
        for at, d2 in _tiles(a, b):
            for e, most in enumerate(square):
                i, j = np.nonzero(d2 <= most)
                if not len(i):
                    continue
                i = i + at
                for g, (own, _) in enumerate(tries):
                    if own != e:
                        continue
                    (na, ia), (nb, ib) = names[g]
                    ca, cb = la[i, g] >= 0, lb[j, g] >= 0
                    if not same:
                        hit = np.unique(ia[i[ca & cb]] * len(nb) + ib[j[ca & cb]])
                        linked[g].update(zip(na[hit // len(nb)].tolist(), nb[hit % len(nb)].tolist()))
                    hit = np.unique(i[~ca & cb] * len(nb) + ib[j[~ca & cb]])
                    on_a[g].update(zip(ua[hit // len(nb)].tolist(), nb[hit % len(nb)].tolist()))
                    if not same:
                        hit = np.unique(j[ca & ~cb] * len(na) + ia[i[ca & ~cb]])
                        on_b[g].update(zip(ub[hit // len(na)].tolist(), na[hit % len(na)].tolist()))
        out = [(g, x, y, border) for kinds, border in ((linked, False), (on_a, True), (on_b, True)) for g, some in enumerate(kinds) for x, y in some]
        return pd.DataFrame(out, columns=["g", "a", "b", "border"]).astype({"g": "int32", "a": "int64", "b": "int64", "border": "bool"})

    met = _meeting(parts, pairs, ["uid", "vec", "loc"], many).groupBy("p").applyInPandas(links, "g int, a long, b long, border boolean").distinct()
    met = saved(met, "dbscan-links")
    labelled = parts.select(F.explode(F.arrays_zip("uid", F.transform(F.sequence(F.lit(0), F.size("uid") - 1), lambda i: F.slice("loc", i * len(tries) + 1, len(tries))).alias("loc"))).alias("_o")) \
        .select(F.col("_o.uid").alias("uid"), F.posexplode("_o.loc").alias("g", "low"))
    node = lambda c: F.col("g") * F.lit(1 << 48) + F.col(c)
    heads = labelled.where("low >= 0").select("g", "low").distinct()
    core_links = met.where(~F.col("border")).select(node("a").alias("src"), node("b").alias("dst"))
    comp = connected_components(heads.select(node("low").alias("id"), node("low").alias("lab")), core_links.unionAll(core_links.select("dst", "src")))
    # Clusters are numbered by their lowest core row index (N17), which is their label's.
    named = heads.join(comp.select("id", "lab"), node("low") == F.col("id")).select("g", "low", "lab")
    roots = named.select("g", "lab").distinct()
    ranked = rank_in_groups(roots, ["g"], ["lab"]).select("lab", (F.col("_rank") - 1).cast("int").alias("cluster_id"))
    cluster = named.join(ranked, "lab").select("g", "low", "cluster_id")
    border = met.where("border").join(cluster.withColumnRenamed("low", "b"), ["g", "b"]).groupBy("g", F.col("a").alias("uid")).agg(F.min("cluster_id").alias("bcl"))
    label = labelled.join(cluster, ["g", "low"], "left").join(border, ["g", "uid"], "left") \
        .groupBy("uid").agg(F.map_from_entries(F.collect_list(F.struct("g", F.coalesce("cluster_id", "bcl", F.lit(-1)).alias("c")))).alias("_of"))
    label = uniq.select("uid", "vec").join(label, "uid").select("vec", "_of")
    return pts.join(label, "vec").select(F.col("pid").alias(id_col), F.explode("_of").alias("g", "cluster_id")).select("g", id_col, "cluster_id")


def dbscan(df: DataFrame, id_col: str, features: str = "features", eps: float = 0.5, min_samples: int = 5,
           order_col: str | None = None, grid_dims: int = 3, chunk: int = CELL_CHUNK) -> DataFrame:
    """DBSCAN labels (id, cluster_id); -1 = noise. See :func:`dbscan_grid`."""
    return dbscan_grid(df, id_col, features, [(eps, min_samples)], order_col, grid_dims, chunk).drop("g")


# ---- M6 / M7: selection ------------------------------------------------------------------

@dataclass
class Fitted:
    model_type: str
    k: int
    model: object = None            # Centers, MLlib mixture or None
    labels: DataFrame | None = None  # DBSCAN labels (id, cluster_id)
    params: dict = field(default_factory=dict)
    silhouettes: dict = field(default_factory=dict)
    trials: list = field(default_factory=list)

    def assign(self, x: DataFrame, id_col: str) -> DataFrame:
        if self.model_type == "dbscan":
            return x.drop("cluster_id").join(self.labels, id_col, "left") \
                .withColumn("cluster_id", F.coalesce(F.col("cluster_id"), F.lit(-1)).cast("int"))
        return predict(self.model, x.drop("cluster_id"))


def _noise_frac(labels: DataFrame) -> float:
    r = labels.agg(F.avg((F.col("cluster_id") == -1).cast("double")).alias("f")).collect()[0]["f"]
    return float(r or 0.0)


def _n_labels(labels: DataFrame, exclude_noise: bool) -> int:
    d = labels.where(F.col("cluster_id") != -1) if exclude_noise else labels
    return d.select("cluster_id").distinct().count()


def _judged(numbered: Sequence[DataFrame], id_col: str, method: str) -> tuple[dict, dict]:
    """(silhouette, share of noise) of each labelling g in ``numbered`` (g, id, features,
    cluster_id); noise takes no part in a silhouette, which is missing below two clusters."""
    if not numbered:
        return {}, {}
    every = numbered[0]
    for more in numbered[1:]:
        every = every.unionByName(more)
    every = saved(every.select("g", F.xxhash64(id_col).alias("h"), F.col("cluster_id").cast("long").alias("cl"), _vec_array(every, "features").alias("vec")), "labellings")
    noisy = F.col("cl") == -1
    stats = every.groupBy("g").agg(F.avg(noisy.cast("double")).alias("noise"), F.count(F.when(~noisy, 1)).alias("n"), F.countDistinct(F.when(~noisy, F.col("cl"))).alias("k")).collect()
    rows = {r["g"]: r["n"] for r in stats if r["k"] >= 2 and r["n"] >= 3 and r["k"] <= r["n"] - 1}
    pts = every.where(~noisy)
    if not rows:
        sils = {}
    elif method == "euclidean":
        sils = silhouettes(pts.where(F.col("g").isin(list(rows))), rows)
    else:
        with ThreadPoolExecutor(max_workers=FIT_THREADS) as pool:
            one = lambda g: silhouette(pts.where(F.col("g") == g), "vec", "cl", method=method)[0]
            sils = dict(zip(rows, pool.map(one, rows)))
    return sils, {r["g"]: float(r["noise"] or 0.0) for r in stats}


def select_best_model(x: DataFrame, id_col: str, k_min: int = 3, k_max: int = 5, seed: int = 42,
                      n_init: int = 10, grid=DBSCAN_GRID, method: str = "euclidean", kinds: Sequence[str] = ("kmeans", "gmm")) -> Fitted:
    """M6: KMeans then GMM for k in [k_min, k_max], then the DBSCAN grid (noise
    excluded); strictly greater silhouette wins in that order; DBSCAN refused
    above 20% noise. ``method``: the silhouette's distance; ``kinds``: which models
    with k take part. The candidates are fitted as concurrent Spark jobs and scored
    in one chain of jobs; the choice is made afterwards in the fixed order, so it
    does not depend on which job finishes first."""
    ks = list(range(k_min, k_max + 1))

    means = kmeans_fits(x, id_col, ks, n_init, seed) if "kmeans" in kinds else {}

    def fitted(kind, k):
        m = means[k] if kind == "kmeans" else fit_gmm(x, k, seed)
        return kind, k, m, predict(m, x).select(id_col, "features", "cluster_id")

    with ThreadPoolExecutor(max_workers=FIT_THREADS) as pool:
        mllib = list(pool.map(lambda a: fitted(*a), [(kind, k) for kind in kinds for k in ks]))
    grid = list(grid)
    labels = dbscan_grid(x, id_col, "features", grid).checkpoint(eager=True) if grid else None

    # All labellings in one frame: those of the models with k, then the grid's without noise.
    numbered = [lab.withColumn("g", F.lit(i)) for i, (_, _, _, lab) in enumerate(mllib)]
    if grid:
        numbered.append(x.select(id_col, "features").join(labels, id_col).withColumn("g", F.col("g") + len(mllib)))
    sils, noise = _judged(numbered, id_col, method)
    mllib = [(kind, k, m, sils.get(i) or 0.0) for i, (kind, k, m, _) in enumerate(mllib)]
    dbs = [(*grid[g], labels.where(F.col("g") == g).drop("g"), sils.get(len(mllib) + g) or 0.0, noise.get(len(mllib) + g, 0.0)) for g in range(len(grid))]

    trials, best, best_sil = [], None, -1.0
    for kind, k, m, sil in mllib:                        # kmeans k asc, then gmm k asc
        trials.append({"model_type": kind, "param": f"k={k}", "silhouette": sil})
        if sil > best_sil:
            best_sil, best = sil, Fitted(kind, k, m, params={"k": k})
    best_db, best_db_sil, best_db_labels = None, -1.0, None
    for eps, ms, lab, sil, noise in dbs:
        trials.append({"model_type": "dbscan", "param": f"eps={eps},min_samples={ms}", "silhouette": sil,
                       "noise_frac": noise})
        if sil > best_db_sil:
            best_db_sil, best_db, best_db_labels = sil, (eps, ms, noise), lab
    if best_db is not None and best_db_sil > best_sil and best_db[2] <= 0.2:
        k = _n_labels(best_db_labels, True)
        best_sil, best = best_db_sil, Fitted("dbscan", k, None, best_db_labels,
                                             params={"eps": best_db[0], "min_samples": best_db[1]})
    best.silhouettes["selection"] = best_sil
    best.trials = trials
    return best


def fit_model(x: DataFrame, id_col: str, model_type: str = "auto", min_clusters: int = 3, max_clusters: int = 5,
              seed: int = 42, n_init: int = 10, method: str = "euclidean") -> Fitted:
    """M7: forced model or auto selection. Forced k = max(min_clusters, 2);
    forced DBSCAN(0.5, 5) falls back to KMeans above 20% noise."""
    if model_type == "auto":
        return select_best_model(x, id_col, min_clusters, max_clusters, seed, n_init, method=method)
    k = max(min_clusters, 2)
    if model_type == "gmm":
        return Fitted("gmm", k, fit_gmm(x, k, seed), params={"k": k})
    if model_type == "dbscan":
        lab = dbscan(x, id_col, "features", 0.5, 5).checkpoint(eager=True)
        if _noise_frac(lab) > 0.2:
            return Fitted("kmeans", k, fit_kmeans(x, k, seed, n_init, id_col=id_col), params={"k": k, "fallback_from": "dbscan"})
        return Fitted("dbscan", _n_labels(lab, True), None, lab, params={"eps": 0.5, "min_samples": 5})
    return Fitted("kmeans", k, fit_kmeans(x, k, seed, n_init, id_col=id_col), params={"k": k})


# ---- M8 -----------------------------------------------------------------------------------

def healthy_centroid(fitted: Fitted | Sequence[Sequence[float]], scored: DataFrame) -> list[float] | None:
    """Centre of the cluster most common among Healthy rows (ties: smallest id);
    without Healthy rows, the cluster with the highest mean momentum. Takes a
    fitted model or the centres themselves, by cluster id."""
    if isinstance(fitted, Fitted):
        if fitted.model_type not in ("kmeans", "gmm"):
            return None
        fitted = _centers(fitted)
    centers = [list(map(float, c)) for c in fitted]
    h = scored.where(F.col("risk_flag") == "Healthy").groupBy("cluster_id").count() \
        .orderBy(F.col("count").desc(), F.col("cluster_id").asc()).limit(1).collect()
    if h:
        cid = int(h[0]["cluster_id"])
    else:
        m = scored.groupBy("cluster_id").agg(F.avg("momentum_ratio").alias("m")) \
            .orderBy(F.col("m").desc_nulls_last(), F.col("cluster_id")).limit(1).collect()
        if not m:
            return None
        cid = int(m[0]["cluster_id"])
    return centers[cid] if 0 <= cid < len(centers) else None


def distance_to(z_cols: Sequence[str], center: Sequence[float]) -> Column:
    """Euclidean distance of the preprocessed columns to a fixed centre."""
    sq = None
    for c, v in zip(z_cols, center):
        t = (F.col(c) - F.lit(float(v))) * (F.col(c) - F.lit(float(v)))
        sq = t if sq is None else sq + t
    return F.sqrt(sq)


# ---- M9 -------------------------------------------------------------------------------------

def _poisson1_cdf() -> list[float]:
    """P(X <= k) of a Poisson(1) variable, until the tail is below 2^-53."""
    out, term, total, k = [], math.exp(-1), 0.0, 0
    while 1.0 - total > 2.0 ** -53 and k < 64:
        total += term
        out.append(total)
        k += 1
        term /= k
    return out


_POISSON1_CDF = np.array(_poisson1_cdf())


def poisson_draws(ids: np.ndarray, iterations: np.ndarray, seed: int) -> np.ndarray:
    """Poisson(1) weights (rows x iterations) from a hash of (row's id hash,
    iteration, seed): resampling with replacement, the same on recomputation."""
    with np.errstate(over="ignore"):
        h = ids.astype(np.uint64)[:, None] ^ (iterations.astype(np.uint64)[None, :] * np.uint64(0x9E3779B97F4A7C15)
                                              + np.uint64(seed) * np.uint64(0xD6E8FEB86659FD93))
        h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        h ^= h >> np.uint64(31)
    u = (h >> np.uint64(11)).astype(float) / float(1 << 53)
    drawn = np.zeros(u.shape, np.uint8)
    for bound in _POISSON1_CDF:                      # few rows get past the first bounds
        past = u >= bound
        if not past.any():
            break
        drawn += past
    return drawn.astype(float)


def _align(centers_ref: np.ndarray, centers_new: np.ndarray) -> dict[int, int]:
    """Map each refit cluster to its nearest base cluster."""
    out = {}
    for i, c in enumerate(centers_new):
        out[i] = int(np.argmin(((centers_ref - c) ** 2).sum(axis=1)))
    return out


def _turned(centers: np.ndarray) -> np.ndarray:
    """Centres (refits x k x d) as :func:`_nearest` takes them: k x (d + 1) x refits, -2 times the centre and its square."""
    return np.ascontiguousarray(np.concatenate([-2.0 * centers, (centers * centers).sum(2, keepdims=True)], axis=2).transpose(1, 2, 0))


def _with_one(v: np.ndarray) -> np.ndarray:
    return np.column_stack([v, np.ones(len(v))])


def _nearest(v1: np.ndarray, turned: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(nearest centre, squared distance) of each row (with a 1 at its end) for each refit:
    rows x refits; ``turned``: the centres by :func:`_turned`. The first centre wins ties."""
    least = v1 @ turned[0]                           # the row's own square is the same for all centres
    near = np.zeros(least.shape, np.uint8 if len(turned) <= 256 else np.int64)
    for c in range(1, len(turned)):
        d2 = v1 @ turned[c]
        np.maximum(near, (d2 < least) * near.dtype.type(c), out=near)
        np.minimum(least, d2, out=least)
    least += (v1[:, :-1] ** 2).sum(1)[:, None]
    return near, np.maximum(least, 0.0, out=least)


def _rows_of(pdf: pd.DataFrame, at: int, size: int):
    part = pdf.iloc[at:at + size]
    return part["h"].to_numpy(), np.array(part["v"].tolist(), dtype=float)


BOOT_ROWS = 64   # rows compared with all refits at once
BOOT_REFITS = 512   # refits whose distances to those rows are held at once
FAR = 1e100      # a centre that no row is nearest to


def _lloyd_step(centers: np.ndarray, refits: np.ndarray, iterations: np.ndarray | None, seed: int):
    """Task: weighted sums of its own rows per (refit, cluster), one row each; without
    ``iterations`` every row weighs 1."""
    def run(it):
        r, k, d = centers.shape
        total, spent = np.zeros((r, k, d + 2)), np.zeros(r)
        # The starts of an iteration share its rows' weights.
        draws, drawn_at = (None, None) if iterations is None else np.unique(iterations, return_inverse=True)
        most = BOOT_ROWS if iterations is not None else max(BOOT_ROWS, TILE // 2 // (r * k))
        parts = [slice(at, at + BOOT_REFITS) for at in range(0, r, BOOT_REFITS)]
        parts = [(part, _turned(centers[part]), None if iterations is None else drawn_at[part]) for part in parts]
        for pdf in it:
            for at in range(0, len(pdf), most):
                h, v = _rows_of(pdf, at, most)
                drawn = None if draws is None else poisson_draws(h, draws, seed)
                v1 = _with_one(v)
                for part, turned, own in parts:
                    near, d2 = _nearest(v1, turned)
                    w = None if drawn is None else drawn[:, own]
                    spent[part] += d2.sum(0) if w is None else np.einsum("nr,nr->r", w, d2)
                    for c in range(k):
                        wc = near == c
                        total[part, c, :d + 1] += (wc.astype(float) if w is None else w * wc).T @ v1
        total[np.arange(r), total[:, :, d].argmax(1), d + 1] = spent    # a fit's cost comes with its largest cluster
        rr, cc = np.nonzero(total[:, :, d] > 0)
        if len(rr):                                  # a task may have no rows, or none that weighs anything
            yield pd.DataFrame({"refit": refits[rr], "cl": cc, "sums": list(total[rr, cc])})
    return run


def _reduced(rows: DataFrame, live: np.ndarray, wide: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The tasks' rows (refit, cl, sums) added up, fits x k of them at most: (place of the
    refit among ``live``, which rise, cluster, sums)."""
    got = rows.groupBy("refit", "cl").agg(F.array(*[F.sum(F.get("sums", F.lit(j))) for j in range(wide)]).alias("t")).collect()
    refit, cl = (np.array([r[c] for r in got], dtype=int) for c in ("refit", "cl"))
    return np.searchsorted(live, refit), cl, np.array([r["t"] for r in got], dtype=float).reshape(len(got), wide)


def _step(pts: DataFrame, centers: np.ndarray, live: np.ndarray, iterations: np.ndarray | None, seed: int):
    """One Lloyd step of the ``live`` fits: (new centres, cost under the old ones, how far each fit moved)."""
    d = centers.shape[2]
    rows = pts.select("h", "v").mapInPandas(_lloyd_step(centers, live, iterations, seed), "refit int, cl int, sums array<double>")
    at, cl, t = _reduced(rows, live, d + 2)
    new, spent = centers.copy(), np.zeros(len(live))
    new[at, cl] = t[:, :d] / t[:, d:d + 1]
    np.add.at(spent, at, t[:, d + 1])
    return new, spent, np.abs(new - centers).max(axis=(1, 2))


def bootstrap_kmeans(x: DataFrame, id_col: str, k: int, n_iter: int, n_init: int = 5, seed: int = 42,
                     tol: float = 1e-6, max_steps: int = 300):
    """All refits of a k-means bootstrap as one chain of jobs over the n rows.

    Refit (iteration, start) begins at k rows of its own, drawn by a hash. A step
    sends the centres of all refits that still move to the tasks (n_iter x
    n_init x k points, whatever n), each task draws its rows' weights and adds
    up weighted sums, and only those sums are reduced: no row is replicated.
    Returns (rows frame, centres of each iteration's best start, iterations
    whose best start still moved after ``max_steps``)."""
    pts = x.select(F.col(id_col).alias("_id"), F.xxhash64(F.col(id_col).cast("string")).alias("h"),
                   vector_to_array(F.col("features")).alias("v")).checkpoint(eager=True)
    n_refit = n_iter * n_init

    def starts(it):  # the k rows with the smallest hash of (row, refit) in this task
        best = None
        for pdf in it:
            for at in range(0, len(pdf), BOOT_ROWS):
                h, v = _rows_of(pdf, at, BOOT_ROWS)
                with np.errstate(over="ignore"):
                    key = h.astype(np.uint64)[:, None] ^ ((np.arange(n_refit, dtype=np.uint64) + np.uint64(seed)) * np.uint64(0xA24BAED4963EE407))[None, :]
                    key = (key ^ (key >> np.uint64(29))) * np.uint64(0x94D049BB133111EB)
                    key ^= key >> np.uint64(32)
                if best is not None and len(best[0]) == k:       # refits that one of these rows enters
                    some = np.flatnonzero((key < best[0][-1]).any(0))
                else:
                    some = np.arange(n_refit)
                if not len(some):
                    continue
                key, vv = key[:, some], np.broadcast_to(v[:, None, :], (len(v), len(some), v.shape[1]))
                if best is not None:
                    key, vv = np.concatenate([best[0][:, some], key]), np.concatenate([best[1][:, some], vv])
                top = np.argsort(key, axis=0, kind="stable")[:k]
                key, vv = np.take_along_axis(key, top, 0), np.take_along_axis(vv, top[:, :, None], 0)
                if len(some) == n_refit:
                    best = (key, vv)
                else:
                    best[0][:, some], best[1][:, some] = key, vv
        if best is not None:
            m = len(best[0])
            yield pd.DataFrame({"refit": np.tile(np.arange(n_refit), m), "key": (best[0].ravel() >> np.uint64(1)).astype(np.int64),
                                "v": list(best[1].reshape(m * n_refit, -1))})

    first = pts.select("h", "v").mapInPandas(starts, "refit int, key long, v array<double>")
    first = first.groupBy("refit").agg(F.slice(F.sort_array(F.collect_list(F.struct("key", "v"))), 1, k).alias("s")).orderBy("refit").collect()
    if not first:
        return pts, np.zeros((0, k, 0)), 0
    d = len(first[0]["s"][0]["v"])
    centers = np.array([[(r["s"][min(j, len(r["s"]) - 1)])["v"] for j in range(k)] for r in first], dtype=float)
    cost, moving, steps = np.full(n_refit, np.inf), np.ones(n_refit, bool), 0
    while moving.any() and steps < max_steps:
        live = np.flatnonzero(moving)
        centers[live], cost[live], moved = _step(pts, centers[live], live, live // n_init, seed)
        moving[live] = moved > tol
        steps += 1
    best = cost.reshape(n_iter, n_init).argmin(axis=1) + np.arange(n_iter) * n_init
    return pts, centers[best], int(moving[best].sum())


@dataclass
class Mixtures:
    """Gaussian mixtures with full covariances, one per refit: ``weights`` refits x k,
    ``means`` refits x k x d, ``covs`` refits x k x d x d."""
    weights: np.ndarray
    means: np.ndarray
    covs: np.ndarray

    def density(self):
        """Function rows -> log of weight times density, rows x refits x k."""
        r, k, d = self.means.shape
        half = np.linalg.inv(np.linalg.cholesky(self.covs))                # L^-1 of covariance L L'
        base = np.log(np.maximum(self.weights, 1e-300)) + np.log(np.diagonal(half, axis1=2, axis2=3)).sum(2) - d / 2 * math.log(2 * math.pi)
        shift = np.einsum("rkij,rkj->rki", half, self.means)
        # One coordinate of L^-1 (row - mean) after the other, for all components: (d + 1) x (k * refits) each.
        turn = np.concatenate([half, -shift[..., None]], axis=3).transpose(2, 3, 1, 0).reshape(d, d + 1, k * r)
        base = base.T.reshape(-1)

        def log_density(v: np.ndarray) -> np.ndarray:
            v1, out = _with_one(v), np.zeros((len(v), k * r))
            for one in turn:
                y = v1 @ one
                y *= y
                out += y
            out *= -0.5
            out += base
            return out.reshape(len(v), k, r).transpose(0, 2, 1)
        return log_density

    def at(self, places: np.ndarray) -> Mixtures:
        return Mixtures(self.weights[places], self.means[places], self.covs[places])

    def put(self, places: np.ndarray, new: Mixtures) -> None:
        self.weights[places], self.means[places], self.covs[places] = new.weights, new.means, new.covs


def _moments(v: np.ndarray) -> np.ndarray:
    """1, the entries and their products (upper triangle) of each row."""
    i, j = np.triu_indices(v.shape[1])
    return np.concatenate([np.ones((len(v), 1)), v, v[:, i] * v[:, j]], axis=1)


def _em_step(mix: Mixtures, refits: np.ndarray, iterations: np.ndarray, seed: int, hard: bool):
    """Task: weighted moments of its own rows per (refit, component), one row each, the
    first component's with the refit's log-likelihood. ``hard``: a row belongs to its
    likeliest component whole."""
    def run(it):
        r, k, d = mix.means.shape
        log_density = mix.density()
        total, likely = np.zeros((k * r, 1 + d + d * (d + 1) // 2)), np.zeros(r)
        for pdf in it:
            for at in range(0, len(pdf), BOOT_ROWS):
                h, v = _rows_of(pdf, at, BOOT_ROWS)
                w, lp = poisson_draws(h, iterations, seed), log_density(v).transpose(0, 2, 1)   # rows x k x refits
                if hard:
                    share = (lp.argmax(1)[:, None, :] == np.arange(k)[:, None]).astype(float)
                else:
                    top = lp.max(1)
                    share = np.exp(lp - top[:, None, :])
                    sums = share.sum(1)
                    share /= sums[:, None, :]
                    likely += (w * (top + np.log(sums))).sum(0)
                share *= w[:, None, :]
                total += share.reshape(len(v), k * r).T @ _moments(v)
        total = total.reshape(k, r, -1).transpose(1, 0, 2).reshape(r * k, -1)
        logs = np.zeros((r, k))
        logs[:, 0] = likely
        yield pd.DataFrame({"refit": np.repeat(refits, k), "cl": np.tile(np.arange(k), r), "sums": list(np.column_stack([total, logs.ravel()]))})
    return run


def _maximised(mix: Mixtures, sums: np.ndarray, reg: float) -> Mixtures:
    """The mixtures of the moments (refits x k x moments); a component that no row
    belongs to keeps its place with weight 0."""
    r, k, d = mix.means.shape
    n = sums[:, :, 0]
    held = n > 10 * EPS64
    div = np.where(held, n, 1.0)
    means = np.where(held[:, :, None], sums[:, :, 1:1 + d] / div[:, :, None], mix.means)
    second = np.zeros((r, k, d, d))
    i, j = np.triu_indices(d)
    second[:, :, i, j] = second[:, :, j, i] = sums[:, :, 1 + d:] / div[:, :, None]
    size, axes = np.linalg.eigh(second - means[:, :, :, None] * means[:, :, None, :])
    covs = (axes * (np.maximum(size, 0.0) + reg)[:, :, None, :]) @ axes.swapaxes(2, 3)   # no variance below 0 by rounding
    return Mixtures(n / np.maximum(n.sum(1, keepdims=True), 1e-300), means, np.where(held[:, :, None, None], covs, mix.covs))


def bootstrap_mixtures(x: DataFrame, id_col: str, k: int, n_iter: int, n_init: int = 5, seed: int = 42,
                       tol: float = 1e-3, max_steps: int = 100, reg: float = 1e-6):
    """All refits of a mixture bootstrap as one chain of jobs over the n rows.

    A refit starts from its k-means (:func:`bootstrap_kmeans`, same weights). A step
    sends all refits that still move to the tasks, each task adds up the weighted
    moments of its rows, and only those (refits x k) are reduced. A refit ends when its
    mean log-likelihood changes by ``tol`` at most. Returns (rows frame, mixtures,
    refits that still moved after ``max_steps``)."""
    pts, centers, _ = bootstrap_kmeans(x, id_col, k, n_iter, n_init, seed)
    if not len(centers) or not centers.shape[2]:
        return pts, None, 0
    d = centers.shape[2]
    mix = Mixtures(np.full((n_iter, k), 1 / k), centers, np.broadcast_to(np.eye(d), (n_iter, k, d, d)).copy())
    before, moving, wide = np.full(n_iter, -np.inf), np.ones(n_iter, bool), 2 + d + d * (d + 1) // 2
    for step in range(max_steps + 1):                # step 0 takes the k-means clusters as they are
        live = np.flatnonzero(moving)
        if not len(live):
            break
        own = mix.at(live)
        rows = pts.select("h", "v").mapInPandas(_em_step(own, live, live, seed, step == 0), "refit int, cl int, sums array<double>")
        at, cl, t = _reduced(rows, live, wide)
        sums = np.zeros((len(live), k, wide))
        sums[at, cl] = t
        mix.put(live, _maximised(own, sums[:, :, :-1], reg))
        if step:
            now = sums[:, 0, -1] / np.maximum(sums[:, :, 0].sum(1), 1e-300)
            moving[live] = np.abs(now - before[live]) > tol
            before[live] = now
    return pts, mix, int(moving.sum())


def _votes(cluster_of, names: np.ndarray):
    """Task: share of the most frequent cluster of each row over all refits;
    ``cluster_of`` (rows -> rows x refits) gives a row's cluster in each, ``names``
    (refits x k) the id that a refit's cluster counts as."""
    def run(it):
        for pdf in it:
            conf = np.zeros(len(pdf))
            for at in range(0, len(pdf), BOOT_ROWS):
                _, v = _rows_of(pdf, at, BOOT_ROWS)
                voted = np.take_along_axis(np.broadcast_to(names, (len(v), *names.shape)), cluster_of(v)[:, :, None], 2)[:, :, 0]
                conf[at:at + len(v)] = np.stack([(voted == c).sum(1) for c in range(names.max() + 1)]).max(0) / len(names)
            yield pd.DataFrame({"_id": pdf["_id"], "confidence": conf})
    return run


def bootstrap_confidence(x: DataFrame, fitted: Fitted, id_col: str, n_iter: int = 500, seed: int = 42,
                         align: bool = True, n_init: int = 5) -> tuple[DataFrame, dict]:
    """Per-row max share of a cluster over ``n_iter`` weighted refits,
    each the best of ``n_init`` starts of its own; 0.5 with one cluster or fewer.

    k-means: :func:`bootstrap_kmeans`; mixtures: :func:`bootstrap_mixtures`.
    ``align`` maps a refit's clusters to the nearest base centres; without it
    the refit's own cluster numbers are counted.
    Returns (id, confidence) and {stability_mean, stability_std, n_iter, n_unconverged}."""
    spark = x.sparkSession
    unconverged = 0
    if n_iter <= 0:
        conf = x.select(id_col, F.lit(None).cast("double").alias("confidence"))
    elif fitted.k <= 1:
        conf = x.select(id_col, F.lit(0.5).alias("confidence"))
    elif fitted.model_type == "dbscan":
        conf = fitted.labels.select(id_col, F.when(F.col("cluster_id") != -1, 1.0).otherwise(0.0).alias("confidence"))
    else:
        ref, own = _centers(fitted), np.arange(fitted.k)
        if fitted.model_type == "kmeans":
            pts, centers, unconverged = bootstrap_kmeans(x, id_col, fitted.k, n_iter, n_init, seed)
            turned = _turned(centers)
            cluster_of = lambda v: _nearest(_with_one(v), turned)[0]
            numbers = [own for _ in centers]
        else:
            pts, mix, unconverged = bootstrap_mixtures(x, id_col, fitted.k, n_iter, n_init, seed)
            centers = mix.means if mix is not None else np.zeros((0, fitted.k, 0))
            log_density = mix.density() if mix is not None else None
            cluster_of = lambda v: log_density(v).argmax(2)
            numbers = [np.argsort(np.lexsort(c.T[::-1])) for c in centers]     # by their means' order, as predict has them
        names = np.array([[_align(ref, c)[j] for j in own] if align else m for c, m in zip(centers, numbers)], dtype=int).reshape(-1, fitted.k)
        id_type = pts.schema["_id"].dataType.simpleString()
        conf = pts.select("_id", "h", "v").mapInPandas(_votes(cluster_of, names), f"_id {id_type}, confidence double") \
            .withColumnRenamed("_id", id_col)
    st = conf.agg(F.avg("confidence").alias("m"), F.stddev_pop("confidence").alias("s")).collect()[0]
    return conf, {"stability_mean": None if st["m"] is None else float(st["m"]), "stability_std": float(st["s"] or 0.0), "n_iter": n_iter,
                  "n_unconverged": unconverged}


def _centers(fitted: Fitted):
    """Centres indexed by canonical cluster id (as returned by ``predict``)."""
    if fitted.model_type == "kmeans":
        return fitted.model.centers
    if fitted.model_type == "gmm":
        raw = np.array([np.asarray(r[0].toArray()) for r in fitted.model.gaussiansDF.select("mean").collect()])
    else:
        return None
    mp = canonical_order(fitted.model)
    out = np.empty_like(raw)
    for old, new in mp.items():
        out[new] = raw[old]
    return out


# ---- M10 / M11 ------------------------------------------------------------------------------

@dataclass
class ScoringResult:
    clusters: DataFrame
    fitted: Fitted | None
    preprocessor: Preprocessor | None
    metrics: dict


def score_creators(features: DataFrame, scored_at: Column, model_type: str = "auto", min_clusters: int = 3,
                   max_clusters: int = 5, seed: int = 42, n_boot: int = 500, n_init: int = 10,
                   cols: Sequence[str] = R.FEATURE_COLUMNS, id_col: str = "channel_id",
                   method: str = "euclidean") -> ScoringResult:
    """M1 -> M6/M7 -> P12 -> W4 -> W3 -> M8 -> M9 -> U1. ``method``: silhouette by
    which models are chosen and reported. ``n_boot=0`` leaves the confidence null."""
    scored, unscored = SC.split_scored(features)
    if scored.limit(1).count() == 0:
        out = SC.union_unscored(scored.limit(0).select(*features.columns), features, "kmeans_v1", scored_at)
        return ScoringResult(out, None, None, {"silhouettes": {}})
    scored = scored.checkpoint(eager=True)
    x, prep = preprocess(scored, cols)
    x = x.checkpoint(eager=True)
    fitted = fit_model(x, id_col, model_type, min_clusters, max_clusters, seed, n_init, method)
    s = fitted.assign(x, id_col)
    s = SC.with_risk_score(s, cols)
    s = SC.label_clusters(s)
    s = SC.assign_tiers(s)
    s = s.checkpoint(eager=True)
    center = healthy_centroid(fitted, s) if fitted.model_type == "kmeans" else None
    dist = distance_to(prep.out_cols, center) if center is not None else F.lit(None).cast("double")
    s = s.withColumn("distance_to_centroid", dist)
    conf, boot = bootstrap_confidence(x, fitted, id_col, n_boot, seed)
    s = s.join(conf, id_col, "left")
    n_lab = _n_labels(s, False)
    final_sil = (silhouette(s, id_col=id_col, method=method)[0] or 0.0) if fitted.k > 1 and n_lab > 1 else 0.0
    mv = f"{fitted.model_type}_v1"
    s = s.select(*features.columns, "risk_score", "cluster_id", "cluster_label", "risk_flag",
                 F.lit(mv).alias("model_version"), scored_at.alias("scored_at"), "distance_to_centroid", "confidence")
    out = SC.union_unscored(s, unscored, mv, scored_at)
    metrics = {"model_type": fitted.model_type, "k": fitted.k, "params": fitted.params,
               "silhouette": final_sil, "selection_silhouette": fitted.silhouettes.get("selection"),
               "bootstrap_mean": boot["stability_mean"], "bootstrap_std": boot["stability_std"],
               "bootstrap_n": boot["n_iter"], "trials": fitted.trials}
    return ScoringResult(out, fitted, prep, metrics)


def model_summary(result: ScoringResult, cols: Sequence[str] = R.FEATURE_COLUMNS) -> DataFrame:
    """The model card's data as one frame: per-cluster profile plus the
    model-level metrics repeated on every row."""
    scored = result.clusters.where(F.col("risk_flag") != "Unscored")
    prof = SC.cluster_profile(scored, cols)
    m = result.metrics
    w = R.normalized_weights(cols)
    return prof.select("*", F.lit(m.get("model_type")).alias("model_type"), F.lit(m.get("k")).alias("k"),
                       F.lit(m.get("silhouette")).cast("double").alias("silhouette"),
                       F.lit(m.get("bootstrap_mean")).cast("double").alias("bootstrap_mean"),
                       F.lit(m.get("bootstrap_std")).cast("double").alias("bootstrap_std"),
                       F.lit(json.dumps(w)).alias("risk_weights"))


# ---- K10 ---------------------------------------------------------------------------------------

def save_model(result: ScoringResult, path: str) -> str:
    """The model as a table (k-means: cluster_id and centre; DBSCAN: labels; a
    mixture: MLlib's own), the preprocessor and the metrics as JSON."""
    spark = result.clusters.sparkSession
    f = result.fitted
    if f is not None and isinstance(f.model, Centers):
        f.model.rows(spark).coalesce(1).write.mode("overwrite").parquet(f"{path}/model")
    elif f is not None and f.model is not None:
        f.model.write().overwrite().save(f"{path}/model")
    elif f is not None and f.labels is not None:
        f.labels.write.mode("overwrite").parquet(f"{path}/labels")
    meta = {"model_type": f.model_type if f else None, "k": f.k if f else None,
            "preprocessor": result.preprocessor.to_json() if result.preprocessor else None,
            "metrics": {k: v for k, v in result.metrics.items() if k != "trials"}}
    spark.createDataFrame([(json.dumps(meta, default=str),)], "value string").coalesce(1) \
        .write.mode("overwrite").text(f"{path}/meta")
    return path


def load_model(spark: SparkSession, path: str) -> tuple[Fitted, Preprocessor | None, dict]:
    meta = json.loads(spark.read.text(f"{path}/meta").first()[0])
    mt = meta["model_type"]
    prep = Preprocessor.from_json(meta["preprocessor"]) if meta.get("preprocessor") else None
    if mt == "kmeans":
        fitted = Fitted(mt, meta["k"], Centers.of(spark.read.parquet(f"{path}/model")))
    elif mt == "gmm":
        fitted = Fitted(mt, meta["k"], GaussianMixtureModel.load(f"{path}/model"))
    else:
        fitted = Fitted(mt, meta["k"], None, spark.read.parquet(f"{path}/labels"))
    return fitted, prep, meta


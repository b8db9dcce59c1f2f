"""Embedding whitening by Jacobi-Davidson on the covariance that is never formed.

1. Rows whose vector is null, or holds a null or non-finite entry, go. Each
   entry c becomes the whole number floor(64 c) + 1,000,000. The fit list has
   every distinct vector once.
2. ``V y`` for a block of vectors y is one pass: a task centres its vectors x
   exactly (n x - S, in whole numbers, over n), adds up (x - m)((x - m) . y) for
   its rows, and Spark sums the tasks' blocks. No matrix of the covariance exists;
   the driver holds blocks of dimension x at most ``BASIS`` numbers, which grow with
   the vectors' length alone.
3. Jacobi-Davidson for the largest eigenpairs: Rayleigh-Ritz on the subspace;
   for each wanted pair that has not converged the correction equation, projected
   against the locked vectors and the pair's own, solved by a few MINRES steps
   (all pairs' steps share a pass); the corrections extend the subspace, which is
   cut back to its best Ritz vectors when it is full. A pair is locked when its
   residual is at double precision, ``|V u - e u| <= TOLERANCE * e_1``, or when the
   subspace holds all of the space, where Rayleigh-Ritz leaves nothing to correct.
4. Every remaining row is projected: ((x - m) . u) / sqrt(e).

Defined results: an id may be null or repeat, rows are judged one by one.
Vectors of another length than most (ties: the longer) go, as do rows with an
entry of 2**40 or more. Directions without variance (eigenvalue at the rounding
level of the largest) have no component, so a list of one vector gives no rows.
An empty table gives no rows. Other columns are not read.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import StorageLevel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import written

SCALE, SHIFT = 64, 1_000_000
COMPONENTS = 16
GUARD = 8            # Ritz pairs beyond the wanted ones that the subspace keeps
BASIS = 96           # columns of the subspace at most
INNER = 6            # MINRES steps of a correction
ROUNDS = 200
TOLERANCE = 2e-14    # of a residual, in parts of the largest eigenvalue
RANK = 1e-12         # eigenvalues below this part of the largest count as zero
SEED = 13


def quantised(rows: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    """(id, x): the remaining rows' whole-number vectors as little-endian bytes."""
    v = F.col("v")
    src = rows.select(F.col(id_col).alias("id"), F.col(vector_col).cast("array<double>").alias("v"))
    fine = v.isNotNull() & F.forall(v, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float(1 << 40)))
    src = src.where(F.coalesce(fine, F.lit(False)))
    most = src.groupBy(F.size("v").alias("n")).count().orderBy(F.desc("count"), F.desc("n")).limit(1).collect()
    size = most[0]["n"] if most else 0
    return written(src.where(F.size("v") == size).mapInArrow(_quantise(size), rows.select(F.col(id_col).alias("id"), F.lit(b"").alias("x")).schema), "whiten-rows")


def _quantise(size: int):
    def run(batches):
        for b in batches:
            v = b.column("v").flatten().to_numpy(zero_copy_only=False).reshape(b.num_rows, size)
            x = (np.floor(v * SCALE) + SHIFT).astype("<i8")
            yield pa.RecordBatch.from_arrays([b.column("id"), pa.array([r.tobytes() for r in x], pa.binary())], names=["id", "x"])

    return run


def _vectors(column, dims: int) -> np.ndarray:
    """Bytes of an Arrow or pandas column as rows of whole numbers."""
    return np.frombuffer(b"".join(column), "<i8").reshape(-1, dims)


def exact_deviation(x: np.ndarray, n: int, total: list[int]) -> np.ndarray:
    """n x - S in whole numbers, of any size."""
    most = max((abs(t) for t in total), default=0)
    top = int(np.abs(x).max(initial=0))
    if n * top < 1 << 62 and most < 1 << 62:
        return n * x - np.array(total, np.int64)
    return n * x.astype(object) - np.array(total, object)


def squares(deviation: np.ndarray) -> list[int]:
    """Sum of squares of each row, exactly."""
    top = int(np.abs(deviation).max(initial=0))
    if deviation.dtype != object and top * top * max(deviation.shape[1], 1) < 1 << 62:
        return (deviation * deviation).sum(axis=1).tolist()
    return [int(s) for s in (deviation.astype(object) ** 2).sum(axis=1)]


@dataclass
class Fit:
    """The fit list and what is known of it."""

    list: DataFrame        # x, each distinct vector once
    dims: int
    n: int
    total: list[int]       # S

    def columns(self, run, width: int) -> np.ndarray:
        """Sum over tasks of blocks (dims x width) that ``run`` makes of centred rows."""
        n, total, dims = self.n, self.total, self.dims

        def task(frames):
            out = None
            for f in frames:
                for at in range(0, len(f), 2048):
                    part = exact_deviation(_vectors(f["x"].iloc[at:at + 2048], dims), n, total)
                    made = run(part.astype(float) / n)
                    out = made if out is None else out + made
            if out is not None:
                yield pd.DataFrame(out, columns=[f"c{j}" for j in range(out.shape[1])]).assign(i=np.arange(len(out)))

        kind = ", ".join(f"c{j} double" for j in range(width)) + ", i long"
        sums = self.list.mapInPandas(task, kind).groupBy("i").agg(*[F.sum(f"c{j}").alias(f"c{j}") for j in range(width)]).toPandas()
        return sums.sort_values("i")[[f"c{j}" for j in range(width)]].to_numpy()

    def product(self, y: np.ndarray) -> np.ndarray:
        """V y, in one pass over the list."""
        return self.columns(lambda c: c.T @ (c @ y), y.shape[1]) / self.n

    def trace(self) -> float:
        return float(self.columns(lambda c: np.array([[(c * c).sum()]]), 1)[0, 0]) / self.n


def fit_list(rows: DataFrame) -> Fit | None:
    """Distinct vectors, their number and sums. None: no vectors."""
    distinct = written(rows.select("x").distinct(), "whiten-fit")
    first = distinct.first()
    if first is None or not len(first["x"]):
        return None
    dims = len(first["x"]) // 8

    def task(frames):
        n, total = 0, [0] * dims
        for f in frames:
            x = _vectors(f["x"], dims)
            n += len(x)
            for at in range(0, len(x), 4096):
                total = [a + b for a, b in zip(total, x[at:at + 4096].sum(axis=0).tolist())]
        if n:
            from decimal import Decimal

            yield pd.DataFrame({"i": range(dims), "n": n, "total": [Decimal(t) for t in total]})

    sums = distinct.mapInPandas(task, "i long, n long, total decimal(38,0)").groupBy("i").agg(F.sum("n").alias("n"), F.sum("total").cast("decimal(38,0)").alias("total")).collect()
    sums = sorted((r["i"], r["n"], int(r["total"])) for r in sums)
    return Fit(distinct, dims, sums[0][1], [s[2] for s in sums])


def _orthonormal(y: np.ndarray, against: np.ndarray) -> np.ndarray:
    """Columns of ``y`` made orthonormal to ``against`` and to each other; what
    nearly vanishes is left out."""
    out = np.zeros((len(y), 0))
    for col in y.T:
        size = np.linalg.norm(col)
        if not np.isfinite(size) or size == 0:
            continue
        v = col / size
        for _ in range(3):
            for q in (against, out):
                v = v - q @ (q.T @ v)
            left = np.linalg.norm(v)
            if left < 1e-8:
                break
            v = v / left
        if left >= 1e-8:
            out = np.column_stack([out, v])
    return out


def _minres(product, shift: np.ndarray, locked: np.ndarray, own: np.ndarray, right: np.ndarray, steps: int, goal: float) -> np.ndarray:
    """Approximate solutions t_i of P_i (V - shift_i) P_i t = right_i, with P_i the
    projection against ``locked`` and own_i; one product a step for all columns."""
    def project(y):
        for _ in range(2):
            y = y - locked @ (locked.T @ y)
            y = y - own * (own * y).sum(axis=0)
        return y

    right = project(right)
    beta = np.linalg.norm(right, axis=0)
    size = beta.copy()
    safe = np.where(beta > 0, beta, 1.0)
    v_old, v = np.zeros_like(right), right / safe
    w_old, w = np.zeros_like(right), np.zeros_like(right)
    t = np.zeros_like(right)
    c_old, s_old, c, s = np.ones_like(beta), np.zeros_like(beta), np.ones_like(beta), np.zeros_like(beta)
    eta, beta = beta.copy(), np.zeros_like(beta)
    for _ in range(steps):
        z = project(product(v) - shift * v)
        alpha = (v * z).sum(axis=0)
        z = z - alpha * v - beta * v_old
        z = project(z)
        beta_new = np.linalg.norm(z, axis=0)
        d0 = c * alpha - c_old * s * beta
        d1 = np.hypot(d0, beta_new)
        d2 = s * alpha + c_old * c * beta
        d3 = s_old * beta
        d1 = np.where(d1 > 0, d1, 1.0)
        c_old, s_old, c, s = c, s, d0 / d1, beta_new / d1
        w_old, w = w, (v - d3 * w_old - d2 * w) / d1
        t = t + c * eta * w
        eta = -s * eta
        if (np.abs(eta) <= goal * size).all():
            break
        v_old, v, beta = v, z / np.where(beta_new > 0, beta_new, 1.0), beta_new
    return project(t)


def largest(product, dims: int, wanted: int, *, inner: int = INNER, basis: int = BASIS, rounds: int = ROUNDS, tolerance: float = TOLERANCE, seed: int = SEED) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(eigenvalues falling, eigenvectors as columns, residuals relative to the
    largest eigenvalue) of a symmetric positive operator by Jacobi-Davidson.

    Raises when pairs are left after ``rounds``."""
    wanted = min(wanted, dims)
    keep = min(dims, wanted + GUARD)
    most = max(basis, 2 * keep)
    q = _orthonormal(np.random.default_rng(seed).standard_normal((dims, keep)), np.zeros((dims, 0)))
    aq = product(q)
    locked, value, a_locked = np.zeros((dims, 0)), np.zeros(0), np.zeros((dims, 0))
    top = 0.0
    for turn in range(rounds):
        h = q.T @ aq
        theta, s = np.linalg.eigh((h + h.T) / 2)
        theta, s = theta[::-1], s[:, ::-1]
        q, aq = q @ s, aq @ s
        top = max([top, *theta[:1], *value[:1]])
        if top <= 0:  # no variance at all
            return np.zeros(0), np.zeros((dims, 0)), np.zeros(0)
        residual = aq - q * theta
        residual -= locked @ (locked.T @ residual)
        left = np.linalg.norm(residual, axis=0) / top
        whole = q.shape[1] + locked.shape[1] >= dims
        lead = wanted - locked.shape[1]
        done = 0  # of the leading pairs, in order: a later one may still be overtaken
        while done < min(lead, q.shape[1]) and (whole or left[done] <= tolerance):
            done += 1
        if done:
            locked, a_locked = np.column_stack([locked, q[:, :done]]), np.column_stack([a_locked, aq[:, :done]])
            value = np.append(value, theta[:done])
            q, aq, theta, residual, left = q[:, done:], aq[:, done:], theta[done:], residual[:, done:], left[done:]
        lead -= done
        if not lead:
            break
        if q.shape[1] + lead > most:
            q, aq = q[:, :keep], aq[:, :keep]
        todo = [i for i in range(min(lead, len(theta))) if left[i] > tolerance] or [0]
        goal = max(0.5 ** (turn + 1), 1e-3)
        t = _minres(product, theta[todo], locked, q[:, todo], -residual[:, todo], inner, goal)
        t = _orthonormal(t, np.column_stack([locked, q]))
        if not t.shape[1]:  # corrections lie in the subspace: go on with a fresh direction
            t = _orthonormal(np.random.default_rng([seed, turn]).standard_normal((dims, 1)), np.column_stack([locked, q]))
        q, aq = np.column_stack([q, t]), np.column_stack([aq, product(t)])
    else:
        raise ArithmeticError(f"{wanted - locked.shape[1]} of {wanted} eigenpairs have not converged in {rounds} rounds")
    # A last Rayleigh-Ritz over the locked vectors with a product of their own.
    x, _ = np.linalg.qr(locked)
    ax = product(x)
    h = x.T @ ax
    theta, s = np.linalg.eigh((h + h.T) / 2)
    theta, x, ax = theta[::-1], x @ s[:, ::-1], ax @ s[:, ::-1]
    return theta, x, np.linalg.norm(ax - x * theta, axis=0) / max(theta[0], 1e-300)


@dataclass
class Whitening:
    """n, S and the components: unit eigenvectors (columns) by falling eigenvalue."""

    dims: int
    n: int
    total: list[int]
    value: np.ndarray
    vector: np.ndarray
    residual: np.ndarray
    trace: float
    identity_error: float

    def of(self, deviation: np.ndarray) -> np.ndarray:
        """Whitened coordinates of exact deviations n x - S."""
        return (deviation.astype(float) / self.n) @ self.vector / np.sqrt(self.value)


def fit(rows: DataFrame, components: int = COMPONENTS) -> Whitening | None:
    """Fit on ``quantised`` rows. None: there is no vector."""
    data = fit_list(rows)
    if data is None:
        return None
    data.list = data.list.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        trace = data.trace()
        value, vector, residual = largest(data.product, data.dims, components) if trace > 0 else (np.zeros(0), np.zeros((data.dims, 0)), np.zeros(0))
        good = value > RANK * max(value, default=0)
        out = Whitening(data.dims, data.n, data.total, value[good], vector[:, good], residual[good], trace, 0.0)
        k = len(out.value)
        if k:
            project = out.vector / np.sqrt(out.value)
            mean = data.columns(lambda c: (c @ project).sum(axis=0)[:, None], 1)[:, 0] / data.n
            covariance = data.columns(lambda c: (c @ project - mean).T @ (c @ project - mean), k) / data.n
            out.identity_error = float(np.abs(covariance - np.eye(k)).max())
        return out
    finally:
        data.list.unpersist()


def _project(model):
    def run(batches):
        from decimal import Decimal

        m = model.value
        k = len(m.value)
        for b in batches:
            for at in range(0, b.num_rows, 2048):
                part = b.slice(at, 2048)
                d = exact_deviation(_vectors(part.column("x").to_pylist(), m.dims), m.n, m.total)
                rows = part.num_rows
                yield pa.RecordBatch.from_arrays([
                    part.column("id").take(pa.array(np.repeat(np.arange(rows), k))),
                    pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), rows)),
                    pa.array([Decimal(s) for s in squares(d) for _ in range(k)], pa.decimal128(38, 0)),
                    pa.array(m.of(d).ravel()),
                    pa.array(np.tile(m.value / m.trace, rows))], names=["id", "component", "deviation", "whitened", "explained"])

    return run


def whiten(rows: DataFrame, *, id_col: str = "vec_id", vector_col: str = "embedding", components: int = COMPONENTS) -> DataFrame:
    """Per remaining row and component: id, component (from 1), n, deviation
    (decimal: it outgrows a long), whitened, explained, identity_error."""
    x = quantised(rows, id_col, vector_col)
    kind = x.select("id", F.lit(1).cast("int").alias("component"), F.lit(0).cast("decimal(38,0)").alias("deviation"), F.lit(0.0).alias("whitened"), F.lit(0.0).alias("explained")).schema
    model = fit(x, components)
    if model is None or not len(model.value):
        out, n, error = rows.sparkSession.createDataFrame([], kind), 0, 0.0
    else:
        out, n, error = x.mapInArrow(_project(rows.sparkSession.sparkContext.broadcast(model)), kind), model.n, model.identity_error
    return out.select(F.col("id").alias(id_col), "component", F.lit(n).cast("long").alias("n"), "deviation", "whitened", "explained", F.lit(error).alias("identity_error"))

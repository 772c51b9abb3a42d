"""Operator 11: embedding whitening by Golub-Kahan-Lanczos bidiagonalisation.

Entries c become x = floor(64 c) + 1,000,000. The fit list is each distinct x
vector once, written as a table: n vectors with exact sums S. Rows of the
centred matrix are (n x - S) / n, subtracted in whole numbers.

Every step of the bidiagonalisation is two passes over that table. The first
gives U'Xv for the newest right vector v; the second takes u = Xv - U(U'Xv) in
the tasks and gives X'u, u'u and, for the second orthogonalisation, U'u. The
driver holds only right vectors and coefficients: with XV = UR, R upper
triangular, a task finds its rows of U as X (V R^-1), so no column as long as
the table is stored and a lost task is simply run again. X'u is made
orthogonal to all right vectors twice on the driver. Steps go on until the
residuals of the wanted triplets are at rounding level or the space is used
up; when an invariant subspace is reached, a new random direction goes on. The
singular value decomposition of the small bidiagonal gives components and
deviations. If steps ended early, the space orthogonal to the components found
is searched once more, until what is largest there is below them, so equal
eigenvalues are not missed.

Partial sums of the tasks are added by tasks once more, one for each ``FAN`` of
them, before they meet on the driver: a few thousand numbers each.

Defined cases: rows whose vector is null, or holds null or non-finite entries,
are dropped; empty vectors have no component. Vectors of each width are a fit
of their own. Components whose eigenvalue is at rounding level against the
largest are not returned (so a single distinct vector returns no rows).
Repeated rows and ids are returned row by row; null ids stay null. Entries
beyond 2^40 in size count as 2^40. A deviation that no long can hold is null.
An empty table gives no rows. Other columns are not read.
"""

from __future__ import annotations

from collections.abc import Callable
from math import ceil

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidepool.llm.shared import pick, written

COMPONENTS, SCALE, OFFSET = 16, 64, 1_000_000
FAN = 64
ROWS = 4096  # rows of the matrix a task works on at a time
_LARGEST = float(1 << 40)


def _matrix(column, width: int) -> np.ndarray:
    return np.asarray(column.flatten(), np.int64).reshape(-1, width)


def _centred(x: np.ndarray, n: int, total: np.ndarray) -> np.ndarray:
    """x - S/n, rounded once. n x - S is exact where longs can hold it."""
    if float(n) * (float(np.abs(x).max(initial=0)) + 1) < 2.0**62:
        return (n * x - total) / n
    return np.array([[(n * int(a) - int(s)) / n for a, s in zip(row, total, strict=True)] for row in x]).reshape(x.shape)


def _deviation(x: np.ndarray, n: int, total: np.ndarray) -> list[int | None]:
    if len(x) and float(n) * (float(np.abs(x).max()) + 1) < 2.0**30 / np.sqrt(x.shape[1]):
        d = n * x - total
        return (d * d).sum(axis=1).tolist()
    exact = [sum((n * int(a) - int(s)) ** 2 for a, s in zip(row, total, strict=True)) for row in x]
    return [v if v < 1 << 63 else None for v in exact]


class _Fit:
    """The fit list of one width and sums over its centred rows."""

    def __init__(self, rows: DataFrame, width: int):
        self.rows, self.width = rows, width
        self.tasks = rows.rdd.getNumPartitions()
        parts = self._summed(lambda x: np.concatenate([[len(x)], x.sum(axis=0)]), width + 1, whole=True)
        self.n, self.total = int(parts[0]), np.array([int(v) for v in parts[1:]], object)
        if all(abs(v) < 1 << 62 for v in self.total):
            self.total = self.total.astype(np.int64)

    def _summed(self, of: Callable[[np.ndarray], np.ndarray], size: int, whole: bool = False) -> np.ndarray:
        """Sum of ``of`` over slices of the rows; ``whole``: of longs, exact."""
        width, kind = self.width, "decimal(38,0)" if whole else "double"
        arrow = pa.decimal128(38, 0) if whole else pa.float64()

        def add(batches):
            acc = np.zeros(size, object if whole else np.float64)
            for batch in batches:
                for lo in range(0, batch.num_rows, ROWS):
                    part = of(_matrix(batch.column("x").slice(lo, ROWS), width))
                    acc = acc + (part.astype(object) if whole else part)
            yield pa.RecordBatch.from_arrays([pa.array([_plain(acc, whole)], pa.list_(arrow))], names=["s"])

        def again(batches):
            acc = np.zeros(size, object if whole else np.float64)
            for batch in batches:
                for v in batch.column("s"):
                    acc = acc + np.array([int(k) if whole else k for k in v.as_py()], acc.dtype)
            yield pa.RecordBatch.from_arrays([pa.array([_plain(acc, whole)], pa.list_(arrow))], names=["s"])

        sums, left = self.rows.select("x").mapInArrow(add, f"s array<{kind}>"), self.tasks
        while left > FAN:
            left = ceil(left / FAN)
            sums = sums.repartition(left).mapInArrow(again, f"s array<{kind}>")
        return sum((np.array([int(k) if whole else k for k in r["s"]], object if whole else np.float64) for r in sums.collect()),
                   np.zeros(size, object if whole else np.float64))

    def over_centred(self, of: Callable[[np.ndarray], np.ndarray], size: int) -> np.ndarray:
        n, total = self.n, self.total
        return self._summed(lambda x: of(_centred(x, n, total)), size)


def _plain(values: np.ndarray, whole: bool) -> list:
    from decimal import Decimal
    return [Decimal(int(v)) for v in values] if whole else values.tolist()


def _against(z: np.ndarray, basis: list[np.ndarray]) -> np.ndarray:
    for _ in range(2):
        for v in basis:
            z = z - v * (v @ z)
    return z


def _bidiagonal(fit: _Fit, found: list[np.ndarray], wanted: int, tolerance: float, rng: np.random.Generator):
    """Right singular vectors (rows) and values of the centred matrix on the
    space orthogonal to ``found``, falling, how many of them have converged, and
    whether the space is used up (all other directions give zero)."""
    d = fit.width
    room = d - len(found)
    vs: list[np.ndarray] = []
    zs: list[np.ndarray] = []  # X'u
    r = np.zeros((room, room))  # X V = U R
    alphas: list[float] = []
    betas: list[float] = []

    def fresh():
        z = _against(rng.standard_normal(d), [*found, *vs])
        return z / np.linalg.norm(z)

    v, scale, new = fresh(), 0.0, True
    while True:
        vs.append(v)
        j = len(vs) - 1
        y = np.array(vs[:j]).T @ np.linalg.inv(r[:j, :j]) if j else np.zeros((d, 0))  # U = X y
        used = [i for i in range(j) if alphas[i] > 0]
        y = y[:, used]
        c = fit.over_centred(lambda x, v=v, y=y: (x @ y).T @ (x @ v), len(used)) if used else np.zeros(0)
        w = v - y @ c  # u before scaling is X w

        def second(x, w=w, y=y):
            u = x @ w
            return np.concatenate([x.T @ u, [u @ u], (x @ y).T @ u])
        got = fit.over_centred(second, d + 1 + len(used))
        z, size, c2 = got[:d], got[d], got[d + 1:]
        for i, k in zip(used, c2, strict=True):
            z = z - zs[i] * k
        alpha = float(np.sqrt(max(size - c2 @ c2, 0.0)))
        scale = max(scale, alpha)
        if alpha <= scale * 1e-13 or alpha == 0:  # X v lies in the span of U: a zero of the matrix
            alpha, z = 0.0, np.zeros(d)
        nothing = new and not alpha  # a random direction orthogonal to all others: the rest is zero
        for i, k in zip(used, c + c2, strict=True):
            r[i, j] = k
        r[j, j] = alpha or 1.0
        alphas.append(alpha)
        zs.append(z / alpha if alpha else z)
        z = _against(zs[-1], [*found, *vs])
        beta = float(np.linalg.norm(z))
        scale = max(scale, beta)
        done = nothing or len(vs) == room
        if done or beta <= scale * 1e-13:
            beta = 0.0
        betas.append(beta)
        p, s, q = np.linalg.svd(np.diag(alphas) + np.diag(betas[:-1], 1))
        ok = int(np.argmin(np.append(np.abs(beta * p[-1]) <= tolerance * max(s[0], 1e-300), False)))
        if done or (beta and ok >= min(wanted, len(s)) and len(s) >= wanted):
            return q @ np.array(vs), s, (len(s) if done else ok), done
        v, new = (z / beta, False) if beta else (fresh(), True)


def fit_components(fit: _Fit, most: int = COMPONENTS, seed: int = 11) -> tuple[np.ndarray, np.ndarray]:
    """Components (rows, unit) and eigenvalues of the covariance, falling."""
    rng = np.random.Generator(np.random.PCG64(seed))
    found: list[np.ndarray] = []
    values: list[float] = []
    while len(found) < fit.width:
        wanted = min(most, fit.width - len(found)) if not found else 1
        q, s, ok, done = _bidiagonal(fit, found, wanted, 1e-15 if not found else 1e-8, rng)
        if found and (len(values) >= most and s[0] <= sorted(values)[-most] * (1 - 1e-9)):
            break
        if found and not done:  # something as large was left: take it as exactly
            q, s, ok, done = _bidiagonal(fit, found, 1, 1e-15, rng)
        found += list(q[:ok])
        values += s[:ok].tolist()
        if done:
            break
    order = np.argsort(-np.array(values), kind="stable")[:most]
    e = np.array(values)[order] ** 2 / max(fit.n, 1)
    keep = e > (e[0] if len(e) else 0) * fit.width * np.finfo(float).eps
    return np.array(found).reshape(-1, fit.width)[order][keep], e[keep]


def whiten(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", most: int = COMPONENTS) -> DataFrame:
    """A row for each usable row and component: vec_id, component, n,
    deviation, whitened, explained, identity_error."""
    base = pick(vectors, {"vec_id": id_col, "v": vector_col}).withColumn("vec_id", F.col("vec_id").cast("long"))
    fine = F.coalesce(F.forall("v", lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf"))), F.lit(False))
    entry = lambda c: F.floor(F.greatest(F.least(c.cast("double") * SCALE, F.lit(_LARGEST)), F.lit(-_LARGEST))).cast("long") + OFFSET
    usable = base.where(fine & (F.size("v") > 0)).select("vec_id", F.transform("v", entry).alias("x"))
    distinct = written(usable.groupBy("x").agg(F.lit(None).cast("int").alias("_")).select("x"), "fit")
    widths = sorted(r[0] for r in distinct.select(F.size("x")).distinct().collect())
    parts = [_whitened(usable, distinct, w, most, len(widths) == 1) for w in widths]
    if not parts:
        return usable.sparkSession.createDataFrame([], _OUT)
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


_OUT = "vec_id long, component int, n long, deviation long, whitened double, explained double, identity_error double"


def _whitened(usable: DataFrame, distinct: DataFrame, width: int, most: int, only: bool) -> DataFrame:
    own = F.size("x") == width
    fit = _Fit(distinct if only else distinct.where(own), width)
    q, e = fit_components(fit, most)
    k, n, total = len(e), fit.n, fit.total
    to = (q / np.sqrt(e)[:, None]).T if k else np.zeros((width, 0))

    def moments(x):
        w = x @ to
        return np.concatenate([[(x * x).sum()], w.sum(axis=0), (w.T @ w).ravel()])

    got = fit.over_centred(moments, 1 + k + k * k)
    mean, second = got[1:1 + k] / n, got[1 + k:].reshape(k, k) / n
    error = float(np.abs(second - np.outer(mean, mean) - np.eye(k)).max(initial=0.0))
    share = e / (got[0] / n) if k else e

    def run(batches):
        for batch in batches:
            for lo in range(0, batch.num_rows if k else 0, ROWS):
                part = batch.slice(lo, ROWS)
                x = _matrix(part.column("x"), width)
                m = len(x)
                deviation = pa.array(_deviation(x, n, total), pa.int64())
                each = pa.array(np.repeat(np.arange(m), k))
                yield pa.RecordBatch.from_arrays(
                    [part.column("vec_id").take(each), pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), m)),
                     pa.array(np.full(m * k, n, np.int64)), deviation.take(each), pa.array((_centred(x, n, total) @ to).ravel()),
                     pa.array(np.tile(share, m)), pa.array(np.full(m * k, error))],
                    names=["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"])

    return (usable if only else usable.where(own)).mapInArrow(run, _OUT)

"""Whitening of embeddings with a bidiagonal qd solver.

1. Exact sums of every dimension give the mean; rows are centred in whole numbers.
2. Each task reduces its centred rows block by block to a triangular factor R by QR;
   factors meet in a tree, ``FAN`` at a time, until one is left.  Its size is that of the
   dimensions, whatever the number of rows, so the rest runs on the driver.
3. Householder reflections make R bidiagonal; dqds finds the squared singular values,
   shifted by a lower bound that keeps all quotients positive; twisted factorisations of
   the shifted product give the vectors; where values lie too near for that, inverse
   iteration against the vectors already found does.
4. Rows are projected on the components and divided by the standard deviations.

Defined results: rows with a null vector or a null or non-finite entry are dropped;
vectors shorter than the longest count as filled up with zeros; rows with a null id are
rows, and so are repeated ones; components without variance (below ``FLAT`` of the
greatest) have no whitened values and no rows, so a table of equal rows, or an empty one,
gives no rows; a deviation that does not fit 64 bits is null; other columns are not read.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import common
from .hard_negatives import matrix

#: Steps of a component's unit, and what is added to them.
STEPS, OFFSET = 64, 1_000_000
COMPONENTS, FAN, ROWS = 32, 32, 2048
#: Share of the greatest variance below which a component has none; relative gap from which twisted vectors are orthogonal enough.
FLAT, GAP = 1e-13, 1e-5
EPS = float(np.finfo(float).eps)
TINY = 1e-280
WHITE = pa.schema([
    ("vec_id", pa.int64()), ("component", pa.int32()), ("n", pa.int64()), ("deviation", pa.int64()),
    ("whitened", pa.float64()), ("explained", pa.float64()), ("identity_error", pa.float64()),
])
WHITE_DDL = "vec_id long, component int, n long, deviation long, whitened double, explained double, identity_error double"
FACTOR = pa.schema([("part", pa.int64()), ("factor", pa.binary())])


# ---- the solver, on matrices of the dimensions' size ------------------------------


def reflector(x: np.ndarray) -> tuple[np.ndarray, float]:
    """v and the first entry of x - 2 v v'x, whose others are zero."""
    size = np.linalg.norm(x)
    if size == 0:
        return np.zeros_like(x), 0.0
    v, first = x.copy(), -math.copysign(size, x[0])
    v[0] -= first
    return v / np.linalg.norm(v), first


def bidiagonal(r: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Diagonal a, superdiagonal b and orthogonal p with r = u B p'."""
    r, d = r.copy(), r.shape[1]
    a, b, p = np.zeros(d), np.zeros(max(d - 1, 0)), np.eye(d)
    for k in range(d):
        v, a[k] = reflector(r[k:, k])
        r[k:, k + 1 :] -= 2 * np.outer(v, v @ r[k:, k + 1 :])
        if k + 1 < d:
            v, b[k] = reflector(r[k, k + 1 :])
            r[k + 1 :, k + 1 :] -= 2 * np.outer(r[k + 1 :, k + 1 :] @ v, v)
            p[:, k + 1 :] -= 2 * np.outer(p[:, k + 1 :] @ v, v)
    return a, b, p


def qd(q: list[float], e: list[float], shift: float) -> tuple[list[float], list[float], list[float]]:
    """One differential qd transform: the new q and e, and the differences d."""
    d = q[0] - shift
    ds, qs, es = [d], [], []
    for k in range(len(e)):
        top = d + e[k]
        t = q[k + 1] / top if top else math.inf
        qs.append(top)
        es.append(e[k] * t)
        d = d * t - shift
        ds.append(d)
    qs.append(d)
    return qs, es, ds


def dqds(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Squares of the singular values of an unreduced bidiagonal matrix, falling."""
    q, e, moved, found = (a * a).tolist(), (b * b).tolist(), 0.0, []
    while q:
        if len(q) == 1 or e[-1] <= EPS * EPS * (moved + q[-1]):
            found.append(moved + q.pop())
            e = e[:-1]
            continue
        if 1.5 * q[0] < q[-1]:  # the smallest values belong at the end
            q.reverse()
            e.reverse()
        # the sum of the reciprocal differences is the trace of the inverse
        plain = qd(q, e, 0.0)
        shift = (1 - 4 * EPS) / sum(1 / max(d, TINY) for d in plain[2])
        made = qd(q, e, shift) if shift > EPS * moved else plain
        while made is not plain and not all(d > 0 for d in made[2]):
            shift /= 2
            made = qd(q, e, shift) if shift > EPS * moved else plain
        if made is not plain:
            moved += shift
        q, e, _ = made
        e = [x if x > TINY else 0.0 for x in e]
    return np.array(sorted(found, reverse=True))


def twisted(a: np.ndarray, b: np.ndarray, value: float) -> np.ndarray:
    """The unit vector of B'B for an eigenvalue, from the twisted factorisation with the least pivot."""
    n = len(a)
    D, L = a * a, np.append(b / a[:-1], 0.0)
    s, p, down, up = np.zeros(n), np.zeros(n), np.zeros(n), np.zeros(n)
    tiny = EPS * EPS * max(D.max(), value)
    away = lambda x: x if abs(x) > tiny else math.copysign(tiny, x)
    s[0] = -value
    for i in range(n - 1):
        down[i] = D[i] * L[i] / away(s[i] + D[i])
        s[i + 1] = down[i] * L[i] * s[i] - value
    p[-1] = D[-1] - value
    for i in range(n - 2, -1, -1):
        t = D[i] / away(D[i] * L[i] * L[i] + p[i + 1])
        up[i] = L[i] * t
        p[i] = p[i + 1] * t - value
    k = int(np.argmin(np.abs(s + p + value)))
    z = np.zeros(n)
    z[k] = 1
    for i in range(k - 1, -1, -1):
        z[i] = -down[i] * z[i + 1]
    for i in range(k, n - 1):
        z[i + 1] = -up[i] * z[i]
    return z / np.linalg.norm(z)


def apart(z: np.ndarray, product: np.ndarray, value: float, others: list[np.ndarray]) -> np.ndarray:
    """A unit vector for ``value`` orthogonal to the vectors of values near it: inverse iteration."""
    basis = np.array(others)
    shifted = product - value * (1 + 4 * EPS) * np.eye(len(z))
    for start in (z, *np.eye(len(z))):
        w = start - basis.T @ (basis @ start)
        if np.linalg.norm(w) < 1e-3:
            continue
        for _ in range(3):
            try:
                w = np.linalg.solve(shifted, w / np.linalg.norm(w))
            except np.linalg.LinAlgError:
                break
            for _ in range(2):
                w -= basis.T @ (basis @ w)
        return w / np.linalg.norm(w)
    raise ArithmeticError("no direction is left")


def spectrum(r: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Squared singular values of a square matrix, falling, and its right singular vectors as rows."""
    d = r.shape[1]
    scale = float(np.abs(r).max(initial=0.0))
    if not scale:
        return np.zeros(d), np.eye(d)
    a, b, p = bidiagonal(r / scale)
    size = max(np.abs(a).max(), np.abs(b).max(initial=0.0))
    # a diagonal entry below rounding stands for zero, which a product of bidiagonals cannot hold
    a = np.where(np.abs(a) < EPS * size, EPS * size, a)
    cuts = [0, *(np.flatnonzero(np.abs(b) <= EPS * EPS * size) + 1).tolist(), d]
    values, vectors = [], []
    for low, high in zip(cuts, cuts[1:]):
        aa, bb = a[low:high], b[low : high - 1]
        mine, near = dqds(aa, bb), []
        product = np.diag(aa * aa) + np.diag(aa[:-1] * bb, 1) + np.diag(aa[:-1] * bb, -1)
        product[np.arange(1, high - low), np.arange(1, high - low)] += bb * bb
        for i, value in enumerate(mine):
            z = twisted(aa, bb, value)
            near = [*near, z] if i and mine[i - 1] - value <= GAP * mine[i - 1] else [z]
            if len(near) > 1:
                near[-1] = z = apart(z, product, value, near[:-1])
            whole = np.zeros(d)
            whole[low:high] = z
            values.append(value)
            vectors.append(p @ whole)
    order = np.argsort(-np.array(values), kind="stable")
    return np.array(values)[order] * scale * scale, np.array(vectors)[order]


# ---- rows --------------------------------------------------------------------------


def usable(vectors: DataFrame) -> DataFrame:
    """(vec_id, x) of the rows that are not dropped, entries in whole steps."""
    embedding = F.col("embedding").cast("array<double>")
    rows = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), embedding.alias("embedding"))
    rows = rows.where(F.forall("embedding", lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf"))))
    return rows.select("vec_id", F.transform("embedding", lambda c: F.floor(STEPS * c).cast("long") + OFFSET).alias("x"))


@dataclass(frozen=True)
class Mean:
    """n rows whose dimensions have the sums ``sums``."""

    n: int
    sums: tuple[int, ...]

    def centred(self, column: pa.ListArray) -> np.ndarray:
        """n times the centred rows, exact."""
        bounds = column.offsets.to_numpy()
        x = matrix(column, len(self.sums))
        x[np.arange(len(self.sums))[None, :] >= np.diff(bounds)[:, None]] = OFFSET
        whole, rest = np.array([divmod(s, self.n) for s in self.sums], np.int64).reshape(-1, 2).T
        return self.n * (x - whole) - rest


def mean_of(rows: DataFrame) -> Mean:
    """Count, and exact sums of the dimensions."""
    schema = pa.schema([("at", pa.int32()), ("there", pa.int64()), ("s", pa.int64())])

    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, there, sums = 0, np.zeros(0, np.int64), np.zeros(0, np.int64)
        for batch in batches:
            x = matrix(batch.column(0))
            if grow := max(0, x.shape[1] - len(sums)):
                there, sums = np.pad(there, (0, grow)), np.pad(sums, (0, grow))
            sizes = np.diff(batch.column(0).offsets.to_numpy())
            there[: x.shape[1]] += (np.arange(x.shape[1])[None, :] < sizes[:, None]).sum(axis=0)
            sums[: x.shape[1]] += x.sum(axis=0)
            n += len(x)
        # the row at -1 counts the rows
        yield from common.emit(schema, [np.arange(-1, len(sums)), np.append(n, there), np.append(0, sums)])

    found = {r["at"]: r for r in rows.select("x").mapInArrow(of, "at int, there long, s long").groupBy("at").agg(F.sum("there").alias("there"), F.sum("s").alias("s")).collect()}
    n = found.pop(-1)["there"] if found else 0
    return Mean(n, tuple(found[i]["s"] + (n - found[i]["there"]) * OFFSET for i in range(len(found))))


def triangular(r: np.ndarray, rows: np.ndarray) -> np.ndarray:
    return np.linalg.qr(np.concatenate([r, rows]), mode="r")


def factor(rows: DataFrame, mean: Mean) -> np.ndarray:
    """R of the centred rows: a factor of each task, then a tree of factors."""
    dims = len(mean.sums)

    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        r = np.zeros((0, dims))
        for batch in common.slices(batches, ROWS):
            r = triangular(r, mean.centred(batch.column(0)) / mean.n)
        if len(r):
            yield from common.emit(FACTOR, [[TaskContext.get().partitionId()], [r.tobytes()]])

    def joined(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, r = None, np.zeros((0, dims))
        for batch in batches:
            for part, held in zip(*(c.to_pylist() for c in batch.columns)):
                if part // FAN != now:
                    if now is not None:
                        yield from common.emit(FACTOR, [[now], [r.tobytes()]])
                    now, r = part // FAN, np.zeros((0, dims))
                r = triangular(r, np.frombuffer(held).reshape(-1, dims))
        if now is not None:
            yield from common.emit(FACTOR, [[now], [r.tobytes()]])

    left = rows.rdd.getNumPartitions()
    factors = common.saved(rows.select("x").mapInArrow(of, "part long, factor binary"), "factors")
    while left > 1:
        left = math.ceil(left / FAN)
        factors = factors.repartition(left, F.expr(f"part div {FAN}")).sortWithinPartitions("part").mapInArrow(joined, "part long, factor binary")
    [held] = factors.collect() or [None]
    r = np.frombuffer(held.factor).reshape(-1, dims) if held else np.zeros((0, dims))
    return np.pad(r, ((0, dims - len(r)), (0, 0)))


@dataclass(frozen=True)
class Whitening:
    """A mean, unit components as rows, their variances and these variances' shares of the whole."""

    mean: Mean
    components: np.ndarray
    variances: np.ndarray
    explained: np.ndarray

    def rows(self, centred: np.ndarray) -> np.ndarray:
        return (centred / self.mean.n) @ self.components.T / np.sqrt(self.variances)


def fitted(rows: DataFrame, components: int = COMPONENTS) -> Whitening:
    """The whitening of rows (vec_id, x)."""
    common.on_workers(rows.sparkSession)
    mean = mean_of(rows)
    dims = len(mean.sums)
    if not mean.n or not dims:
        return Whitening(mean, np.zeros((0, dims)), np.zeros(0), np.zeros(0))
    r = factor(rows, mean)
    values, vectors = spectrum(r)
    k = min(components, int((values > FLAT * values[0]).sum()))
    return Whitening(mean, vectors[:k], values[:k] / mean.n, values[:k] / (r * r).sum() if k else np.zeros(0))


def identity_error(rows: DataFrame, model: Whitening) -> float:
    """Largest absolute entry of the whitened rows' covariance minus the identity."""
    k, n = len(model.variances), model.mean.n
    if not k:
        return 0.0
    schema = pa.schema([("i", pa.int32()), ("j", pa.int32()), ("s", pa.float64())])
    i, j = np.triu_indices(k)

    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums, products = np.zeros(k), np.zeros((k, k))
        for batch in common.slices(batches, ROWS):
            y = model.rows(model.mean.centred(batch.column(0)))
            sums += y.sum(axis=0)
            products += y.T @ y
        yield from common.emit(schema, [np.append(i, np.full(k, -1)), np.append(j, np.arange(k)), np.append(products[i, j], sums)])

    sums, products = np.zeros(k), np.zeros((k, k))
    for r in rows.select("x").mapInArrow(of, "i int, j int, s double").groupBy("i", "j").agg(F.sum("s").alias("s")).collect():
        if r.i < 0:
            sums[r.j] = r.s
        else:
            products[r.i, r.j] = products[r.j, r.i] = r.s
    return float(np.abs(products / n - np.outer(sums / n, sums / n) - np.eye(k)).max())


def deviations(centred: np.ndarray) -> list[int | None]:
    """Sums of squares, exact; None beyond 64 bits."""
    most = max(abs(int(centred.min(initial=0))), abs(int(centred.max(initial=0))))
    if centred.shape[1] * most * most < 1 << 63:
        return (centred * centred).sum(axis=1).tolist()
    exact = [sum(v * v for v in row) for row in centred.tolist()]
    return [x if x < 1 << 63 else None for x in exact]


def op12(vectors: DataFrame) -> DataFrame:
    rows = usable(vectors)
    model = fitted(rows)
    error, k = identity_error(rows, model), len(model.variances)

    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in common.slices(batches, ROWS):
            centred = model.mean.centred(batch.column(1))
            n = len(centred)
            ids = batch.column(0).take(pa.array(np.repeat(np.arange(n), k)))
            told = pa.array(deviations(centred), pa.int64()).take(pa.array(np.repeat(np.arange(n), k)))
            number = np.tile(np.arange(1, k + 1, dtype=np.int32), n)
            yield from common.emit(WHITE, [ids, number, np.full(n * k, model.mean.n), told, model.rows(centred).ravel(), np.tile(model.explained, n), np.full(n * k, error)])

    return rows.mapInArrow(of, WHITE_DDL)

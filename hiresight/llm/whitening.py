"""Operator 12, whitening of embeddings by spectrum slicing.

Entries become integers, floor(scale * c).  The distinct vectors (one
pre-aggregated shuffle, so a vector that fills a third of the table is one row a
task) are the fit list.  Two passes over it give exact per-dimension sums S, then
products of centred vectors, summed per task and pair of dimensions.

The covariance (dimensions squared, whatever the number of rows) is decomposed
on the driver.  By Sylvester's law the signs in a pivoted LDL' factorisation of
V - s I count the eigenvalues below s; bisection with such counts isolates each
leading eigenvalue.  Rayleigh quotient iteration from inside the interval
converges cubically to its eigenvector; counts on both sides of the quotient
certify that it is the eigenvalue of that number, else the interval is cut
further.  Eigenvectors found before are moved out of the spectrum, so equal
eigenvalues get orthogonal vectors.

Defined cases: vectors that are null, empty, hold null or non-finite entries or
entries that leave 62 bits when scaled, or have another length than most, take no
part; zero vectors do.  Every remaining row is returned, also repeated rows
and rows without an id.  There are as many components as dimensions, at most
``components``.  A component without variance (eigenvalue within rounding of 0: all
vectors equal, fewer distinct vectors than dimensions) has ``whitened`` null and
``explained`` 0, or null if nothing varies at all; ``identity_error`` is over the others, null
if there are none.  A ``deviation`` that no long holds is null.  An empty table gives an
empty result.
"""
from __future__ import annotations

from collections.abc import Iterator
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .frames import fresh, ship_package, written

EPS = float(np.finfo(float).eps)
LIMIT = float(1 << 62)
ROWS = 4096
OUT = "component int, n bigint, deviation bigint, whitened double, explained double, identity_error double"


# ------------------------------------------------------ spectrum slicing --
def below(v: np.ndarray, shift: float) -> int:
    """Eigenvalues of the symmetric ``v`` below ``shift``: negative pivots of the LDL'
    factorisation of v - shift I with symmetric (Bunch-Kaufman) pivoting."""
    a, alpha, negative = v - shift * np.eye(len(v)), (1 + 17 ** 0.5) / 8, 0
    while len(a):
        col = np.abs(a[1:, 0])
        lam = col.max() if len(col) else 0.0
        top = abs(a[0, 0])
        if max(top, lam) == 0:
            a = a[1:, 1:]
            continue
        pair = False
        if top < alpha * lam:
            r = 1 + int(col.argmax())
            side = np.abs(a[r]).copy()
            side[r] = 0
            if top * side.max() < alpha * lam * lam:
                pair = abs(a[r, r]) < alpha * side.max()
                to = 1 if pair else 0
                order = np.arange(len(a))
                order[[to, r]] = order[[r, to]]
                a = a[np.ix_(order, order)]
        k = 2 if pair else 1
        p, c = a[:k, :k], a[k:, :k]
        negative += 1 if pair else int(p[0, 0] < 0)          # a pair of such pivots has one of each sign
        a = a[k:, k:] - (c @ np.linalg.inv(p) @ c.T if pair else np.outer(c[:, 0], c[:, 0] / p[0, 0]))
    return negative


def _refined(v: np.ndarray, lo: float, hi: float, found: list[np.ndarray], seed: int) -> tuple[float, np.ndarray, float]:
    """(quotient, vector, residual) of Rayleigh quotient iteration from the middle of an interval."""
    size, q = np.abs(v).max(), np.random.default_rng(seed).normal(size=len(v))
    basis = np.array(found).reshape(-1, len(v))

    def solved(shift: float, b: np.ndarray) -> np.ndarray:
        for nudge in (0.0, EPS, -16 * EPS, 256 * EPS):
            try:
                x = np.linalg.solve(v - (shift + nudge * size) * np.eye(len(v)), b)
            except np.linalg.LinAlgError:
                continue
            if np.isfinite(x).all() and x.any():
                return x
        return b

    def clear(x: np.ndarray) -> np.ndarray:
        for _ in range(2):
            x = x - basis.T @ (basis @ x)
        return x / np.linalg.norm(x)

    q = clear(q)
    for _ in range(3):                                       # into the interval's eigenvector first
        q = clear(solved((lo + hi) / 2, q / np.linalg.norm(q)))
    theta, rest = float(q @ v @ q), np.inf
    for _ in range(30):
        nxt = clear(solved(theta, q))
        value = float(nxt @ v @ nxt)
        gap = float(np.linalg.norm(v @ nxt - value * nxt))
        if gap >= rest and rest < 1e3 * len(v) * EPS * size:
            break
        q, theta, rest = nxt, value, gap
    return theta, q, rest


def leading(cov: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """(eigenvalues, rows of unit eigenvectors) of the k greatest, the largest entry of
    each vector positive.  Raises ArithmeticError if a number can't be certified."""
    d, scale = len(cov), float(np.abs(cov).max(initial=0.0))
    k = min(k, d)
    if not scale:
        return np.zeros(k), np.eye(d)[:k]
    v = (cov + cov.T) / (2 * scale)
    around = np.abs(v).sum(1) - np.abs(np.diag(v))
    bottom, peak = float((np.diag(v) - around).min()) - EPS, float((np.diag(v) + around).max()) + EPS
    least, counts = 4 * d * EPS * max(abs(bottom), abs(peak)), {bottom: d, peak: 0}

    def above(s: float) -> int:
        if s not in counts:
            counts[s] = d - below(v, s)
        return counts[s]

    values, found, moved = [], [], v.copy()
    for j in range(1, k + 1):
        lo = max(s for s, c in counts.items() if c >= j)
        hi = min((s for s, c in counts.items() if c < j and s > lo), default=peak)
        for attempt in range(64):
            while hi - lo > least and not (above(lo) == j and above(hi) == j - 1 and (attempt == 0 or hi - lo <= wide)):
                mid = (lo + hi) / 2
                lo, hi = (mid, hi) if above(mid) >= j else (lo, mid)
            theta, q, rest = _refined(moved, lo, hi, found, 100 * j + attempt)
            off = max(least, 4 * rest)
            if above(theta - off) >= j > above(theta + off):
                break
            wide = (hi - lo) / 16
            if hi - lo <= least:
                raise ArithmeticError(f"eigenvalue {j} couldn't be certified")
        else:
            raise ArithmeticError(f"eigenvalue {j} couldn't be certified")
        q = q * np.sign(q[np.abs(q).argmax()])
        values.append(theta * scale), found.append(q)
        moved = moved - (theta - bottom) * np.outer(q, q)
    return np.array(values), np.array(found)


# ------------------------------------------------------------- the passes --
def scaled(rows: DataFrame, vec_col: str, scale: int, x_col: str) -> DataFrame:
    """``rows`` that take part, with ``x_col``: array<bigint>."""
    v = F.col(vec_col)
    big = F.transform(v, lambda c: c.cast("double") * F.lit(float(scale)))
    fine = F.forall(v, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf")))
    r = rows.where(v.isNotNull() & (F.size(v) > 0) & fine).where(F.forall(big, lambda c: F.abs(c) < LIMIT))
    sizes = r.groupBy(F.size(v).alias("d")).count().orderBy(F.desc("count"), "d").limit(1).collect()
    return r.where(F.size(v) == (sizes[0].d if sizes else 0)).withColumn(x_col, F.transform(big, lambda c: F.floor(c)))


def _blocks(batches: Iterator[pa.RecordBatch], at: int = 0) -> Iterator[tuple[pa.RecordBatch, np.ndarray]]:
    for batch in batches:
        for a in range(0, batch.num_rows, ROWS):
            part = batch.slice(a, ROWS)
            column = part.column(at)
            yield part, column.flatten().to_numpy(zero_copy_only=False).astype(np.int64).reshape(len(column), -1)


def sums(fit: DataFrame) -> tuple[int, list[int]]:
    """Number of vectors and exact sum of each dimension."""
    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, total = 0, None
        for _, x in _blocks(batches):
            part = [(int(h) << 31) + int(l) for h, l in zip((x >> 31).sum(0), (x & 0x7FFFFFFF).sum(0))]
            n, total = n + len(x), part if total is None else [a + b for a, b in zip(total, part)]
        if n:
            yield pa.RecordBatch.from_pydict({"dim": pa.array([-1, *range(len(total))], pa.int32()),
                                              "total": pa.array([Decimal(t) for t in (n, *total)], pa.decimal128(38, 0))})

    got = {r.dim: int(r.total) for r in fit.select("x").mapInArrow(task, "dim int, total decimal(38,0)").groupBy("dim").agg(F.sum("total").alias("total")).collect()}
    n = got.pop(-1, 0)
    return n, [got[i] for i in range(len(got))]


class Centre:
    """S / n as an integer part, taken off exactly, and a rest below 1."""

    def __init__(self, n: int, s: list[int]):
        self.n, self.s = n, s
        self.whole = np.array([t // n for t in s], np.int64)
        self.rest = np.array([(t - n * (t // n)) / n for t in s])

    def __call__(self, x: np.ndarray) -> np.ndarray:
        return (x - self.whole).astype(float) - self.rest

    def deviation(self, x: np.ndarray) -> list[int | None]:
        """Sum over dimensions of (n x - S)^2, exactly."""
        off = x - self.whole
        most = self.n * (int(np.abs(off).max(initial=0)) + 1)
        left = [t - self.n * (t // self.n) for t in self.s]
        if most * most * x.shape[1] < 1 << 62:
            y = off * self.n - np.array(left, np.int64)
            return (y * y).sum(1).tolist()
        out = [sum((self.n * o - l) ** 2 for o, l in zip(row, left)) for row in off.tolist()]
        return [t if t < 1 << 63 else None for t in out]


def products(fit: DataFrame, turned, width: int) -> np.ndarray:
    """Mean over ``fit`` of the outer product of ``turned`` (centred) vectors."""
    i, j = np.triu_indices(width)

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, n = np.zeros((width, width)), 0
        for _, x in _blocks(batches):
            z = turned(x)
            total, n = total + z.T @ z, n + len(x)
        if n:
            yield pa.RecordBatch.from_pydict({"at": pa.array([-1, *range(len(i))], pa.int32()), "total": pa.array([float(n), *total[i, j]])})

    got = {r["at"]: r.total for r in fit.select("x").mapInArrow(task, "at int, total double").groupBy("at").agg(F.sum("total").alias("total")).collect()}
    out = np.zeros((width, width))
    out[i, j] = [got[a] / got[-1] for a in range(len(i))]
    return np.triu(out) + np.triu(out, 1).T


def whiten(rows: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding", scale: int = 256, components: int = 4) -> DataFrame:
    """``id_col``, component, n, deviation, whitened, explained, identity_error."""
    spark = rows.sparkSession
    ship_package(spark)
    x_col = fresh([id_col, vec_col], "x")
    r = scaled(rows.select(id_col, vec_col), vec_col, scale, x_col).select(id_col, F.col(x_col).alias("_x"))
    fit = written(r.select(F.col("_x").alias("x")).distinct(), "whitening-fit")
    n, s = sums(fit)
    name = f"`{id_col}` {rows.schema[id_col].dataType.simpleString()}"
    if not n:
        return spark.createDataFrame([], f"{name}, {OUT}")
    centre = Centre(n, s)
    cov = products(fit, centre, len(s))
    e, q = leading(cov, components)
    trace = float(np.trace(cov))
    good = e > 16 * len(s) * EPS * max(e.max(), 0.0)
    turn = q[good].T / np.sqrt(e[good])
    error = float(np.abs(products(fit, lambda x: centre(x) @ turn, int(good.sum())) - np.eye(int(good.sum()))).max()) if good.any() else None
    explained = [(float(v) / trace if g else 0.0) if trace > 0 else None for v, g in zip(e, good)]

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, x in _blocks(batches, 1):
            y = np.full((len(x), len(e)), np.nan)
            y[:, good] = centre(x) @ turn
            m, k = y.shape
            ids = part.column(0).take(pa.array(np.repeat(np.arange(m), k)))
            yield pa.RecordBatch.from_arrays(
                [ids, pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), m)), pa.array(np.full(m * k, n)),
                 pa.array([v for v in centre.deviation(x) for _ in range(k)], pa.int64()), pa.array(y.ravel(), mask=np.isnan(y.ravel())),
                 pa.array(explained * m, pa.float64()), pa.array([error] * (m * k), pa.float64())],
                names=[id_col, *(c.split()[0] for c in OUT.split(", "))])

    return r.mapInArrow(task, f"{name}, {OUT}")


def whitened(embeddings: DataFrame) -> DataFrame:
    return whiten(embeddings)

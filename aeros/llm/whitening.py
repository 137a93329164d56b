"""Embedding whitening by block Jacobi-Davidson over distributed, matrix-free products with the centred covariance.

The covariance V of integer vectors x is never formed. A product V B is one pass of Spark over the rows: each task adds
C' (C B) for its centred rows C, with c = (n x - S) / n from exact integers, so that a large mean costs no digits; Spark sums the
tasks' parts by place. The driver holds a search space of at most `components + block` vectors of the dimension's length.
Each turn a Rayleigh-Ritz step over the search space gives approximate eigenpairs and residuals. The leading ones whose
residual has reached double precision are locked and deflated. For the next `block` ones the correction equation, projected
off the locked and all wanted vectors, is solved by MINRES for all columns at once, one distributed product a step; the
corrections widen the search space, which is cut back to the wanted vectors when it is full.

Rows whose vector is null or holds null or non-finite components are dropped, and rows with components beyond 2^40 / scale,
whose exact integers would not fit. Shorter vectors count as padded with zeros. Repeated rows and ids, and null ids, are rows
like others. Where the rows have fewer independent directions than components asked for, the components without variance
have a null `whitened`, and `explained` is null where no component has any; `identity_error` regards the others, and is
null if there are none. A deviation beyond a long is null. An empty table gives no rows. Columns besides the key and the
vector play no part.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import stored, tidy
from .topk import usable

EPS = float(np.finfo(float).eps)
#: Components corrected at once, steps of MINRES for a correction at most, turns at most.
BLOCK, STEPS, TURNS = 24, 5, 300


def _orthonormal(x: np.ndarray, against: np.ndarray) -> np.ndarray:
    """An orthonormal basis of what x adds to the orthonormal columns of `against`."""
    size = np.linalg.norm(x, axis=0)
    x = x[:, size > 0] / size[size > 0]
    for _ in range(2):
        x = x - against @ (against.T @ x)
    u, s, _ = np.linalg.svd(x, full_matrices=False)
    u = u[:, s > 1e-8]
    u = u - against @ (against.T @ u)
    return np.linalg.qr(u)[0]


def corrections(product: Callable[[np.ndarray], np.ndarray], theta: np.ndarray, residual: np.ndarray, off: np.ndarray, steps: int, accuracy: float) -> np.ndarray:
    """t of P (V - theta) P t = -residual for each column by MINRES, P being the projection off the columns of `off`."""

    def project(x: np.ndarray) -> np.ndarray:
        for _ in range(2):
            x = x - off @ (off.T @ x)
        return x

    v = project(-residual)
    first = gamma = np.linalg.norm(v, axis=0)
    x, before, w, w_before = (np.zeros_like(v) for _ in range(4))
    eta, c, c_before = gamma.copy(), np.ones_like(gamma), np.ones_like(gamma)
    s, s_before = np.zeros_like(gamma), np.zeros_like(gamma)
    live = gamma > 0
    over = lambda a, b: np.divide(a, b, out=np.zeros(np.broadcast(a, b).shape), where=live & (b > 0))
    for _ in range(steps):
        v = over(v, gamma)
        av = project(product(v) - v * theta)
        delta = (v * av).sum(axis=0)
        nxt = av - delta * v - gamma * before
        gamma_next = np.linalg.norm(nxt, axis=0)
        a0 = c * delta - c_before * s * gamma
        a1, a2, a3 = np.hypot(a0, gamma_next), s * delta + c_before * c * gamma, s_before * gamma
        c_before, c, s_before, s = c, over(a0, a1), s, over(gamma_next, a1)
        w_before, w = w, over(v - a3 * w_before - a2 * w, a1)
        x = x + (c * eta) * w
        eta = -s * eta
        before, v, gamma = v, nxt, gamma_next
        live = live & (np.abs(eta) > accuracy * first) & (gamma > EPS * np.abs(delta))
        if not live.any():
            break
    return x


@dataclass
class Pairs:
    """The leading eigenpairs by falling eigenvalue, their residuals, and what it took."""

    values: np.ndarray
    vectors: np.ndarray
    residuals: np.ndarray
    turns: int
    products: int


def eigenpairs(product: Callable[[np.ndarray], np.ndarray], dims: int, wanted: int, block: int = BLOCK, steps: int = STEPS, seed: int = 12) -> Pairs:
    """The leading pairs of the symmetric positive semidefinite operator `product` of a dims x p block."""
    wanted, made = min(wanted, dims), 0
    block = min(block, wanted)
    most = min(dims, wanted + block)

    def times(x: np.ndarray) -> np.ndarray:
        nonlocal made
        made += 1
        return product(x)

    locked, values = np.zeros((dims, 0)), np.zeros(0)
    none = np.zeros((dims, 0))
    space = _orthonormal(np.random.default_rng(seed).standard_normal((dims, wanted)), none)
    image = times(space)
    for turn in range(1, TURNS + 1):
        # Rayleigh-Ritz over the search space, which is orthogonal to what is locked
        small = space.T @ image
        theta, rotate = np.linalg.eigh((small + small.T) / 2)
        theta, rotate = theta[::-1], rotate[:, ::-1]
        space, image = space @ rotate, image @ rotate
        residual = image - space * theta
        residual = residual - locked @ (locked.T @ residual)
        size = np.linalg.norm(residual, axis=0)
        scale = max(theta[0] if len(theta) else 0.0, values[0] if len(values) else 0.0, 0.0)
        tolerance = 8 * EPS * np.sqrt(dims) * scale
        left = wanted - locked.shape[1]
        ready = int(np.argmin(np.append(size[:left] <= tolerance, False)))
        locked, values = np.concatenate([locked, space[:, :ready]], axis=1), np.append(values, theta[:ready])
        space, image, theta, residual, left = space[:, ready:], image[:, ready:], theta[ready:], residual[:, ready:], left - ready
        if not left:
            break
        if space.shape[1] + min(block, left) > most - locked.shape[1]:  # cut back
            keep = max(left, most - locked.shape[1] - min(block, left))
            space, image, theta, residual = space[:, :keep], image[:, :keep], theta[:keep], residual[:, :keep]
        n = min(block, left)
        aim = np.concatenate([locked, space[:, :left]], axis=1)
        if aim.shape[1] < dims:
            new = corrections(times, theta[:n], residual[:, :n], aim, steps, 1e-4)
        else:
            new = residual[:, :n]
        basis = np.concatenate([locked, space], axis=1)
        fresh = _orthonormal(new, basis)
        if not fresh.shape[1] and basis.shape[1] < dims:  # nothing new: a random direction
            fresh = _orthonormal(np.random.default_rng(seed + turn).standard_normal((dims, 1)), basis)
        if fresh.shape[1]:
            space, image = np.concatenate([space, fresh], axis=1), np.concatenate([image, times(fresh)], axis=1)
        else:  # the search space is all there is
            image = times(space)
    else:
        raise RuntimeError(f"{wanted - locked.shape[1]} of {wanted} components have not converged in {TURNS} turns")
    # a last Rayleigh-Ritz step over the locked vectors
    locked = np.linalg.qr(locked)[0]
    image = times(locked)
    small = locked.T @ image
    theta, rotate = np.linalg.eigh((small + small.T) / 2)
    theta, vectors, image = theta[::-1], locked @ rotate[:, ::-1], image @ rotate[:, ::-1]
    return Pairs(theta, vectors, np.linalg.norm(image - vectors * theta, axis=0), turn, made)


def _matrix(lists: pa.ListArray, dims: int, fill: int) -> np.ndarray:
    lengths = np.diff(lists.offsets.to_numpy())
    flat = lists.flatten().to_numpy()
    if (lengths == dims).all():
        return flat.reshape(-1, dims)
    out = np.full((len(lengths), dims), fill, np.int64)
    out[np.arange(dims)[None, :] < lengths[:, None]] = flat
    return out


@dataclass
class Fit:
    """The integer rows (key, x) and their statistics."""

    rows: DataFrame
    n: int
    dims: int
    shift: int
    sums: np.ndarray

    def parts(self, column: int) -> Callable[[pa.RecordBatch], Iterator[tuple[int, np.ndarray]]]:
        """(first row, n x - S) of parts of a batch."""
        n, dims, shift, sums = self.n, self.dims, self.shift, self.sums

        def cut(batch: pa.RecordBatch) -> Iterator[tuple[int, np.ndarray]]:
            step = max(1, (1 << 19) // max(1, dims))
            for i in range(0, batch.num_rows, step):
                yield i, n * _matrix(batch.column(column).slice(i, step), dims, shift) - sums

        return cut

    def total(self, of: Callable[[np.ndarray], np.ndarray], size: int) -> np.ndarray:
        """The sum over all rows of of(centred rows), `size` numbers."""
        cut, n = self.parts(0), self.n

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            mine = np.zeros(size)
            for b in batches:
                for _, x in cut(b):
                    mine += of(x / n).ravel()
            yield pa.RecordBatch.from_arrays([pa.array([mine], pa.list_(pa.float64()))], names=["part"])

        parts = self.rows.select("x").mapInArrow(tidy(run), "part array<double>")
        out = np.zeros(size)
        for r in parts.select(F.posexplode("part").alias("at", "v")).groupBy("at").agg(F.sum("v").alias("v")).collect():
            out[r["at"]] = r["v"]
        return out

    def product(self, b: np.ndarray) -> np.ndarray:
        return self.total(lambda c: c.T @ (c @ b), b.size).reshape(b.shape) / self.n


def fit(df: DataFrame, key: str = "vec_id", vector: str = "embedding", scale: int = 64, shift: int = 1_000_000) -> Fit:
    """The rows as integers floor(scale * c) + shift of each component c, stored, with their number and exact sums."""
    within = F.coalesce(F.forall(vector, lambda c: F.abs(c.cast("double")) < float(1 << 40) / scale), F.lit(False))
    x = F.transform(vector, lambda c: F.floor(F.lit(float(scale)) * c.cast("double")) + F.lit(shift).cast("long"))
    rows = stored(df.filter(usable(F.lit(1), F.col(vector)) & within).select(F.col(f"`{key}`").alias("key"), x.alias("x")), "integers")
    n, dims = rows.agg(F.count("*"), F.coalesce(F.max(F.size("x")), F.lit(0))).first()
    sums = np.zeros(dims, np.int64)
    if n and dims:

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            mine = np.zeros(dims, np.int64)
            for b in batches:
                for i in range(0, b.num_rows, 4096):
                    mine += _matrix(b.column(0).slice(i, 4096), dims, shift).sum(axis=0)
            yield pa.RecordBatch.from_arrays([pa.array([mine], pa.list_(pa.int64()))], names=["part"])

        for r in rows.select("x").mapInArrow(tidy(run), "part array<long>").select(F.posexplode("part").alias("at", "v")).groupBy("at").agg(F.sum("v").alias("v")).collect():
            sums[r["at"]] = r["v"]
    return Fit(rows, n, dims, shift, sums)


def _squares(x: np.ndarray) -> list[int | None]:
    """The exact sum of squares of each row; None where it exceeds a long."""
    if x.shape[1] * float(np.abs(x).max(initial=0)) ** 2 < 2.0**62:
        return (x * x).sum(axis=1).tolist()
    exact = [sum(int(v) ** 2 for v in row) for row in x]
    return [v if v < 1 << 63 else None for v in exact]


def whitened(df: DataFrame, components: int = 32, key: str = "vec_id", vector: str = "embedding", scale: int = 64, shift: int = 1_000_000, block: int = BLOCK) -> DataFrame:
    """key, component, n, deviation, whitened, explained, identity_error: a row for each row and component."""
    own = fit(df, key, vector, scale, shift)
    kind = df.schema[key].dataType.simpleString()
    schema = f"`{key}` {kind}, component int, n long, deviation long, whitened double, explained double, identity_error double"
    if not own.n or not own.dims:
        return own.rows.sparkSession.createDataFrame([], schema)
    trace = float(own.total(lambda c: (c * c).sum(keepdims=True), 1)[0]) / own.n
    pairs = eigenpairs(own.product, own.dims, components, block)
    e, k = pairs.values, len(pairs.values)
    has = e > own.dims * EPS * max(e[0], 0.0)
    basis = pairs.vectors[:, has] / np.sqrt(e[has])
    m = int(has.sum())
    error = None
    if m:
        sums = own.total(lambda c: np.concatenate([((w := c @ basis).T @ w).ravel(), w.sum(axis=0)]), m * m + m) / own.n
        error = float(np.abs(sums[: m * m].reshape(m, m) - np.outer(sums[m * m :], sums[m * m :]) - np.eye(m)).max())
    explained = [float(v) / trace if trace > 0 else None for v in np.maximum(e, 0.0)]
    cut, n = own.parts(1), own.n

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for i, x in cut(b):
                rows = len(x)
                w = np.full((rows, k), np.nan)
                w[:, has] = (x / n) @ basis
                columns = [
                    b.column(0).slice(i, rows).take(pa.array(np.repeat(np.arange(rows), k))),
                    pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), rows)),
                    pa.array(np.full(rows * k, n)),
                    pa.array(_squares(x), pa.int64()).take(pa.array(np.repeat(np.arange(rows), k))),
                    pa.array(w.ravel(), mask=np.tile(~has, rows)),
                    pa.array(explained * rows, pa.float64()),
                    pa.array([error] * (rows * k), pa.float64()),
                ]
                yield pa.RecordBatch.from_arrays(columns, names=[key, "component", "n", "deviation", "whitened", "explained", "identity_error"])

    return own.rows.select("key", "x").mapInArrow(tidy(run), schema)

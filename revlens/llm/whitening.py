"""Whitening of vectors along their leading principal components, without their covariance matrix.

Chebyshev-filtered subspace iteration: a block of directions goes through a polynomial of the
covariance V that damps the spectrum below the block's smallest Ritz value, then QR and
Rayleigh-Ritz turn it to V's leading eigenvectors. Every product with V is one distributed pass of
centred X^T (X Q), summed in Spark; the driver holds a block of dimension x block size only. It ends when the residuals
V q - e q certify the wanted components, and the block grows if a flat spectrum makes it slow.

Entries become whole numbers floor(256 c). The covariance is that of the distinct whole-number vectors, so copies weigh nothing.

Edge cases: vectors that are null, hold null or non-finite entries, entries beyond a long after scaling, or fewer entries
than the longest one (the missing ones are nulls) give no rows. Components without variance (of fewer distinct vectors
than components, or constant ones) don't exist and give no rows; so does an empty table. A deviation
beyond a long is null. Rows with repeated or null ids are rows of their own; columns not named take no part.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from revlens.session import staged

SCALE = 256.0
SMALL = 1 << 20  # whole numbers below this can be summed and squared as 64-bit ones


@dataclass
class Whitening:
    """What was fitted: `n` distinct vectors, their sums, the components as columns, with eigenvalues."""

    n: int
    sums: list[int]
    vectors: np.ndarray
    values: np.ndarray
    trace: float
    identity_error: float
    residual: float
    passes: int

    @property
    def mean(self) -> np.ndarray:
        return np.array([s / self.n for s in self.sums])

    @property
    def projection(self) -> np.ndarray:
        return self.vectors / np.sqrt(self.values)


def whole_numbers(df: DataFrame, row_id: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """(id, x): the usable vectors as whole numbers."""
    rows = df.select(F.col(f"`{row_id}`").alias("id"), F.col(f"`{vector}`").cast("array<double>").alias("c"))
    usable = F.forall("c", lambda v: F.coalesce(F.abs(v * SCALE) < 2.0 ** 63, F.lit(False)) & ~F.isnan(v))
    rows = rows.where(F.col("c").isNotNull() & usable)
    longest = rows.agg(F.max(F.size("c"))).first()[0]
    rows = rows.where((F.size("c") == F.lit(longest)) & (F.size("c") > 0))
    return rows.select("id", F.transform("c", lambda v: F.floor(v * SCALE)).alias("x"))


def matrix(batch: pa.RecordBatch, d: int, column: str = "x") -> np.ndarray:
    return batch.column(column).flatten().to_numpy(zero_copy_only=False).reshape(-1, d)


def exact(x: np.ndarray, bound: int) -> np.ndarray:
    """`x` as 64-bit numbers where those can't overflow, else as Python's."""
    return x if bound < 1 << 62 else x.astype(object)


def sums_of(fit: DataFrame, d: int) -> tuple[int, list[int]]:
    """Number of vectors and the exact sum of each dimension."""
    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, total = 0, np.zeros(d, object)
        for b in batches:
            x = matrix(b, d)
            n += len(x)
            total = total + exact(x, int(np.abs(x.astype("f8")).max(initial=0)) * (len(x) + 1)).sum(0).astype(object)
        yield pa.RecordBatch.from_arrays([pa.array([n] * d, pa.int64()), pa.array(range(d), pa.int32()),
                                          pa.array([int(t) for t in total], pa.decimal128(38, 0))], ["n", "i", "s"])

    parts = fit.select("x").mapInArrow(partial, "n bigint, i int, s decimal(38,0)")
    rows = parts.groupBy("i").agg(F.sum("n").alias("n"), F.sum("s").cast("decimal(38,0)").alias("s")).orderBy("i").collect()
    return (rows[0]["n"] if rows else 0), [int(r["s"]) for r in rows]


def summed(fit: DataFrame, d: int, mean: np.ndarray, size: int, of_batch) -> np.ndarray:
    """Sum over all vectors of `of_batch(centred rows)`, an array of `size` numbers; each task sends its own sum."""
    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(size)
        for b in batches:
            total += of_batch(matrix(b, d) - mean)
        yield pa.RecordBatch.from_arrays([pa.array([total.tolist()], pa.list_(pa.float64()))], ["part"])

    parts = fit.select("x").mapInArrow(partial, "part array<double>").select(F.posexplode("part").alias("i", "v"))
    out = np.zeros(size)
    for r in parts.groupBy("i").agg(F.sum("v").alias("v")).collect():
        out[r["i"]] = r["v"]
    return out


def fit(rows: DataFrame, components: int = 4, guard: int = 28, degree: int = 10, tolerance: float = 1e-13,
        accept: float = 1e-9, seed: int = 42) -> Whitening | None:
    """The leading components of the distinct vectors of `rows` (id, x); None without vectors.

    Residuals end at `tolerance` times the largest eigenvalue, or where rounding keeps them from falling
    further below `accept`. `guard` directions beyond the wanted ones speed up convergence.
    """
    first = rows.select(F.size("x").alias("d")).first()
    if first is None:
        return None
    d = first["d"]
    distinct = staged(rows.select("x").distinct(), "distinct-vectors")
    n, sums = sums_of(distinct, d)
    mean = np.array([s / n for s in sums])
    passes, trace = 0, 0.0

    def times(q: np.ndarray) -> np.ndarray:
        """V q, by one pass."""
        nonlocal passes, trace
        passes += 1
        found = summed(distinct, d, mean, q.size + 1, lambda x: np.append((x.T @ (x @ q)).ravel(), (x * x).sum())) / n
        trace = float(found[-1])
        return found[:-1].reshape(q.shape)

    rng = np.random.default_rng(seed)
    block = min(d, components + guard)
    q = np.linalg.qr(rng.standard_normal((d, block)))[0]
    residual, rounds = np.inf, 0
    while True:
        vq = times(q)
        values, turn = np.linalg.eigh((q.T @ vq + vq.T @ q) / 2)
        values, turn = values[::-1], turn[:, ::-1]
        q, vq = q @ turn, vq @ turn
        before, k = residual, min(components, block)
        largest = max(values[0], 0.0)
        residual = float(np.linalg.norm(vq - q * values, axis=0)[:k].max()) / (largest or 1.0)
        if block == d or residual <= tolerance or residual <= accept and residual > before / 2:
            break
        rounds += 1
        if rounds % 8 == 0:  # a flat spectrum: more directions, at the end all of them
            more = rng.standard_normal((d, min(d, 2 * block) - block))
            q, block = np.linalg.qr(np.hstack([q, more]))[0], min(d, 2 * block)
            continue
        q = np.linalg.qr(chebyshev(times, q, vq, largest, max(float(values[-1]), 1e-12 * largest), degree))[0]
    real = values[:k] > 1e-12 * largest if largest > 0 else np.zeros(k, bool)
    vectors, values = q[:, :k][:, real], values[:k][real]
    found = Whitening(n, sums, vectors, values, trace, 0.0, residual, passes)
    if len(values):
        w, c = found.projection, len(values)
        spread = summed(distinct, d, mean, c * c, lambda x: ((x @ w).T @ (x @ w)).ravel()).reshape(c, c) / n
        found.identity_error = float(np.abs(spread - np.eye(c)).max())
    return found


def chebyshev(times, q: np.ndarray, vq: np.ndarray, top: float, edge: float, degree: int) -> np.ndarray:
    """The Chebyshev polynomial of V on `q`: bounded on [0, edge], steep above, scaled to stay near one at `top`."""
    half = edge / 2
    scale = half / max(top - half, half)
    first, previous, now = scale, q, (vq - half * q) * (scale / half)
    for _ in range(degree - 1):
        step = 1 / (2 / first - scale)
        previous, now = now, (times(now) - half * now) * (2 * step / half) - scale * step * previous
        scale = step
    return now


OUT = "component int, n bigint, deviation bigint, whitened double, explained double, identity_error double"


def whiten(rows: DataFrame, model: Whitening | None) -> DataFrame:
    """(id, component, n, deviation, whitened, explained, identity_error): every row along every component."""
    schema = f"id {rows.schema['id'].dataType.simpleString()}, {OUT}"
    if model is None or not len(model.values):
        return rows.sparkSession.createDataFrame([], schema)
    n, d, k, mean, projection = model.n, len(model.sums), len(model.values), model.mean, model.projection
    sums, error = np.array(model.sums, object), model.identity_error
    explained = model.values / model.trace
    farthest = int(np.abs(sums).max())

    def project(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            x = matrix(b, d)
            m = len(x)
            reach = n * int(np.abs(x.astype("f8")).max(initial=0)) + farthest + n
            x_, s_ = exact(x, d * reach * reach), sums if d * reach * reach >= 1 << 62 else sums.astype("i8")
            deviation = ((x_ * n - s_) ** 2).sum(1)
            deviation = [int(v) if v < 1 << 63 else None for v in deviation.tolist()]
            whitened = (x - mean) @ projection
            at = np.repeat(np.arange(m), k)
            yield pa.RecordBatch.from_arrays([
                b.column("id").take(pa.array(at)), pa.array(np.tile(np.arange(1, k + 1), m), pa.int32()),
                pa.array(np.full(m * k, n), pa.int64()), pa.array(deviation, pa.int64()).take(pa.array(at)),
                pa.array(whitened.ravel()), pa.array(np.tile(explained, m)), pa.array(np.full(m * k, error))],
                ["id", "component", "n", "deviation", "whitened", "explained", "identity_error"])

    return rows.mapInArrow(project, schema)

"""Embedding whitening: QDWH spectral divide and conquer of the covariance, then broadcast components."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lodestrata.llm.store import Steps

EPS = np.finfo(float).eps
# Rows that are turned into matrices at a time, and the largest whole number of an entry.
ROWS, MOST = 4096, 1 << 61


def polar(a: np.ndarray) -> np.ndarray | None:
    """The orthogonal polar factor of a symmetric matrix, by dynamically weighted Halley steps: with QR while the
    matrix is far from orthogonal, with Cholesky near it. None if the matrix is too close to a singular one."""
    size = np.linalg.norm(a, 2)
    if not size:
        return None
    x, one = a / size, np.eye(len(a))
    try:
        least = 0.9 / np.linalg.norm(np.linalg.inv(x), 2)
    except np.linalg.LinAlgError:
        return None
    if not least > len(a) * EPS * 1e3:
        return None
    for _ in range(30):
        square = least * least
        d = np.cbrt(4 * (1 - square) / (square * square))
        root = np.sqrt(1 + d)
        wa = root + 0.5 * np.sqrt(max(0.0, 8 - 4 * d + 8 * (2 - square) / (square * root)))
        wb = (wa - 1) ** 2 / 4
        wc = wa + wb - 1
        if wc > 100:
            q, _ = np.linalg.qr(np.vstack([np.sqrt(wc) * x, one]))
            new = wb / wc * x + (wa - wb / wc) / np.sqrt(wc) * q[:len(a)] @ q[len(a):].T
        else:
            low = np.linalg.cholesky(one + wc * x.T @ x)
            half = np.linalg.solve(low, x.T)
            new = wb / wc * x + (wa - wb / wc) * np.linalg.solve(low.T, half).T
        new = (new + new.T) / 2
        moved, x = np.linalg.norm(new - x), new
        least = min(1.0, least * (wa + wb * square) / (1 + wc * square))
        if moved < 1e-13 * len(a) and 1 - least < 1e-10:
            break
    return x


def halves(a: np.ndarray, size: float) -> tuple[np.ndarray, np.ndarray] | None:
    """Orthonormal bases of the invariant subspaces above and below a shift; None where all eigenvalues are equal
    to rounding (or, for no shift tried, can be told apart)."""
    n = len(a)
    mean = np.trace(a) / n
    if np.linalg.norm(a - mean * np.eye(n)) <= 4 * n * EPS * size:
        return None
    middle, spread = float(np.median(np.diag(a))), np.linalg.norm(a - mean * np.eye(n)) / np.sqrt(n)
    draw, best = np.random.default_rng(n), None
    for shift in (middle, mean, *(mean + spread * t for t in (0.25, -0.25, 0.1, -0.1, 0.5, -0.5, 0.03, -0.03, 0.8, -0.8))):
        u = polar(a - shift * np.eye(n))
        if u is None:
            continue
        above = round((np.trace(u) + n) / 2)
        if not 0 < above < n:
            continue
        projector = (u + np.eye(n)) / 2
        v = np.linalg.qr(projector @ draw.standard_normal((n, above)))[0]
        v = np.linalg.qr(projector @ v, mode="complete")[0]
        high, low = v[:, :above], v[:, above:]
        apart = np.linalg.norm(low.T @ a @ high)
        if best is None or apart < best[0]:
            best = (apart, high, low)
        if apart <= 8 * n * EPS * size:
            break
    return best and best[1:]


def divide(a: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Eigenvalues, falling, and unit eigenvectors as columns, of a symmetric matrix."""
    size = max(np.linalg.norm(a), np.finfo(float).tiny)
    vectors, open_ = [], [np.eye(len(a))]
    while open_:
        basis = open_.pop()
        inner = basis.T @ a @ basis
        parts = halves((inner + inner.T) / 2, size) if basis.shape[1] > 1 else None
        if parts is None:
            vectors.append(basis)
        else:
            open_ += [basis @ part for part in parts]
    q = np.linalg.qr(np.hstack(vectors))[0] if vectors else np.zeros((0, 0))
    for _ in range(2):  # what rounding left beside the diagonal turns the vectors by so much
        inner = q.T @ a @ q
        e = np.diag(inner)
        gap = e[None, :] - e[:, None]
        turn = np.where(np.abs(gap) > 1e-6 * size, inner / np.where(gap == 0, 1, gap), 0.0) * (1 - np.eye(len(e)))
        q = np.linalg.qr(q @ (np.eye(len(e)) + turn))[0] if len(e) else q
    e = np.einsum("ij,ij->j", q, a @ q)
    order = np.argsort(-e, kind="stable")
    return e[order], q[:, order]


def whole_numbers(vector: Column) -> Column:
    """x of an embedding: floor(64 * c) + 1000000 of each entry, of at most 61 bits."""
    return F.transform(vector, lambda c: F.greatest(F.lit(-MOST), F.least(F.lit(MOST), F.floor(c.cast("double") * 64))) + F.lit(1000000).cast("bigint"))


def usable(vector: Column) -> Column:
    """Neither null nor with an entry that is null or not finite."""
    return F.coalesce(F.forall(vector, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c.cast("double")) < float("inf"))), F.lit(False))


def matrix(column: pa.Array) -> np.ndarray:
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1)


def pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for at in range(0, batch.num_rows, ROWS):
            yield batch.slice(at, ROWS)


@dataclass
class Whitener:
    """What every task needs: n, S, the leading components as columns, their eigenvalues, and V's trace."""

    n: int
    sums: list[int]
    values: np.ndarray
    vectors: np.ndarray
    trace: float
    identity_error: float | None = None

    def __post_init__(self):
        self.flat = self.values <= len(self.sums) * EPS * max(self.trace, 0.0)  # no variance beyond rounding
        self.whole = np.array([s // self.n for s in self.sums], np.int64)
        self.part = np.array([s % self.n for s in self.sums], np.int64)

    def centred(self, x: np.ndarray) -> np.ndarray:
        """x - S/n: whole numbers are subtracted as such, then the fraction."""
        return (x - self.whole).astype(float) - self.part / self.n

    def whiten(self, x: np.ndarray) -> np.ndarray:
        return self.centred(x) @ self.vectors / np.sqrt(np.where(self.flat, 1.0, self.values))

    def deviation(self, x: np.ndarray) -> list[int | None]:
        """Exactly sum((n*x - S)^2); None beyond 64 bits."""
        gap = (x - self.whole).astype(float)
        if gap.size == 0 or (np.abs(gap).max() + 1) * self.n < 2 ** 31 / np.sqrt(max(1, x.shape[1])):
            out = self.n * (x - self.whole) - self.part
            return (out * out).sum(axis=1).tolist()
        found = [sum((self.n * v - s) ** 2 for v, s in zip(row, self.sums)) for row in x.tolist()]
        return [v if v < 1 << 63 else None for v in found]


def sums_of(fit: DataFrame, dimensions: int) -> tuple[int, list[int]]:
    """n and S, exact: whole numbers are added by Spark."""
    got = fit.select(F.posexplode("x").alias("at", "v")).groupBy("at").agg(
        F.sum(F.col("v").cast("decimal(38,0)")).alias("s"), F.count(F.lit(1)).alias("n")).collect()  # a row for each dimension
    sums = {r["at"]: int(r["s"]) for r in got}
    return (got[0]["n"] if got else 0), [sums[i] for i in range(dimensions)]


def covariance(fit: DataFrame, turned, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Sum of the products, and sums, of ``turned`` matrices of the fit list. A task adds up its own rows; of the
    tasks' sums, a row for each dimension, Spark adds those of equal place."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, products = np.zeros(size), np.zeros((size, size))
        for batch in pieces(batches):
            y = turned(matrix(batch.column(0)))
            total += y.sum(axis=0)
            products += y.T @ y
        if products.any():
            yield pa.RecordBatch.from_arrays([pa.array(range(size), pa.int32()), pa.array(total), pa.array(list(products), pa.list_(pa.float64()))], names=["i", "total", "row"])
    parts = fit.select("x").mapInArrow(run, "i int, total double, row array<double>")
    got = (parts.select("i", "total", F.posexplode("row").alias("j", "v")).groupBy("i", "j").agg(F.sum("v").alias("v"), F.sum("total").alias("total"))
           .groupBy("i").agg(F.first("total").alias("total"), F.sort_array(F.collect_list(F.struct("j", "v"))).alias("row")).collect())
    out, total = np.zeros((size, size)), np.zeros(size)
    for r in got:
        out[r["i"]], total[r["i"]] = [v for _, v in r["row"]], r["total"]
    return (out + out.T) / 2, total


def learn(fit: DataFrame, dimensions: int, components: int) -> Whitener | None:
    """The whitener of a fit list (x, each vector once); None of an empty one. Only matrices of the vectors' length
    come to the driver."""
    n, sums = sums_of(fit, dimensions) if dimensions else (0, [])
    if not n:
        return None
    raw = Whitener(n, sums, np.zeros(0), np.zeros((dimensions, 0)), 0.0)
    v = covariance(fit, raw.centred, dimensions)[0] / n
    values, vectors = divide(v)
    kept = min(components, dimensions)
    out = Whitener(n, sums, values[:kept], vectors[:, :kept], float(np.trace(v)))
    real = ~out.flat
    if real.any():
        products, total = covariance(fit, lambda x: out.whiten(x)[:, real], int(real.sum()))
        out.identity_error = float(np.abs(products / n - np.outer(total, total) / n / n - np.eye(int(real.sum()))).max())
    return out


def whitened(embeddings: DataFrame, name: str = "vec_id", vector: str = "embedding", components: int = 16) -> DataFrame:
    """name (as ``vec``), component, n, deviation, whitened, explained and identity_error: a row for each usable row and component.

    Rows whose vector is null, empty, or holds a null or an entry that is not finite are left out, and so are
    vectors of another length than the most frequent one (the longer of two). The covariance is that of the
    distinct vectors, so copies weigh nothing; rows that repeat come out as often. Components of no variance
    have null values, and so has ``deviation`` beyond 64 bits; entries whose whole number is beyond 61 bits are cut to that range. An
    empty table gives no row.
    """
    steps = Steps(embeddings.sparkSession)
    rows = embeddings.where(usable(F.col(vector)) & (F.size(vector) > 0)).select(F.col(name).alias("vec"), whole_numbers(F.col(vector)).alias("x"))
    lengths = rows.groupBy(F.size("x").alias("size")).agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), F.desc("size")).head()
    dimensions = lengths["size"] if lengths else 0
    rows = rows.where(F.size("x") == dimensions)
    fit = steps.saved(rows.select("x").distinct(), "vectors")
    model = learn(fit, dimensions, components)
    steps.remove()
    kind = embeddings.schema[name].dataType
    shape = f"{kind.simpleString()}, component int, n bigint, deviation bigint, whitened double, explained double, identity_error double"
    if model is None:
        return embeddings.sparkSession.createDataFrame([], f"vec {shape}")
    kept = len(model.values)
    explained = [None if f else float(v / model.trace) for v, f in zip(model.values, model.flat)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches):
            x = matrix(batch.column(1))
            many = len(x) * kept
            values = pa.array(model.whiten(x).ravel(), mask=np.tile(model.flat, len(x)))
            yield pa.RecordBatch.from_arrays([
                batch.column(0).take(pa.array(np.repeat(np.arange(len(x)), kept))), pa.array(np.tile(np.arange(1, kept + 1, dtype=np.int32), len(x))),
                pa.array(np.full(many, model.n)), pa.array(model.deviation(x), pa.int64()).take(pa.array(np.repeat(np.arange(len(x)), kept))), values,
                pa.array(explained * len(x), pa.float64()), pa.array([model.identity_error] * many, pa.float64())],
                names=["vec", "component", "n", "deviation", "whitened", "explained", "identity_error"])
    return rows.mapInArrow(run, f"vec {shape}")

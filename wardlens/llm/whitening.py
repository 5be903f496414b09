"""Embedding whitening by principal components from a block Jacobi-Davidson iteration.

The covariance matrix is never formed. Spark multiplies it with a block of a few vectors: every task
holds some of the centred rows, multiplies them twice, and the products are summed by cell before and
after a shuffle, so that dims x vectors numbers reach the driver however many rows there are.

The driver keeps a search space and its products. Each round solves the small Rayleigh-Ritz problem,
locks the leading Ritz vectors whose residual is at double precision, and widens the space by
approximate solutions of the correction equations

    (I - QQ')(V - theta I)(I - QQ') t = -r,      Q: locked and current Ritz vectors,

found by a few MINRES steps; the steps of all vectors run side by side, so that one pass over the data
serves the whole block. A full space is restarted from its best Ritz vectors. The iteration ends when
every wanted vector is locked.

An entry c counts as the integer floor(scale * c) + shift. Sums, and the deviations of the rows from
the mean, are exact integers; rows are centred before they are multiplied.

Rows whose vector is null, empty, or holds a null or non-finite entry are left out, as are vectors of
another length than the most frequent one (the longer of equally frequent ones). Null ids and repeated
rows count like others. Directions without variance have no coordinate: with fewer than `components`
directions that vary, fewer are returned, and a table with a single distinct vector gives no rows.
An entry, or a deviation, beyond 64-bit integers fails the job. Only the two columns are read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wardlens.llm.staging import ship_package, staged

#: Rows that one Arrow batch of the staged table turns into; bounds a task's memory.
BLOCK = 4096
INNER = 6
MAX_ROUNDS = 200
EPS = float(np.finfo(np.float64).eps)


def integer_rows(
    vectors: DataFrame, scale: int = 64, shift: int = 1_000_000, id_col: str = "vec_id", vector_col: str = "embedding"
) -> tuple[DataFrame, int]:
    """vec_id and x (array of longs) of the rows that take part, staged, and their length."""
    entries = F.col(vector_col).cast("array<double>")
    sound = F.coalesce(
        F.forall(entries, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) != F.lit(float("inf")))), F.lit(False)
    )
    x = F.transform(entries, lambda c: F.floor(c * float(scale)) + F.lit(shift).cast("long"))
    rows = vectors.filter(sound).select(F.col(id_col).alias("vec_id"), x.alias("x")).filter(F.size("x") > 0)
    rows = staged(rows, "whitening-rows")
    # One row per length, summed before the shuffle; only the winner reaches the driver.
    lengths = rows.groupBy(F.size("x").alias("dims")).count().orderBy(F.desc("count"), F.desc("dims")).first()
    dims = lengths.dims if lengths else 0
    return rows.filter(F.size("x") == dims), dims


def _matrix(column: pa.Array, dims: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, dims)


class CentredRows:
    """The rows of integers, their exact mean, and products with their covariance matrix."""

    def __init__(self, rows: DataFrame, dims: int):
        self.rows, self.dims = rows, dims
        self.spark = rows.sparkSession
        sums = rows.select(F.posexplode("x").alias("dim", "x")).groupBy("dim").agg(
            F.sum("x").alias("s"), F.count(F.lit(1)).alias("n")
        )
        found = sorted(tuple(r) for r in sums.collect())  # one row per dimension
        self.sums = np.array([s for _, s, _ in found], np.int64)
        self.n = found[0][2] if found else 0

    def summed(self, function, shape: tuple[int, ...]) -> np.ndarray:
        """Sum over all rows of an array that `function` makes of each block of centred rows."""
        n, sums, dims = self.n, self.sums, self.dims

        def cells(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            total = np.zeros(shape)
            for batch in batches:
                x = _matrix(batch.column(0), dims)
                for i in range(0, len(x), BLOCK):
                    total += function((n * x[i : i + BLOCK] - sums) / n)
            flat = total.ravel()
            yield pa.record_batch([pa.array(np.arange(len(flat), dtype=np.int32)), pa.array(flat)], names=["cell", "value"])

        ship_package(self.spark)
        parts = self.rows.select("x").mapInArrow(cells, "cell int, value double")
        got = parts.groupBy("cell").agg(F.sum("value").alias("value")).toArrow()
        out = np.zeros(int(np.prod(shape)))
        out[got["cell"].to_numpy()] = got["value"].to_numpy()
        return out.reshape(shape)

    def times(self, block: np.ndarray) -> np.ndarray:
        """The covariance matrix times a block of vectors, in one pass over the rows."""
        return self.summed(lambda d: d.T @ (d @ block), block.shape) / self.n

    def trace(self) -> float:
        """Exact up to one rounding: the deviations are summed as integers."""
        total = deviations(self.rows, self.sums, self.n).agg(F.sum(F.col("deviation").cast("decimal(38,0)"))).first()[0]
        return float(total) / self.n**3 if total else 0.0


def deviations(rows: DataFrame, sums: np.ndarray, n: int) -> DataFrame:
    """Adds deviation: the sum over the dimensions of (n x - S)^2, in checked long arithmetic."""
    far = F.zip_with("x", F.array(*(F.lit(int(s)) for s in sums)), lambda x, s: x * F.lit(n).cast("long") - s)
    return rows.withColumn("deviation", F.aggregate(far, F.lit(0).cast("long"), lambda total, d: total + d * d))


def orthonormal(block: np.ndarray, against: np.ndarray) -> np.ndarray:
    """An orthonormal base of what the block adds to the columns of `against`."""
    kept = against
    for column in block.T:
        size = np.linalg.norm(column)
        if not size > 0:
            continue
        column = column / size
        for _ in range(3):  # repeated Gram-Schmidt keeps the base orthogonal to rounding
            column = column - kept @ (kept.T @ column)
            rest = np.linalg.norm(column)
            if rest < 1e-10:
                break
            column = column / rest
        else:
            kept = np.column_stack([kept, column])
    return kept[:, against.shape[1] :]


def corrections(times, theta: np.ndarray, residuals: np.ndarray, fixed: np.ndarray, steps: int) -> np.ndarray:
    """Approximate solutions of the correction equations, all advanced by MINRES side by side.

    times(block) multiplies by the matrix; `fixed` holds the vectors that are projected out. A column
    stops changing when its Krylov space is exhausted.
    """

    def project(block):
        block = block - fixed @ (fixed.T @ block)
        return block - fixed @ (fixed.T @ block)

    def unit(block):
        size = np.linalg.norm(block, axis=0)
        return np.divide(block, size, out=np.zeros_like(block), where=size > floor), np.where(size > floor, size, 0.0)

    b = project(-residuals)
    floor = 0.0
    first = np.linalg.norm(b, axis=0)
    floor = EPS * max(first.max(initial=0.0), np.finfo(float).tiny)
    v, beta = unit(b)
    before, d_now, d_before, out = (np.zeros_like(b) for _ in range(4))
    c_now, s_now, c_before, s_before = np.ones(b.shape[1]), np.zeros(b.shape[1]), np.ones(b.shape[1]), np.zeros(b.shape[1])
    rhs = beta.copy()
    for _ in range(steps):
        live = rhs != 0
        if not live.any():
            break
        w = project(times(v) - v * theta) - before * beta
        alpha = (v * w).sum(axis=0)
        w = project(w - v * alpha)
        nxt, beta_next = unit(w)
        # The new column of the tridiagonal matrix, turned by the last two rotations.
        far = s_before * beta
        mid = c_before * beta
        near = c_now * mid + s_now * alpha
        diagonal = -s_now * mid + c_now * alpha
        radius = np.hypot(diagonal, beta_next)
        live &= radius > 0
        safe = np.where(live, radius, 1.0)
        c_new, s_new = np.where(live, diagonal / safe, 1.0), np.where(live, beta_next / safe, 0.0)
        d_new = np.where(live, (v - d_now * near - d_before * far) / safe, 0.0)
        out = out + d_new * np.where(live, c_new * rhs, 0.0)
        rhs = np.where(live, -s_new * rhs, 0.0)
        before, v, beta = v, nxt, beta_next
        d_before, d_now = d_now, d_new
        c_before, s_before, c_now, s_now = c_now, s_now, c_new, s_new
    return out


def jacobi_davidson(times, dims: int, wanted: int, seed: int = 42) -> tuple[np.ndarray, np.ndarray]:
    """The `wanted` largest eigenvalues, falling, and their unit eigenvectors as columns.

    Converged means a residual of at most dims x 2^-52 x the largest eigenvalue.
    """
    wanted = min(wanted, dims)
    start = np.random.default_rng(seed).standard_normal((dims, wanted))
    locked, values = np.zeros((dims, 0)), np.zeros(0)
    space = orthonormal(start, locked)
    products = times(space)
    largest, best, stalled = 0.0, np.inf, 0
    for _ in range(MAX_ROUNDS):
        small = space.T @ products
        ritz, turn = np.linalg.eigh((small + small.T) / 2)
        ritz, turn = ritz[::-1], turn[:, ::-1]
        space, products = space @ turn, products @ turn
        largest = max(largest, ritz[0], values.max(initial=0.0))
        missing = wanted - len(values)
        residuals = products[:, :missing] - space[:, :missing] * ritz[:missing]
        errors = np.linalg.norm(residuals, axis=0)
        done = errors <= dims * EPS * largest
        # In falling order only: a larger eigenvalue may still enter the space below an unfinished one.
        ready = int(np.argmin(np.append(done, False)))
        if ready:
            locked = np.column_stack([locked, space[:, :ready]])
            values = np.append(values, ritz[:ready])
            space, products = space[:, ready:], products[:, ready:]
            ritz, residuals = ritz[ready:], residuals[:, ready:]
            missing -= ready
        if not missing:
            order = np.argsort(-values, kind="stable")
            return np.maximum(values[order], 0.0), locked[:, order]
        best, stalled = (errors.max(), 0) if ready or errors.max() < best / 2 else (best, stalled + 1)
        if stalled > 20:
            break
        if space.shape[1] + missing > max(4 * wanted, missing + 1):
            space, products, ritz = space[:, : 2 * missing], products[:, : 2 * missing], ritz[: 2 * missing]
        fixed = np.column_stack([locked, space[:, :missing]])
        wider = corrections(times, ritz[:missing], residuals[:, :missing], fixed, INNER)
        known = np.column_stack([locked, space])
        added = orthonormal(wider, known)
        if not added.shape[1] and known.shape[1] < dims:
            added = orthonormal(np.random.default_rng(seed + 1).standard_normal((dims, missing)), known)
        # Fresh products of the vectors in hand keep their rounding errors from adding up.
        space = np.column_stack([space, added])
        products = times(space)
        products = products - locked @ (locked.T @ products)
    raise ArithmeticError(f"residual {errors.max():.3g} of the largest eigenvalue {largest:.6g} does not fall any more")


def whiten(
    vectors: DataFrame, components: int = 32, scale: int = 64, shift: int = 1_000_000,
    id_col: str = "vec_id", vector_col: str = "embedding",
) -> DataFrame:
    """A row per vector and component: vec_id, component, n, deviation, whitened, explained, identity_error.

    whitened is the coordinate on the component over its standard deviation, explained the component's
    share of the variance, identity_error the largest entry by which the covariance of all whitened
    coordinates departs from the identity.
    """
    rows, dims = integer_rows(vectors, scale, shift, id_col, vector_col)
    data = CentredRows(rows, dims)
    spread = data.trace() if data.n else 0.0
    values, axes = np.zeros(0), np.zeros((dims, 0))
    if spread:
        values, axes = jacobi_davidson(data.times, dims, components)
        varies = values > dims * EPS * values[0] * 4
        values, axes = values[varies], axes[:, varies]
    n, sums, k = data.n, data.sums, len(values)
    axes = axes / np.sqrt(values)

    error = 0.0
    if k:
        mean = data.summed(lambda d: (d @ axes).sum(axis=0), (k,)) / n

        def square(d):
            w = d @ axes - mean
            return w.T @ w

        error = float(np.abs(data.summed(square, (k, k)) / n - np.eye(k)).max())

    def coordinates(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = _matrix(batch.column(2), dims)
            for i in range(0, len(x), BLOCK):
                w = ((n * x[i : i + BLOCK] - sums) / n) @ axes
                lists = pa.ListArray.from_arrays(np.arange(len(w) + 1, dtype=np.int32) * k, pa.array(w.ravel()))
                part = batch.slice(i, len(w))
                yield pa.record_batch([part.column(0), part.column(1), lists], names=["vec_id", "deviation", "w"])

    kind = rows.schema["vec_id"].dataType.simpleString()
    done = deviations(rows, sums, n).select("vec_id", "deviation", "x").mapInArrow(
        coordinates, f"vec_id {kind}, deviation long, w array<double>"
    ) if k else rows.limit(0).selectExpr("vec_id", "0L AS deviation", "array(0D) AS w")
    shares = F.array(*(F.lit(float(e / spread)) for e in values)) if k else F.array(F.lit(0.0))
    return done.select("vec_id", "deviation", F.posexplode("w").alias("at", "whitened")).select(
        "vec_id",
        (F.col("at") + 1).alias("component"),
        F.lit(n).cast("long").alias("n"),
        "deviation",
        "whitened",
        F.element_at(shares, F.col("at") + 1).alias("explained"),
        F.lit(error).alias("identity_error"),
    )

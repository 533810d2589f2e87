"""Embedding whitening: pivoted Cholesky of the centred scatter, then
one-sided Jacobi directly on the triangular factor.

Entries are put on a grid, ``x = floor(64 * c) + 1000000``, and every distinct
vector of the table is one point of the fit.  Tasks add up whole-number sums
per dimension (exact), then the scatter of the centred vectors; both are
bounded by the dimension, whatever the number of rows.  The d x d scatter is
factored on the driver as ``P' A P = L L'`` with the largest remaining diagonal
entry as pivot.  Plane rotations from the right then make the columns of L
orthogonal: ``L J = U S``, so that ``A = P U S^2 U' P'``; the squared column
norms are the eigenvalues of the scatter and the normalised columns, put back
in the order of the dimensions, the components.  The covariance itself is
never diagonalised, which keeps small eigenvalues accurate to their own size.

Defined results: a row whose vector is null, empty, or holds a null, a
non-finite entry or one whose x is no 64-bit number is dropped, as is one of
another dimension than most distinct vectors have (the larger one where two
are equally frequent); repeated rows count once for the fit and each get
their result; a component without variance has null ``whitened`` and explains
0 (null where there is no variance at all); ``deviation`` is null beyond 64
bits; with no row left the result is empty; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ctxanomaly.llm.common import cut, prepare

COMPONENTS = 16
GRID = 64.0
OFFSET = 1_000_000
#: Directions with less than this share of the largest variance are not told
#: from the rounding of the scatter and count as none.
RESOLUTION = 1e-13
_SAFE = 1 << 62
_OUT = "vec_id long, deviation long, whitened array<double>"


def on_grid(vectors: pa.Array) -> tuple[np.ndarray, list[np.ndarray]]:
    """Positions of the usable vectors of an Arrow list array, and their x."""
    if isinstance(vectors, pa.ChunkedArray):
        vectors = vectors.combine_chunks()
    null = vectors.is_null().to_numpy(zero_copy_only=False)
    bounds = vectors.offsets.to_numpy()
    flat = vectors.values.to_numpy(zero_copy_only=False).astype(float)  # null entries become NaN
    with np.errstate(invalid="ignore", over="ignore"):
        x = np.floor(flat * GRID)
    good = np.abs(x) < _SAFE  # false for NaN and infinities
    bad = np.concatenate([[0], np.cumsum(~good)])
    keep = np.flatnonzero(~null & (np.diff(bounds) > 0) & (bad[bounds[1:]] == bad[bounds[:-1]]))
    whole = np.where(good, x, 0).astype(np.int64) + OFFSET
    return keep, [whole[bounds[i] : bounds[i + 1]] for i in keep]


def fit_list(embeddings: DataFrame, vector: str) -> DataFrame:
    """``x`` (little-endian 64-bit numbers) of every distinct vector, with its
    dimension ``dim``."""

    def grid(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            _, rows = on_grid(batch.column(0))
            yield pa.RecordBatch.from_arrays([pa.array([r.tobytes() for r in rows], pa.binary())], names=["x"])

    rows = embeddings.select(F.col(vector).cast("array<double>").alias("v")).mapInArrow(grid, "x binary")
    return cut(rows.distinct().withColumn("dim", (F.octet_length("x") / 8).cast("int")), "fit_vectors")


def matrix(column: pa.Array, dim: int) -> np.ndarray:
    """(rows, dim) numbers from a column of their bytes."""
    return np.frombuffer(b"".join(column.to_pylist()), dtype="<i8").reshape(-1, dim)


def sums(points: DataFrame, dim: int) -> tuple[int, list[int]]:
    """Number of points and exact sum of every dimension."""

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, low, high = 0, np.zeros(dim, np.int64), [0] * dim
        for batch in batches:
            x = matrix(batch.column(0), dim)
            part = x & 0xFFFFFFFF  # 32-bit halves cannot overflow within a batch
            low, n = low + part.sum(axis=0), n + len(x)
            high = [h + int(v) for h, v in zip(high, (x >> 32).sum(axis=0), strict=True)]
        total = [Decimal((h << 32) + int(v)) for h, v in zip(high, low, strict=True)]
        if n:
            columns = [pa.array(range(dim), pa.int32()), pa.array([n] * dim, pa.int64()), pa.array(total, pa.decimal128(38, 0))]
            yield pa.RecordBatch.from_arrays(columns, names=["i", "n", "s"])

    partial = points.mapInArrow(add, "i int, n long, s decimal(38,0)")
    rows = partial.groupBy("i").agg(F.sum("n").alias("n"), F.sum("s").alias("s")).orderBy("i").collect()
    return (int(rows[0]["n"]), [int(r["s"]) for r in rows]) if rows else (0, [])


def products(points: DataFrame, dim: int, width: int, project) -> np.ndarray:
    """Sum of ``y y'`` over the points, y = project(x) of the given width.
    Each task passes on one triangle of sums."""
    upper = np.triu_indices(width)

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((width, width))
        for batch in batches:
            y = project(matrix(batch.column(0), dim))
            total += y.T @ y
        where = np.arange(upper[0].size, dtype=np.int32)
        yield pa.RecordBatch.from_arrays([pa.array(where), pa.array(total[upper])], names=["at", "s"])

    rows = points.mapInArrow(add, "at int, s double").groupBy("at").agg(F.sum("s").alias("s")).toArrow()
    out = np.zeros((width, width))
    values = np.zeros(upper[0].size)
    values[rows.column("at").to_numpy()] = rows.column("s").to_numpy()
    out[upper] = values
    return out + np.triu(out, 1).T


def pivoted_cholesky(a: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(order, L) with ``a[order][:, order] = L L'``; L has as many columns as
    ``a`` has directions of variance."""
    a, d = a.copy(), len(a)
    order, lower, rank = np.arange(d), np.zeros_like(a), 0
    floor = RESOLUTION * a.diagonal().max(initial=0.0)
    for k in range(d):
        p = k + int(a.diagonal()[k:].argmax())
        if a[p, p] <= floor:
            break
        for m in (a, lower):
            m[[k, p]] = m[[p, k]]
        a[:, [k, p]] = a[:, [p, k]]
        order[[k, p]] = order[[p, k]]
        lower[k, k] = np.sqrt(a[k, k])
        lower[k + 1 :, k] = a[k + 1 :, k] / lower[k, k]
        a[k + 1 :, k + 1 :] -= np.outer(lower[k + 1 :, k], lower[k + 1 :, k])
        rank = k + 1
    return order, lower[:, :rank]


def one_sided_jacobi(columns: np.ndarray, sweeps: int = 60) -> tuple[np.ndarray, np.ndarray]:
    """(squared norms, orthonormal columns) after rotating the columns until
    all are orthogonal to working precision; by falling norm.

    A sweep meets every pair once, half of the columns against the other half
    at a time (a round-robin schedule), so a step is one array operation."""
    u = np.asfortranarray(columns)
    r = u.shape[1]
    if r == 0:
        return np.zeros(0), u
    seats = np.arange(r + r % 2)  # with an odd number one seat stays empty
    tol = 4 * np.finfo(float).eps * np.sqrt(len(u))
    for _ in range(sweeps):
        worst = 0.0
        for _ in range(len(seats) - 1):
            p, q = seats[: len(seats) // 2], seats[len(seats) // 2 :][::-1]
            real = (p < r) & (q < r)
            p, q = p[real], q[real]
            a, b = u[:, p], u[:, q]
            aa, bb, ab = (a * a).sum(0), (b * b).sum(0), (a * b).sum(0)
            cosine = np.abs(ab) / np.sqrt(aa * bb)
            worst = max(worst, cosine.max(initial=0.0))
            turn = cosine > tol
            zeta = (bb - aa) / np.where(turn, 2 * ab, 1.0)
            t = np.where(turn, np.where(zeta < 0, -1.0, 1.0) / (np.abs(zeta) + np.hypot(1.0, zeta)), 0.0)
            c = 1 / np.hypot(1.0, t)
            u[:, p], u[:, q] = c * a - c * t * b, c * t * a + c * b
            seats[1:] = np.roll(seats[1:], 1)
        if worst <= tol:
            break
    norms = (u * u).sum(0)
    falling = np.argsort(-norms, kind="stable")
    return norms[falling], u[:, falling] / np.sqrt(norms[falling])


def eigen(scatter: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Positive eigenvalues of a scatter matrix, falling, and its unit
    eigenvectors as columns."""
    order, lower = pivoted_cholesky(scatter)
    values, vectors = one_sided_jacobi(lower)
    back = np.empty_like(vectors)
    back[order] = vectors
    return values, back


def deviations(x: np.ndarray, n: int, s: list[int]) -> list[int | None]:
    """Exact ``sum (n x - S)^2`` of each row; None beyond 64 bits."""
    most = max((int(x.max()), -int(x.min())), default=0) if x.size else 0
    if max(n * most, max(map(abs, s), default=0)) < _SAFE:
        y = n * x - np.array(s, np.int64)
        if x.shape[1] * (int(np.abs(y).max(initial=0)) ** 2) < _SAFE:
            return (y * y).sum(axis=1).tolist()
    exact = [sum((n * int(v) - t) ** 2 for v, t in zip(row, s, strict=True)) for row in x]
    return [v if v < 1 << 63 else None for v in exact]


def whiten(embeddings: DataFrame, vector: str = "embedding", components: int = COMPONENTS) -> DataFrame:
    """One row per remaining row and component: ``vec_id, component, n,
    deviation, whitened, explained, identity_error, eigenvalue``."""
    spark = embeddings.sparkSession
    prepare(spark)
    distinct = fit_list(embeddings, vector)
    common = distinct.groupBy("dim").count().orderBy(F.desc("count"), F.desc("dim")).first()
    dim = common["dim"] if common else 0
    points = distinct.filter(F.col("dim") == dim).select("x")
    n, s = sums(points, dim)
    mean = np.array([Decimal(v) / n for v in s], dtype=float)
    scatter = products(points, dim, dim, lambda x: x - mean) if n else np.zeros((0, 0))
    found, vectors = eigen(scatter)
    kept = min(components, len(found))
    values, trace = found[:kept] / max(n, 1), float(np.trace(scatter)) / max(n, 1)
    basis = vectors[:, :kept] / np.sqrt(values)

    def project(x: np.ndarray) -> np.ndarray:
        return (x - mean) @ basis

    # a last column of ones adds up the whitened values, to centre them
    total = products(points, dim, kept + 1, lambda x: np.hstack([project(x), np.ones((len(x), 1))])) if kept else None
    error = None
    if kept:
        centre = total[:kept, -1] / n
        error = float(np.abs(total[:kept, :kept] / n - np.outer(centre, centre) - np.eye(kept)).max())
    shown = min(components, dim)

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at, rows = on_grid(batch.column(1))
            fits = [i for i, r in enumerate(rows) if r.size == dim]
            x = np.array([rows[i] for i in fits], np.int64).reshape(len(fits), dim)
            w = pa.array(project(x).ravel())
            starts = pa.array(np.arange(len(fits) + 1, dtype=np.int32) * kept)
            columns = [batch.column(0).take(pa.array(at[fits])), pa.array(deviations(x, n, s), pa.int64())]
            yield pa.RecordBatch.from_arrays([*columns, pa.ListArray.from_arrays(starts, w)], names=["vec_id", "deviation", "whitened"])

    rows = embeddings.select(F.col("vec_id").cast("long").alias("vec_id"), F.col(vector).cast("array<double>").alias("v"))
    each = F.array(*[
        F.struct(
            F.lit(k + 1).alias("component"),
            (F.get("whitened", F.lit(k)) if k < kept else F.lit(None).cast("double")).alias("whitened"),
            F.lit(float(values[k]) / trace if k < kept else 0.0 if trace > 0 else None).cast("double").alias("explained"),
            F.lit(float(values[k]) if k < kept else 0.0).alias("eigenvalue"),
        )
        for k in range(shown)
    ])
    none = F.array().cast("array<struct<component:int,whitened:double,explained:double,eigenvalue:double>>")
    out = rows.mapInArrow(score, _OUT).select("vec_id", "deviation", F.explode(each if shown else none).alias("c"))
    return out.select(
        "vec_id", "c.component", F.lit(n).cast("long").alias("n"), "deviation", "c.whitened", "c.explained",
        F.lit(error).cast("double").alias("identity_error"), "c.eigenvalue",
    )

"""Whitening of embeddings with eigenvectors refined from float32.

* Vectors become integers, x = floor(SCALE * entry) + OFFSET, so their sums are exact.
* The fit list holds each distinct x once: a grouping that combines equal vectors before the
  shuffle, so that a vector of a third of all rows is one row per task.
* The covariance is centred before multiplying and summed by Spark: each task adds up one
  matrix of its rows, and the tasks' matrices are added row by row.
* Its eigenvectors are found in float32 and refined by Ogita-Aishima iterations, which are
  matrix multiplications in extended precision:
      R = I - X'X,  S = X'VX,  e_i = s_ii / (1 - r_ii),
      E_ij = (s_ij + e_j r_ij) / (e_j - e_i),  X <- X + X E.
  Where e_i and e_j are closer than the residuals allow to tell (a cluster), E_ij = r_ij / 2
  keeps the vectors orthogonal, and the cluster is solved by itself: its block of
  X'(V - mean e)X, small and free of the large common eigenvalue, has its own
  eigenvectors, by which the cluster is turned.
* Every row is projected on the leading components and divided by the root of their eigenvalues.

Defined results. Rows whose vector is null or holds null or non-finite entries are left out,
and so are vectors of another width than the most frequent one (ties: the wider), which
cannot be compared with the rest, and empty vectors. Repeated rows each have their results;
null ids are kept. Components whose eigenvalue is zero to double precision (constant or
dependent dimensions, a single vector) cannot be scaled: ``whitened`` is null for them. An
empty table, or one without usable vectors, gives an empty table. Very wide vectors need a
matrix of width x width on the driver: at most MAX_WIDTH wide, else an error. Components of
equal eigenvalues may be any orthonormal choice, the same for all rows. ``deviation`` is null
where it does not fit 64 bits. Columns of other names are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from penmark.llm.common import stored

SCALE = 64
OFFSET = 1_000_000
COMPONENTS = 16
# A covariance of this width takes 512 MB on the driver in extended precision.
MAX_WIDTH = 4096
MAX_ROUNDS = 30
SLICE_ROWS = 2048
EXTENDED = np.longdouble


# -- eigenvectors --------------------------------------------------------------


@dataclass(frozen=True)
class Eigen:
    """Unit eigenvectors as columns by falling eigenvalue, and the largest residual relative to the matrix."""

    values: np.ndarray
    vectors: np.ndarray
    residual: float


def _clusters(values: np.ndarray, width: float) -> list[np.ndarray]:
    """Runs of eigenvalues, sorted, whose neighbours are no further apart than ``width``."""
    cuts = np.flatnonzero(np.abs(np.diff(values)) > width) + 1
    return [run for run in np.split(np.arange(len(values)), cuts) if len(run) > 1]


def _correction(x: np.ndarray, v: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, float]:
    """Eigenvalues, E, and what cannot be told apart yet."""
    r = np.eye(len(x), dtype=EXTENDED) - x.T @ x
    s = x.T @ (v @ x)
    # Rounding must not make them unsymmetric: divided by a small gap, it would turn vectors towards each other.
    r, s = (r + r.T) / 2, (s + s.T) / 2
    values = np.diag(s) / (1 - np.diag(r))
    off = s - np.diag(values)
    norm = lambda m: float(np.abs(m).sum(axis=0).max())
    blur = 2 * (norm(off) + norm(v) * norm(r))
    gap = values[None, :] - values[:, None]
    apart = np.abs(gap) > blur
    e = np.where(apart, (s + values[None, :] * r) / np.where(apart, gap, 1), r / 2)
    return values, e, r, blur


def refine(v: np.ndarray, rounds: int = MAX_ROUNDS) -> Eigen:
    """Eigenvectors of a symmetric matrix: float32 first, then refined until they stand still."""
    v = (v + v.T).astype(EXTENDED) / 2
    size = float(np.abs(v).max()) or 1.0
    v = v / size
    x = np.linalg.eigh(v.astype(np.float32))[1].astype(EXTENDED)
    close = len(v) * float(np.finfo(float).eps)
    for _ in range(rounds):
        values, e, _, blur = _correction(x, v)
        order = np.argsort(values)[::-1]
        x, e, values = x[:, order], e[np.ix_(order, order)], values[order]
        x = x + x @ e
        for run in _clusters(values.astype(float), blur):
            # What the members have in common goes before rounding, and their differences stay.
            middle = values[run].mean()
            y = x[:, run]
            block = y.T @ (v @ y) - middle * (y.T @ y)
            scale = np.abs(block).max()
            if scale > 0:
                turned = np.linalg.eigh(((block + block.T) / (2 * scale)).astype(np.float64))[1]
                x[:, run] = y @ turned.astype(EXTENDED)
        if float(np.abs(e).max()) < np.sqrt(close) * 1e-3 and _residual(v, x) < close:
            break
    values = np.einsum("ij,ij->j", x, v @ x) / np.einsum("ij,ij->j", x, x)
    order = np.argsort(values)[::-1]
    x = x[:, order]
    return Eigen((values[order] * size).astype(np.float64), x.astype(np.float64), _residual(v, x))


def _residual(v: np.ndarray, x: np.ndarray) -> float:
    image = v @ x
    values = np.einsum("ij,ij->j", x, image) / np.einsum("ij,ij->j", x, x)
    away = np.abs(image - x * values).max()
    return float(max(away, np.abs(np.eye(len(x), dtype=EXTENDED) - x.T @ x).max()))


# -- sums over rows ---------------------------------------------------------------


def integers(rows: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    """id and x of the rows whose vectors are whole and finite."""
    v = F.col(vector_col).cast("array<double>")
    usable = F.forall(v, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf")))
    x = F.transform(v, lambda c: F.floor(c * SCALE) + OFFSET)
    return rows.where(F.coalesce(usable, F.lit(False)) & (F.size(v) > 0)).select(F.col(id_col).alias("id"), x.alias("x"))


def _matrix(column: pa.Array) -> np.ndarray:
    width = len(column[0])
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, width)


def gram(rows: DataFrame, centre: np.ndarray, factor: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Sums of y and of y y' over rows of x, for y = x - centre, times ``factor`` if given."""
    width = len(centre) if factor is None else factor.shape[1]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums, products = np.zeros(width), np.zeros((width, width))
        for batch in batches:
            for at in range(0, batch.num_rows, SLICE_ROWS):
                y = _matrix(batch.column(0).slice(at, SLICE_ROWS)) - centre
                y = y if factor is None else y @ factor
                sums += y.sum(axis=0)
                products += y.T @ y
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.arange(width), pa.int32()), pa.array(sums), pa.array(list(products), pa.list_(pa.float64()))], ["i", "s", "p"]
        )

    partial = rows.select("x").mapInArrow(run, "i int, s double, p array<double>")
    each = partial.select("i", "s", F.posexplode("p").alias("j", "p"))
    added = each.groupBy("i", "j").agg(F.sum("p").alias("p"), F.sum("s").alias("s"))
    by_row = added.groupBy("i").agg(F.first("s").alias("s"), F.sort_array(F.collect_list(F.struct("j", "p"))).alias("p"))
    sums, products = np.zeros(width), np.zeros((width, width))
    for r in by_row.collect():
        sums[r.i], products[r.i] = r.s, [c.p for c in r.p]
    return sums, products


@dataclass(frozen=True)
class Whitening:
    """What the fit list gives. ``sums`` are exact; ``factor`` projects and scales."""

    n: int
    sums: list[int]
    eigen: Eigen
    factor: np.ndarray
    explained: np.ndarray
    identity_error: float


def fit(distinct: DataFrame, width: int, components: int = COMPONENTS) -> Whitening:
    """Components of the vectors ``x``, which are of one width and distinct."""
    if width > MAX_WIDTH:
        raise ValueError(f"vectors of {width} entries; the covariance is limited to {MAX_WIDTH}")
    entries = distinct.select(F.posexplode("x").alias("i", "c"))
    sums = [0] * width
    for r in entries.groupBy("i").agg(F.sum(F.col("c").cast("decimal(20,0)")).alias("s"), F.count("*").alias("n")).collect():
        sums[r.i], n = int(r.s), r.n
    centre = np.array([s / n for s in sums])
    first, second = gram(distinct, centre)
    # The centre is rounded; what that leaves is taken out.
    covariance = second / n - np.outer(first / n, first / n)
    eigen = refine(covariance)
    k = min(components, width)
    values, vectors = eigen.values[:k], eigen.vectors[:, :k]
    told = values > max(eigen.values[0], 0.0) * width * np.finfo(float).eps
    factor = vectors / np.sqrt(np.where(told, values, np.nan))
    error = 0.0
    if told.any():
        first, second = gram(distinct, centre, factor[:, told])
        white = second / n - np.outer(first / n, first / n)
        error = float(np.abs(white - np.eye(int(told.sum()))).max())
    total = float(np.trace(covariance))
    return Whitening(n, sums, eigen, factor, values / total if total > 0 else np.zeros(k), error)


def deviations(x: np.ndarray, n: int, sums: list[int]) -> list[int | None]:
    """Exact sum over dimensions of (n x - S)^2 for each row; null beyond 64 bits."""
    middle = [round(s / n) for s in sums]
    rest = np.array([s - n * m for s, m in zip(sums, middle)], object)
    near = x - np.array(middle, np.int64)
    top = n * (int(np.abs(near).max()) + 1) + max(abs(int(r)) for r in rest)
    if top * top * x.shape[1] < 1 << 63:
        d = near * n - rest.astype(np.int64)
        return (d * d).sum(axis=1).tolist()
    d = near.astype(object) * n - rest
    return [s if s < 1 << 63 else None for s in (d * d).sum(axis=1)]


def _project(fitted: Whitening, id_type: pa.DataType):
    n, sums, factor = fitted.n, fitted.sums, fitted.factor
    centre, k = np.array([s / n for s in sums]), factor.shape[1]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, SLICE_ROWS):
                part = batch.slice(at, SLICE_ROWS)
                x = _matrix(part.column(1))
                white = (x - centre) @ factor
                again = np.repeat(np.arange(len(x)), k)
                flat = white.ravel()
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column(0).take(pa.array(again)),
                        pa.array(np.tile(np.arange(1, k + 1), len(x)), pa.int32()),
                        pa.array(deviations(x, n, sums), pa.int64()).take(pa.array(again)),
                        pa.array(flat, mask=np.isnan(flat)),
                    ],
                    ["id", "component", "deviation", "whitened"],
                )

    return run


def whiten(rows: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", components: int = COMPONENTS) -> DataFrame:
    """One row per vector and component."""
    spark, id_kind = rows.sparkSession, rows.schema[id_col].dataType
    whole = stored(integers(rows, id_col, vector_col), "vectors")
    widths = whole.groupBy(F.size("x").alias("width")).agg(F.count("*").alias("n"))
    common = widths.orderBy(F.desc("n"), F.desc("width")).first()
    ddl = f"id {id_kind.simpleString()}, component int, deviation bigint, whitened double"
    result = spark.createDataFrame([], ddl)
    n, explained, error = 0, [0.0], 0.0
    if common:
        whole = whole.where(F.size("x") == common.width)
        distinct = stored(whole.groupBy("x").agg(F.count("*").alias("copies")).select("x"), "fit-list")
        fitted = fit(distinct, common.width, components)
        result = whole.mapInArrow(_project(fitted, to_arrow_type(id_kind)), ddl)
        n, explained, error = fitted.n, fitted.explained.tolist(), fitted.identity_error
    shares = F.array(*[F.lit(float(e)) for e in explained])
    return result.select(
        F.col("id").alias(id_col),
        "component",
        F.lit(n).cast("bigint").alias("n"),
        "deviation",
        "whitened",
        F.element_at(shares, F.col("component")).alias("explained"),
        F.lit(float(error)).alias("identity_error"),
    )

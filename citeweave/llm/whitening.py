"""Embedding whitening: pivoted Cholesky of the centred scatter, one-sided Jacobi on the factor.

Entries become integers, so the scatter is exact: tasks add up integer products and the totals give
``n * sum(x x') - S S'``, which is n times the sum of products of centred entries without rounding.
Only the totals (d * d numbers) reach the driver, where the d x d factorization takes place:

    V = P L L' P'      pivoted Cholesky; it stops where the rest is rounding (rank r)
    (P L) J = U D      Jacobi rotations J make the r columns orthogonal; their squared norms are the
                       eigenvalues of V, the normalised columns U its eigenvectors

Tasks then project every vector on the leading components.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from citeweave.session import write_scratch

SCALE = 1024
COMPONENTS = 8
# Totals travel as signed digits to this base, so their sums over tasks stay far inside 64 bits.
DIGIT_BITS = 40
# Vectors handled at once inside a task.
SLICE = 4096


# ---------------------------------------------------------------- factorization (d x d, numpy)

def pivoted_cholesky(v: np.ndarray) -> np.ndarray:
    """A factor F (d x r) with ``v = F F'``, r the numerical rank; rows are in the order of ``v``,
    so F is a row permutation of a triangular matrix."""
    rest, columns = v.copy(), []
    floor = len(v) * np.finfo(float).eps * max(np.diag(v).max(initial=0.0), 0.0)
    open_rows = np.ones(len(v), bool)
    while open_rows.any():
        pivot = int(np.argmax(np.where(open_rows, np.diag(rest), -np.inf)))
        if not rest[pivot, pivot] > floor:
            break
        column = np.where(open_rows, rest[:, pivot] / np.sqrt(rest[pivot, pivot]), 0.0)
        column[pivot] = np.sqrt(rest[pivot, pivot])
        rest = rest - np.outer(column, column)
        open_rows[pivot] = False
        columns.append(column)
    return np.array(columns).T.reshape(len(v), len(columns))


def _rounds(r: int) -> list[tuple[np.ndarray, np.ndarray]]:
    """All pairs of r columns as rounds of disjoint pairs (round-robin tournament)."""
    seats = list(range(r + r % 2))
    found = []
    for _ in range(len(seats) - 1):
        pairs = [(a, b) for a, b in zip(seats[:len(seats) // 2], seats[::-1]) if max(a, b) < r]
        found.append(tuple(np.array(side, int) for side in zip(*pairs)) if pairs else
                     (np.zeros(0, int), np.zeros(0, int)))
        seats = [seats[0], seats[-1], *seats[1:-1]]
    return found


def one_sided_jacobi(factor: np.ndarray, sweeps: int = 60) -> tuple[np.ndarray, np.ndarray]:
    """Eigenvalues (falling) and unit eigenvectors (columns) of ``factor factor'``.

    Pairs of columns are rotated until all are orthogonal to working precision. The disjoint pairs
    of a round are rotated together.
    """
    columns = factor.T.copy()
    tolerance = np.finfo(float).eps * np.sqrt(max(len(columns), 1))
    for _ in range(sweeps):
        largest = 0.0
        for a, b in _rounds(len(columns)):
            p, q = columns[a], columns[b]
            pp, qq, pq = ((x * y).sum(1) for x, y in ((p, p), (q, q), (p, q)))
            size = np.sqrt(pp * qq)
            off = np.divide(np.abs(pq), size, out=np.zeros_like(size), where=size > 0)
            largest = max(largest, off.max(initial=0.0))
            turn = off > tolerance
            zeta = np.divide(qq - pp, 2 * pq, out=np.zeros_like(pq), where=turn)
            tan = np.where(turn, np.where(zeta < 0, -1.0, 1.0)
                           / (np.abs(zeta) + np.sqrt(1 + zeta * zeta)), 0.0)
            cos = 1 / np.sqrt(1 + tan * tan)
            sin = cos * tan
            columns[a] = cos[:, None] * p - sin[:, None] * q
            columns[b] = sin[:, None] * p + cos[:, None] * q
        if largest <= tolerance:
            break
    norms = np.sqrt((columns * columns).sum(1))
    order = np.argsort(-norms, kind="stable")
    order = order[norms[order] > 0]
    return norms[order] ** 2, (columns[order] / norms[order, None]).T


# ---------------------------------------------------------------- exact sums

def as_integers(batch: pa.ListArray, dim: int) -> np.ndarray:
    """Lists of ``dim`` finite numbers as integers floor(SCALE * entry), one row each. Entries
    beyond the range of long are cut to it."""
    flat = batch.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    scaled = np.floor(SCALE * flat)
    whole = np.clip(scaled, -(2.0 ** 63), 2.0 ** 63 - 1024).astype(np.int64)
    return whole.reshape(-1, dim)


def _reach(x: np.ndarray) -> int:
    return max(abs(int(x.min())), abs(int(x.max())))


def _gram(x: np.ndarray):
    """``x' x`` exactly: by floating point where no partial sum leaves 53 bits, else by Python's
    integers."""
    reach = _reach(x)
    if reach * reach * len(x) < 2 ** 53:
        f = x.astype(np.float64)
        return (f.T @ f).astype(np.int64).astype(object)
    big = x.astype(object)
    return big.T @ big


def _sums(x: np.ndarray):
    """Column sums, exactly."""
    return (x if _reach(x) * len(x) < 2 ** 63 else x.astype(object)).sum(0).astype(object)


def _digits(value: int) -> list[tuple[int, int]]:
    """(place, digit) of an integer to the base 2 ** DIGIT_BITS, zeros left out."""
    sign, value, place, found = (-1 if value < 0 else 1), abs(value), 0, []
    while value:
        digit = value & ((1 << DIGIT_BITS) - 1)
        if digit:
            found.append((place, sign * digit))
        value >>= DIGIT_BITS
        place += 1
    return found


def _slices(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for at in range(0, batch.num_rows, SLICE):
            yield batch.slice(at, SLICE)


def _total_rows(dim: int):
    """Sums over a task as rows (i, j, place, digit): j = dim holds the sums, (dim, dim) counts."""
    def totals(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        gram, sums, n = np.zeros((dim, dim), object), np.zeros(dim, object), 0
        for batch in _slices(batches):
            if batch.num_rows:
                x = as_integers(batch.column(0), dim)
                gram = gram + _gram(x)
                sums = sums + _sums(x)
                n += len(x)
        if not n:
            return
        for i in range(dim + 1):
            cells = ([(j, int(gram[i, j])) for j in range(i, dim)] + [(dim, int(sums[i]))]
                     if i < dim else [(dim, n)])
            rows = [(j, *d) for j, value in cells for d in _digits(value)]
            if rows:
                j, place, digit = (pa.array(c, pa.int64()) for c in zip(*rows))
                yield pa.RecordBatch.from_arrays(
                    [pa.array([i] * len(rows), pa.int64()), j, place, digit],
                    ["i", "j", "place", "digit"])

    return totals


# ---------------------------------------------------------------- fit and transform

@dataclass(frozen=True)
class Whitening:
    """A fitted transform: number and integer sums of the fit list, eigenvalues (falling) and
    components (columns) of its covariance, and the covariance's trace."""

    dim: int
    n: int
    sums: tuple[int, ...]
    eigenvalues: np.ndarray
    components: np.ndarray
    trace: float


def fit_vectors(embeddings: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding"
                ) -> tuple[DataFrame, int]:
    """(``vec_id``, ``vector`` array<double>) of the usable rows, and their dimension.

    Rows whose vector is null, empty, or holds a null or non-finite entry are dropped. Vectors of
    several lengths have no common covariance: those of the commonest length stay (ties: the
    longer). Repeated rows and null ids stay.
    """
    vector = F.col(vector_col).cast("array<double>")
    usable = embeddings.select(F.col(id_col).alias("vec_id"), vector.alias("vector")).where(
        (F.size("vector") > 0) & F.forall("vector", lambda c: F.coalesce(
            ~F.isnan(c) & (F.abs(c) < float("inf")), F.lit(False))))
    lengths = usable.groupBy(F.size("vector").alias("d")).count()
    top = lengths.orderBy(F.desc("count"), F.desc("d")).limit(1).collect()
    dim = top[0]["d"] if top else 0
    return usable.where(F.size("vector") == dim), dim


def fit(vectors: DataFrame, dim: int) -> Whitening | None:
    """Fit on every row of ``vector``; None of an empty list. The driver gets d * d totals."""
    if not dim:
        return None
    rows = vectors.select("vector").mapInArrow(_total_rows(dim),
                                               "i long, j long, place long, digit long")
    gram, sums, n = np.zeros((dim, dim), object), [0] * dim, 0
    for r in rows.groupBy("i", "j", "place").agg(F.sum("digit").alias("digit")).collect():
        value = r["digit"] << (DIGIT_BITS * r["place"])
        if r["i"] == dim:
            n += value
        elif r["j"] == dim:
            sums[r["i"]] += value
        else:
            gram[r["i"], r["j"]] += value
            if r["i"] != r["j"]:
                gram[r["j"], r["i"]] += value
    if not n:
        return None
    scatter = [[n * gram[i, j] - sums[i] * sums[j] for j in range(dim)] for i in range(dim)]
    # True division of integers rounds once.
    covariance = np.array([[value / (n * n) for value in row] for row in scatter])
    values, components = one_sided_jacobi(pivoted_cholesky(covariance))
    real = values > dim * np.finfo(float).eps * values.max(initial=0.0)
    trace = sum(scatter[i][i] for i in range(dim)) / (n * n)
    return Whitening(dim, n, tuple(sums), values[real], components[:, real], trace)


def _projection(model: Whitening, n_components: int):
    dim, n = model.dim, model.n
    sums = np.array(model.sums, object)
    weights = (model.components[:, :n_components]
               / np.sqrt(model.eigenvalues[:n_components])[None, :])

    def project(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _slices(batches):
            if not batch.num_rows:
                continue
            x = as_integers(batch.column(1), dim)
            reach = n * _reach(x) + max(map(abs, model.sums))
            if dim * reach * reach < 2 ** 63:
                centred = n * x - sums.astype(np.int64)
                deviation = (centred * centred).sum(1).tolist()
            else:
                centred = n * x.astype(object) - sums
                deviation = [sum(c * c for c in row) for row in centred]
            # Beyond 38 digits no decimal holds the exact value.
            deviation = [str(v) if v < 10 ** 38 else None for v in deviation]
            whitened = (centred.astype(np.float64) / n) @ weights
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(deviation, pa.string()),
                 pa.array(list(whitened), pa.list_(pa.float64()))],
                ["vec_id", "deviation", "whitened"])

    return project


def whiten(embeddings: DataFrame, n_components: int = COMPONENTS, id_col: str = "vec_id",
           vector_col: str = "embedding") -> DataFrame:
    """Every usable vector whitened: one row per vector and component.

    Columns: ``vec_id``, ``component`` (from 1, by falling eigenvalue), ``n`` (vectors of the fit),
    ``deviation`` (decimal: sum over dimensions of (n * x - S) ** 2, exact; null beyond 38 digits),
    ``whitened``, ``explained`` (eigenvalue / trace), ``identity_error`` (largest absolute entry of
    the whitened values' covariance minus the identity, measured on the result). Usable rows are
    those of ``fit_vectors``. A covariance of rank r gives r components at most; with no usable
    vector, or with all vectors equal, there is no row. Repeated rows and null ids get rows of
    their own. Other columns are not read, so their names cannot clash.
    """
    spark = embeddings.sparkSession
    id_type = embeddings.schema[id_col].dataType.simpleString()
    vectors, dim = fit_vectors(embeddings, id_col, vector_col)
    model = fit(vectors, dim)
    k = 0 if model is None else min(n_components, len(model.eigenvalues))
    if not k:
        return spark.createDataFrame([], (
            f"vec_id {id_type}, component int, n long, deviation decimal(38,0), "
            "whitened double, explained double, identity_error double"))
    # Read twice (the measured covariance, then the result); much narrower than the vectors.
    projected = spark.read.parquet(write_scratch(vectors.mapInArrow(
        _projection(model, k), f"vec_id {id_type}, deviation string, whitened array<double>"),
        "whitened"))
    entry = [F.col("whitened")[c] for c in range(k)]
    error = projected.select([
        F.abs(F.covar_pop(entry[a], entry[b]) - float(a == b)).alias(f"e{a}_{b}")
        for a in range(k) for b in range(a, k)]).first()
    rows = projected.select("vec_id", "deviation", F.posexplode("whitened").alias("at", "value"))
    explained = F.array(*[F.lit(float(v / model.trace)) for v in model.eigenvalues[:k]])
    return rows.select(
        "vec_id", (F.col("at") + 1).alias("component"), F.lit(model.n).cast("long").alias("n"),
        F.col("deviation").cast("decimal(38,0)").alias("deviation"),
        F.col("value").alias("whitened"), F.get(explained, F.col("at")).alias("explained"),
        F.lit(float(max(error))).alias("identity_error"))

"""Operator 12: whitening of embeddings, by pivoted Cholesky and one-sided Jacobi.

Vectors enter on an integer grid; the distinct ones are the fit list. One pass over it gives the
count and exact sums per dimension, a second the scatter of the vectors, each centred before it is
multiplied. Tasks hand on one sum per pair of dimensions, which combine before the shuffle, so
the driver receives a triangle of the size dimension times dimension, whatever the number of rows.

The scatter matrix is factored by Cholesky with the largest remaining diagonal entry first. One-sided
Jacobi turns the columns of that triangular factor until they are orthogonal, without forming
a product again: their squared norms are the eigenvalues, the columns over their norms the
components. Small eigenvalues keep their relative precision that way. A third pass measures
how far the covariance of the whitened fit list is from the identity.

Defined cases: rows whose vector is null or holds a null or a value that is not finite give no rows, nor
do empty vectors; vectors of different dimensions are fitted apart, each dimension by itself; repeated
vectors count once in the fit but every row gets its results; ties of eigenvalues leave the choice of
components within their span open; directions without variance are no components, so constant vectors or
an empty table give no rows; grid values beyond 2^61 stay there; a deviation too large for a long is null;
result columns whose names kept columns bear get underscores at their end.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass
from decimal import Decimal

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, functions as F

from stagecheck.llm.common import free_names, settle

GRID, SHIFT = 64, 1_000_000
COMPONENTS = 16
_FAR = 2.0**61


@dataclass(frozen=True)
class Centre:
    """Exact mean of the vectors of one dimension: ``whole`` + ``rest`` / ``n``."""

    n: int
    whole: np.ndarray
    rest: np.ndarray

    def centred(self, x: np.ndarray) -> np.ndarray:
        return (x - self.whole) - self.rest / self.n

    def deviations(self, x: np.ndarray) -> list[int | None]:
        """For each row the exact sum of squares of n * x - S."""
        apart = x - self.whole
        if float(np.abs(apart).max(initial=0) + 1) * self.n * np.sqrt(x.shape[1]) < 2**31:
            return ((apart * self.n - self.rest) ** 2).sum(1).tolist()
        exact = ((apart.astype(object) * self.n - self.rest.astype(object)) ** 2).sum(1)
        return [v if v < 1 << 63 else None for v in exact]


@dataclass(frozen=True)
class Whitening:
    """What the fit list of one dimension gives: the components are the columns of ``vectors``."""

    centre: Centre
    vectors: np.ndarray
    eigenvalues: np.ndarray
    trace: float
    identity_error: float = 0.0

    def whitened(self, x: np.ndarray) -> np.ndarray:
        return self.centre.centred(x) @ (self.vectors / np.sqrt(self.eigenvalues))


def pivoted_cholesky(matrix: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(factor, order) with ``matrix[order][:, order] = factor @ factor.T``; the factor has one column per rank."""
    rest = matrix.astype(float).copy()
    size = len(rest)
    order = np.arange(size)
    factor = np.zeros((size, size))
    limit = size * np.finfo(float).eps * max(0.0, rest.diagonal().max(initial=0.0))
    for k in range(size):
        p = k + int(rest.diagonal()[k:].argmax())
        if rest[p, p] <= limit:
            return factor[:, :k], order
        for swapped in (rest, rest.T, factor, order):
            swapped[[k, p]] = swapped[[p, k]]
        factor[k, k] = np.sqrt(rest[k, k])
        factor[k + 1 :, k] = rest[k + 1 :, k] / factor[k, k]
        rest[k + 1 :, k + 1 :] -= np.outer(factor[k + 1 :, k], factor[k + 1 :, k])
    return factor, order


def one_sided_jacobi(columns: np.ndarray, sweeps: int = 60) -> np.ndarray:
    """Turn pairs of columns until all are orthogonal; a round turns disjoint pairs at once."""
    work = columns.astype(float).copy()
    count = work.shape[1]
    players = np.arange(count + count % 2)
    limit = np.sqrt(max(1, len(work))) * np.finfo(float).eps
    for _ in range(sweeps):
        turned = False
        for _ in range(len(players) - 1):
            a, b = players[: len(players) // 2], players[::-1][: len(players) // 2]
            both = (a < count) & (b < count)
            a, b = a[both], b[both]
            one, two = work[:, a], work[:, b]
            x, y, z = (one * one).sum(0), (two * two).sum(0), (one * two).sum(0)
            far = np.abs(z) > limit * np.sqrt(x * y)
            if far.any():
                turned = True
                a, b, one, two = a[far], b[far], one[:, far], two[:, far]
                zeta = (y[far] - x[far]) / (2 * z[far])
                tangent = np.where(zeta >= 0, 1.0, -1.0) / (np.abs(zeta) + np.hypot(1.0, zeta))
                cosine = 1 / np.hypot(1.0, tangent)
                work[:, a], work[:, b] = cosine * (one - tangent * two), cosine * (tangent * one + two)
            players = np.concatenate([players[:1], players[-1:], players[1:-1]])
        if not turned:
            return work
    raise ArithmeticError(f"columns are not orthogonal after {sweeps} sweeps")


def principal(matrix: np.ndarray, components: int) -> tuple[np.ndarray, np.ndarray]:
    """Eigenvalues, falling, and unit eigenvectors (columns) of a covariance matrix; those of no variance are left out."""
    factor, order = pivoted_cholesky(matrix)
    turned = one_sided_jacobi(factor)
    squares = (turned**2).sum(0)
    first = np.argsort(-squares, kind="stable")[:components]
    vectors = np.empty((len(matrix), len(first)))
    vectors[order] = turned[:, first] / np.sqrt(squares[first])
    return squares[first], vectors


def on_grid(column: pa.Array, grid: float, shift: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(rows, matrix of grid values) of the usable vectors, by dimension."""
    sizes = pc.fill_null(pc.list_value_length(column), 0).to_numpy(zero_copy_only=False)
    values = column.flatten().cast(pa.float64(), safe=False).to_numpy(zero_copy_only=False)
    begins = np.cumsum(sizes) - sizes
    rows = np.repeat(np.arange(len(sizes)), sizes)
    usable = (np.bincount(rows[~np.isfinite(values)], minlength=len(sizes)) == 0) & (sizes > 0)
    for size in np.unique(sizes[usable]):
        here = np.flatnonzero(usable & (sizes == size))
        taken = values[begins[here][:, None] + np.arange(size)]
        with np.errstate(over="ignore"):
            yield here, np.clip(np.floor(taken * grid), -_FAR, _FAR).astype(np.int64) + shift


def _unpacked(batch: pa.RecordBatch) -> Iterator[tuple[int, np.ndarray]]:
    """Matrices of the packed vectors of a batch, by dimension."""
    packed = batch.column(0).to_pylist()
    sizes = np.array([len(p) // 8 for p in packed])
    for size in np.unique(sizes):
        chosen = [p for p, s in zip(packed, sizes.tolist(), strict=True) if s == size]
        yield int(size), np.frombuffer(b"".join(chosen), "<i8").reshape(len(chosen), int(size))


def _upper(size: int, matrix: np.ndarray) -> pa.RecordBatch:
    i, j = np.triu_indices(len(matrix))
    return pa.RecordBatch.from_arrays([pa.array(np.full(len(i), size)), pa.array(i), pa.array(j), pa.array(matrix[i, j])], names=["size", "i", "j", "v"])


def _matrices(partial: DataFrame) -> dict[int, np.ndarray]:
    """Add the parts of each entry up and bring the sums, one triangle for each dimension, to the driver."""
    sums = partial.groupBy("size", "i", "j").agg(F.sum("v").alias("v")).toArrow().to_pydict()
    size, i, j, v = (np.array(sums[c]) for c in ("size", "i", "j", "v"))
    out = {}
    for s in np.unique(size):
        here = size == s
        width = int(j[here].max()) + 1
        matrix = np.zeros((width, width))
        matrix[i[here], j[here]] = v[here]
        out[int(s)] = matrix + np.triu(matrix, 1).T
    return out


def _centres(fit: DataFrame) -> dict[int, Centre]:
    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        low: dict[int, np.ndarray] = {}
        for batch in batches:
            for size, x in _unpacked(batch):
                halves = np.stack([x >> 31, x & 0x7FFFFFFF, np.ones_like(x)]).sum(1)
                low[size] = low.get(size, 0) + halves
        for size, (upper, lower, count) in low.items():
            total = [Decimal(int(u) * (1 << 31) + int(v)) for u, v in zip(upper, lower, strict=True)]
            yield pa.RecordBatch.from_arrays(
                [pa.array([size] * size), pa.array(range(size)), pa.array(total, pa.decimal128(38, 0)), pa.array(count)],
                names=["size", "i", "total", "n"])

    sums = fit.mapInArrow(add, "size bigint, i bigint, total decimal(38,0), n bigint").groupBy("size", "i").agg(
        F.sum("total").alias("total"), F.sum("n").alias("n"))
    out: dict[int, Centre] = {}
    for row in sums.collect():  # one row for each dimension of a vector
        if row.size not in out:
            out[row.size] = Centre(row.n, np.zeros(row.size, np.int64), np.zeros(row.size, np.int64))
        out[row.size].whole[row.i], out[row.size].rest[row.i] = divmod(int(row.total), row.n)
    return out


def fit_whitening(
    df: DataFrame, vector: str = "embedding", components: int = COMPONENTS, grid: float = GRID, shift: int = SHIFT,
) -> dict[int, Whitening]:
    """A whitening for each dimension that vectors have, fitted to the distinct vectors on the grid."""
    spark = df.sparkSession

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for _, x in on_grid(batch.column(0), grid, shift):
                yield pa.RecordBatch.from_arrays([pa.array([row.tobytes() for row in x.astype("<i8")], pa.binary())], names=["packed"])

    fit = settle(df.select(vector).mapInArrow(pack, "packed binary").distinct(), "whitening-fit")
    centres = spark.sparkContext.broadcast(_centres(fit))

    def scatter(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[int, np.ndarray] = {}
        for batch in batches:
            for size, x in _unpacked(batch):
                apart = centres.value[size].centred(x)
                total[size] = total.get(size, 0) + apart.T @ apart
        for size, matrix in total.items():
            yield _upper(size, matrix)

    entries = "size bigint, i bigint, j bigint, v double"
    models = {}
    for size, matrix in _matrices(fit.mapInArrow(scatter, entries)).items():
        covariance = matrix / centres.value[size].n
        eigenvalues, vectors = principal(covariance, components)
        models[size] = Whitening(centres.value[size], vectors, eigenvalues, float(np.trace(covariance)))
    shared = spark.sparkContext.broadcast(models)

    def white(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[int, np.ndarray] = {}
        for batch in batches:
            for size, x in _unpacked(batch):
                # A column of ones makes the last row and column of the product the sums.
                made = np.concatenate([shared.value[size].whitened(x), np.ones((len(x), 1))], 1)
                total[size] = total.get(size, 0) + made.T @ made
        for size, matrix in total.items():
            yield _upper(size, matrix)

    out = {}
    for size, matrix in _matrices(fit.mapInArrow(white, entries)).items():
        model = models[size]
        mean = matrix[:-1, -1] / model.centre.n
        error = matrix[:-1, :-1] / model.centre.n - np.outer(mean, mean) - np.eye(len(mean))
        out[size] = Whitening(model.centre, model.vectors, model.eigenvalues, model.trace, float(np.abs(error).max(initial=0.0)))
    return out


def whiten(
    df: DataFrame, vector: str = "embedding", keep: Sequence[str] = ("vec_id",), components: int = COMPONENTS,
    grid: float = GRID, shift: int = SHIFT, models: dict[int, Whitening] | None = None,
) -> DataFrame:
    """``keep``, component, n, deviation, whitened, explained, identity_error: a row for each usable vector and component.

    ``models`` come from :func:`fit_whitening`, by default of ``df`` itself; vectors of a
    dimension that has no model give no rows.
    """
    shared = df.sparkSession.sparkContext.broadcast(
        fit_whitening(df, vector, components, grid, shift) if models is None else models)
    own = df.select(*keep, F.col(vector).alias(free_names(["_vector"], keep)[0]))
    names = free_names(("component", "n", "deviation", "whitened", "explained", "identity_error"), keep)
    kinds = ("int", "bigint", "bigint", "double", "double", "double")
    kept = [f"`{f.name}` {f.dataType.simpleString()}" for f in own.schema.fields[:-1]]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for rows, x in on_grid(batch.column(len(keep)), grid, shift):
                model = shared.value.get(x.shape[1])
                count = 0 if model is None else len(model.eigenvalues)
                if not count:
                    continue
                per_row = pa.array(np.repeat(rows, count))
                deviations = pa.array(model.centre.deviations(x), pa.int64()).take(pa.array(np.repeat(np.arange(len(rows)), count)))
                whole = len(rows) * count
                yield pa.RecordBatch.from_arrays([
                    *(c.take(per_row) for c in batch.columns[: len(keep)]),
                    pa.array(np.tile(np.arange(1, count + 1, dtype=np.int32), len(rows))),
                    pa.array(np.full(whole, model.centre.n)), deviations, pa.array(model.whitened(x).reshape(-1)),
                    pa.array(np.tile(model.eigenvalues / model.trace, len(rows))), pa.array(np.full(whole, model.identity_error)),
                ], names=[*keep, *names])

    return own.mapInArrow(run, ", ".join([*kept, *(f"{n} {k}" for n, k in zip(names, kinds, strict=True))]))

"""Whitening of embeddings by their leading principal components.

Sums and centred products of all vectors are added up per partition and then over partitions. The components
of their covariance come from spectral divide and conquer: the polar factor of the shifted covariance, found
by dynamically weighted Halley steps, gives the projector on the components above the shift; both invariant
subspaces are split again until they hold one component each. Only that small matrix is on the driver; the
components go back to the tasks, which project every row.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from cohortica.llm.shared import checkpoint

SCALE, SHIFT = 1024, 100_000
#: The covariance of so many dimensions is 32 MB on the driver and as cells of a partition; more is an error.
MAX_DIMENSIONS = 2048
_EPS = np.finfo(float).eps


# ---- vectors -------------------------------------------------------------------------------------------------------

def usable(vector: Column) -> Column:
    """Whether a vector is there, has entries, and all of them are finite numbers."""
    bad = F.exists(vector, lambda c: c.isNull() | F.isnan(c) | (F.abs(c) == float("inf")))
    return F.coalesce((F.size(vector) > 0) & ~bad, F.lit(False))


def _matrices(column: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(row numbers, whole-number vectors) of a batch, one pair for each length of vector in it."""
    lengths = column.value_lengths().to_numpy(zero_copy_only=False)
    starts = np.concatenate(([0], np.cumsum(lengths)[:-1])).astype(np.int64)
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    for length in np.unique(lengths):
        rows = np.flatnonzero(lengths == length)
        scaled = np.floor(SCALE * flat[starts[rows][:, None] + np.arange(length)])
        if np.abs(scaled).max() >= 2.0 ** 52:
            raise ValueError("an entry of a vector is too large for a whole number of 64 bits")
        yield rows, scaled.astype(np.int64) + SHIFT


def _cells(name: np.ndarray, value: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(name), pa.array(value)], ["cell", "value"])


def sums(vectors: DataFrame) -> tuple[int, np.ndarray]:
    """(number of vectors, exact sums per dimension). The length that most vectors have counts, the longer of
    equals; no vectors: (0, empty)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: dict[int, np.ndarray] = {}  # by length: the sums, then the number of vectors
        for batch in batches:
            for _, x in _matrices(batch.column(0)):
                found.setdefault(x.shape[1], np.zeros(x.shape[1] + 1, np.int64))[:] += np.append(x.sum(0), len(x))
        for length, value in found.items():
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.full(length + 1, length)), pa.array(np.arange(length + 1)), pa.array(value)],
                ["length", "cell", "value"])

    totals = checkpoint(vectors.select("vector").mapInArrow(run, "length long, cell long, value long")
                        .groupBy("length", "cell").agg(F.sum("value").alias("value")))
    most = totals.where("cell = length").orderBy(F.desc("value"), F.desc("length")).first()
    if most is None:
        return 0, np.zeros(0, np.int64)
    if most["length"] > MAX_DIMENSIONS:
        raise ValueError(f"vectors have {most['length']} dimensions; at most {MAX_DIMENSIONS} are supported")
    cells = dict(totals.where((F.col("length") == most["length"]) & (F.col("cell") < most["length"]))
                 .select("cell", "value").collect())
    return most["value"], np.array([cells[i] for i in range(most["length"])], np.int64)


@dataclass
class _Centre:
    """Subtracts the exact mean: first its whole part, in whole numbers, then its fraction."""

    n: int
    total: np.ndarray

    def centred(self, x: np.ndarray) -> np.ndarray:
        whole = self.total // self.n
        return (x - whole).astype(np.float64) - (self.total - whole * self.n) / self.n

    def deviation(self, x: np.ndarray) -> list[int | None]:
        """Sum over dimensions of (n * x - total) squared, exact; None where it is beyond 64 bits."""
        most = self.n * max(int(np.abs(x).max()), 1) + int(np.abs(self.total).max())
        if most < 2 ** 62:
            gap = self.n * x - self.total
            if int(np.abs(gap).max()) ** 2 * x.shape[1] < 2 ** 63:
                return (gap * gap).sum(1).tolist()
        exact = [sum((self.n * a - t) ** 2 for a, t in zip(row, self.total.tolist())) for row in x.tolist()]
        return [v if v < 2 ** 63 else None for v in exact]


def _products(vectors: DataFrame, centre: _Centre, weights: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """(sums, products) of all centred vectors, times `weights` if given: one small matrix a partition is added up."""
    dims = len(centre.total)
    width = dims if weights is None else weights.shape[1]
    upper = np.triu_indices(width)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        first, second = np.zeros(width), np.zeros((width, width))
        for batch in batches:
            for _, x in _matrices(batch.column(0)):
                if x.shape[1] == dims:
                    z = centre.centred(x)
                    z = z if weights is None else z @ weights
                    first += z.sum(0)
                    second += z.T @ z
        if second.any():
            values = np.concatenate((first, second[upper]))
            yield _cells(np.arange(len(values)), values)

    cells = dict(vectors.select("vector").mapInArrow(run, "cell long, value double").groupBy("cell").agg(F.sum("value")).collect())
    values = np.array([cells.get(i, 0.0) for i in range(width + len(upper[0]))])
    second = np.zeros((width, width))
    second[upper] = values[width:]
    return values[:width], second + np.triu(second, 1).T


# ---- components ----------------------------------------------------------------------------------------------------

def polar(a: np.ndarray, most: int = 40) -> np.ndarray:
    """Orthogonal polar factor of a nonsingular matrix by dynamically weighted Halley steps.

    The weights follow a lower bound of the smallest singular value, so about six steps are enough for any
    condition; badly conditioned steps use a QR factorization, the others a Cholesky factorization.
    """
    eye = np.eye(len(a))
    x = a / np.linalg.norm(a)
    low = min(1.0, 1.0 / np.linalg.norm(np.linalg.inv(x)))
    for _ in range(most):
        square = low * low
        d = np.cbrt(4 * max(1 - square, 0.0) / square ** 2)
        root = np.sqrt(1 + d)
        wa = root + 0.5 * np.sqrt(max(8 - 4 * d + 8 * (2 - square) / (square * root), 0.0))
        wb = (wa - 1) ** 2 / 4
        wc = wa + wb - 1
        if wc > 100:
            q, _ = np.linalg.qr(np.vstack((np.sqrt(wc) * x, eye)))
            after = wb / wc * x + (wa - wb / wc) / np.sqrt(wc) * (q[:len(a)] @ q[len(a):].T)
        else:
            half = np.linalg.solve(np.linalg.cholesky(eye + wc * (x.T @ x)), x.T)
            after = wb / wc * x + (wa - wb / wc) * np.linalg.solve(np.linalg.cholesky(eye + wc * (x.T @ x)).T, half).T
        low = min(1.0, low * (wa + wb * square) / (1 + wc * square))
        moved, x = np.linalg.norm(after - x), after
        if moved <= np.cbrt(4 * _EPS) / 8 and 1 - low <= 10 * _EPS:
            break
    return x


def _halves(a: np.ndarray, floor: float) -> tuple[int, np.ndarray] | None:
    """(k, orthogonal basis) whose first k columns span the components above some shift; None if all are alike."""
    m = len(a)
    radius = np.abs(a).sum(1) - np.abs(np.diag(a))
    low, high = (np.diag(a) - radius).min(), (np.diag(a) + radius).max()
    shift = float(np.median(np.diag(a)))
    start = np.random.default_rng(m).standard_normal((m, m))
    while high - low > floor:
        try:
            sign = polar(a - shift * np.eye(m))
        except np.linalg.LinAlgError:  # the shift is a component's variance: move it a little
            shift += (high - low) * 1e-3
            continue
        projector = (np.eye(m) + (sign + sign.T) / 2) / 2
        k = int(round(np.trace(projector)))
        if 0 < k < m:
            upper, lower = projector @ start[:, :k], start[:, k:] - projector @ start[:, k:]
            for _ in range(2):
                upper = projector @ np.linalg.qr(upper)[0]
                lower = np.linalg.qr(lower)[0]
                lower = lower - projector @ lower
            return k, np.linalg.qr(np.hstack((upper, lower)))[0]
        low, high = (shift, high) if k == m else (low, shift)
        shift = (low + high) / 2
    return None


def leading(a: np.ndarray, want: int) -> tuple[np.ndarray, np.ndarray]:
    """(variances, components as columns) of the `want` largest eigenvalues of a symmetric matrix, falling.

    Subspaces below the wanted ones are not split further. Where eigenvalues agree to working precision, any
    basis of their subspace is given. Each component's largest entry is positive.
    """
    floor = 8 * _EPS * max(np.linalg.norm(a), np.finfo(float).tiny)

    def split(part: np.ndarray, basis: np.ndarray, count: int) -> list[np.ndarray]:
        if count <= 0:
            return []
        halves = _halves(part, floor) if len(part) > 1 else None
        if halves is None:
            return [basis[:, i] for i in range(min(count, len(part)))]
        k, turn = halves
        turned = turn.T @ part @ turn
        turned = (turned + turned.T) / 2
        above = split(turned[:k, :k], basis @ turn[:, :k], count)
        return above + split(turned[k:, k:], basis @ turn[:, k:], count - len(above))

    found = np.linalg.qr(np.stack(split(a, np.eye(len(a)), min(want, len(a))), 1))[0]
    variances = np.einsum("ij,ij->j", found, a @ found)
    order = np.argsort(-variances, kind="stable")
    found = found[:, order]
    signs = np.sign(found[np.abs(found).argmax(0), np.arange(found.shape[1])])
    return variances[order], found * signs


# ---- operator ------------------------------------------------------------------------------------------------------

_RESULT = ("vec_id {id}, component int, n long, deviation long, whitened double, explained double, identity_error double")


def whiten(vectors: DataFrame, components: int = 8, vec_id: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """One row per usable vector and component, numbered from 1 by falling variance: `whitened` is the row's centred
    whole-number vector on the component, over its standard deviation; `explained` the component's share of the
    variance; `deviation` the row's exact squared distance from the mean, times n squared (NULL where it is beyond
    64 bits); `identity_error` how far the covariance of the whitened values is from the identity at most.

    Left out: NULL and empty vectors and those with NULL or non-finite entries; vectors of another length than
    most (of lengths as frequent, the longest stays); components without variance beyond rounding, so that a single vector, or
    equal ones, give no rows. NULL and repeated ids and rows are vectors like any other. An entry beyond 2^42 and
    vectors of more than MAX_DIMENSIONS entries are errors. An empty table gives no rows. Other columns are left alone.
    """
    plain = vectors.select(F.col(vec_id).alias("vec_id"), F.col(vector).alias("vector")).where(usable(F.col("vector")))
    schema = _RESULT.format(id=plain.schema["vec_id"].dataType.simpleString())
    nothing = plain.sparkSession.createDataFrame([], schema)
    n, total = sums(plain)
    if not n:
        return nothing
    centre = _Centre(n, total)
    covariance = _products(plain, centre)[1] / n
    variance = float(np.trace(covariance))
    found, basis = leading(covariance, components)
    real = found > len(total) * _EPS * max(found[0], 0.0) * 8
    found, basis = found[real], basis[:, real]
    if not len(found):
        return nothing
    weights = basis / np.sqrt(found)
    first, second = _products(plain, centre, weights)
    unlike = second / n - np.outer(first / n, first / n) - np.eye(len(found))
    error = float(np.abs(unlike).max())
    explained, dims, width = found / variance, len(total), len(found)
    names = [f.split()[0] for f in schema.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for rows, x in _matrices(batch.column(1)):
                if x.shape[1] != dims:
                    continue
                deviation = pa.array(centre.deviation(x), pa.int64())
                each = pa.array(np.repeat(np.arange(len(rows)), width))
                yield pa.RecordBatch.from_arrays([
                    batch.column(0).take(pa.array(rows)).take(each),
                    pa.array(np.tile(np.arange(1, width + 1, dtype=np.int32), len(rows))),
                    pa.array(np.full(len(each), n)), deviation.take(each),
                    pa.array((centre.centred(x) @ weights).ravel()),
                    pa.array(np.tile(explained, len(rows))), pa.array(np.full(len(each), error))], names)

    return plain.mapInArrow(run, schema)

"""Whitening of embeddings by incremental eigendecomposition.

A partition keeps the eigenpairs of the scatter matrix of the vectors it has seen. New
vectors enter as centred rank-one updates: the new eigenvalues are the roots of a secular
equation, weights and gaps that do not count are deflated. Spectra of partitions are
combined in the same way, eigenpair by eigenpair, in a tree. A last pass projects
all vectors on the combined basis and solves the small problem that is left (Rayleigh-Ritz)."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F

from lectern.llm.tables import written

EPS = np.finfo(float).eps
SCALE, SHIFT = 1024, 100_000
# rows whose scatter enters as the rows of its triangular factor; spectra that one task combines
BLOCK_ROWS = 512
FAN_IN = 8
_LARGEST = float(1 << 52)


# -- rank-one updates -----------------------------------------------------

def secular_roots(poles: np.ndarray, weights: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(roots, poles[j] - roots[i]) of ``1 + sum(weights / (poles - x))``, poles strictly rising, weights positive.

    Root i lies between pole i and the next one, the last beyond the last pole. Each is sought as
    its distance from the nearer pole, which keeps the differences exact to rounding. A
    step solves the equation with the poles to the left and to the right merged into the two
    neighbours; it is bisected where it would leave the bracket."""
    m = len(poles)
    rows = np.arange(m)
    gap = np.append(np.diff(poles), weights.sum())
    delta = poles[None, :] - poles[:, None]
    middle = 1 + (weights / (delta - gap[:, None] / 2)).sum(axis=1)
    near = (middle >= 0) | (rows == m - 1)
    origin = np.where(near, rows, np.minimum(rows + 1, m - 1))
    delta = poles[None, :] - poles[origin][:, None]
    low, high = np.where(near, 0.0, -gap / 2), np.where(near, gap / 2, 0.0)
    if middle[-1] < 0:
        low[-1], high[-1] = gap[-1] / 2, gap[-1]
    tau = (low + high) / 2
    left = np.tri(m, dtype=bool)
    after = np.minimum(rows + 1, m - 1)
    for _ in range(100):
        diff = delta - tau[:, None]
        terms = weights / diff
        f = 1 + terms.sum(axis=1)
        low, high = np.where(f < 0, tau, low), np.where(f > 0, tau, high)
        done = (np.abs(f) <= 2 * EPS * m * (1 + np.abs(terms).sum(axis=1))) | (high - low <= 2 * EPS * np.abs(tau))
        if done.all():
            break
        slopes = terms / diff
        total = slopes.sum(axis=1)
        dl, dr = diff[rows, rows], diff[rows, after]
        slope_l = np.where(left, slopes, 0).sum(axis=1)
        with np.errstate(all="ignore"):
            c = f - dl * slope_l - dr * (total - slope_l)
            b = (dl + dr) * f - dl * dr * total
            root = np.sqrt(np.abs(b * b - 4 * c * dl * dr * f))
            step = np.where(b <= 0, (b - root) / (2 * c), 2 * dl * dr * f / (b + root))
            step[-1] = dl[-1] * f[-1] / (f[-1] - dl[-1] * total[-1])
        new = tau + step
        inside = (new > low) & (new < high)
        tau = np.where(done, tau, np.where(inside, new, (low + high) / 2))
    return poles[origin] + tau, delta - tau[:, None]


def rank_one(values: np.ndarray, basis: np.ndarray, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Eigenpairs of ``basis @ diag(values) @ basis.T + x x.T``, values rising; the basis (dimensions
    times rank) gains a column where ``x`` has a part outside it."""
    size = np.linalg.norm(x)
    if not size:
        return values, basis
    z = basis.T @ x
    rest = x - basis @ z
    if basis.shape[1] < len(x):
        more = basis.T @ rest
        z, rest = z + more, rest - basis @ more
        outside = np.linalg.norm(rest)
        if outside > 8 * EPS * np.sqrt(len(x)) * size:
            basis = np.column_stack([rest / outside, basis])
            values, z = np.append(0.0, values), np.append(outside, z)
    weight = np.linalg.norm(z)
    least = 8 * EPS * max(values[-1], weight * weight)
    basis = basis.copy()
    for j in np.flatnonzero(np.diff(values) <= least):
        # equal poles: turn the two vectors so that one takes all the weight
        both = np.hypot(z[j], z[j + 1])
        if both:
            s, c = z[j] / both, z[j + 1] / both
            u, v = basis[:, j].copy(), basis[:, j + 1].copy()
            basis[:, j], basis[:, j + 1] = c * u - s * v, s * u + c * v
            z[j], z[j + 1] = 0.0, both
    live = np.abs(z) * weight > least
    if not live.any():
        return values, basis
    poles, own = values[live], z[live]
    roots, diff = secular_roots(poles, own * own)
    # weights for which the computed roots are exact keep the vectors orthogonal (Gu and Eisenstat)
    spread = poles[:, None] - poles[None, :]
    np.fill_diagonal(spread, 1.0)
    exact = np.sqrt(np.abs(np.prod(-diff / spread, axis=0)))
    turn = np.copysign(exact, own)[:, None] / diff.T
    basis[:, live] = basis[:, live] @ (turn / np.linalg.norm(turn, axis=0))
    values = values.copy()
    values[live] = roots
    order = np.argsort(values, kind="stable")
    return values[order], basis[:, order]


class Spectrum:
    """Count, mean and eigenpairs of the scatter matrix of some vectors."""

    def __init__(self, n: int, mean: np.ndarray, values: np.ndarray | None = None, basis: np.ndarray | None = None):
        self.n, self.mean = n, mean
        self.values = np.empty(0) if values is None else values
        self.basis = np.empty((len(mean), 0)) if basis is None else basis

    def combine(self, n: int, mean: np.ndarray, rows: np.ndarray) -> None:
        """Take in ``n`` vectors around ``mean`` whose scatter is ``rows.T @ rows``."""
        shift, total = mean - self.mean, self.n + n
        for x in (*rows, shift * np.sqrt(self.n * n / total)):
            self.values, self.basis = rank_one(self.values, self.basis, x)
        self.n, self.mean = total, self.mean + shift * (n / total)

    def add(self, block: np.ndarray) -> None:
        """Take in the rows of ``block``; many rows enter as their triangular factor."""
        mean = block.mean(axis=0)
        centred = block - mean
        self.combine(len(block), mean, np.linalg.qr(centred, mode="r") if len(block) > block.shape[1] else centred)


# -- passes over the vectors ----------------------------------------------

_SPECTRUM = "part long, n long, sums array<long>, mean array<double>, eigenvalues array<double>, basis array<double>"
_MATRIX = "part long, n long, matrix array<double>"


def _lists(columns: dict, schema: str) -> pa.RecordBatch:
    """One row of numbers and arrays."""
    arrays = []
    for name, value in columns.items():
        if isinstance(value, np.ndarray):
            arrays.append(pa.array([value.reshape(-1)], pa.list_(pa.int64() if value.dtype == np.int64 else pa.float64())))
        else:
            arrays.append(pa.array([value], pa.int64()))
    return pa.RecordBatch.from_arrays(arrays, names=list(columns))


def _blocks(batches: Iterator[pa.RecordBatch], width: int) -> Iterator[tuple[pa.Array, np.ndarray]]:
    """(ids, whole numbers) of some hundred vectors at a time."""
    for batch in batches:
        for start in range(0, batch.num_rows, BLOCK_ROWS):
            rows = batch.slice(start, BLOCK_ROWS)
            flat = rows.column(1).flatten().to_numpy(zero_copy_only=False).astype(np.float64)
            yield rows.column(0), np.floor(flat.reshape(-1, width) * SCALE).astype(np.int64) + SHIFT


def _spectra(width: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found, sums = Spectrum(0, np.zeros(width)), np.zeros(width, np.int64)
        for _, x in _blocks(batches, width):
            sums += x.sum(axis=0)
            found.add((x - SHIFT).astype(np.float64))  # the mean is needed for combining alone
        if found.n:
            part = TaskContext.get().partitionId()
            yield _lists({"part": part, "n": found.n, "sums": sums, "mean": found.mean, "eigenvalues": found.values, "basis": found.basis}, _SPECTRUM)

    return run


def _combine(rows: pa.Table) -> pa.Table:
    first, *others = rows.sort_by("part").to_pylist()
    width = len(first["mean"])
    found = Spectrum(first["n"], np.array(first["mean"]), np.array(first["eigenvalues"]), np.array(first["basis"]).reshape(width, -1))
    sums = np.array(first["sums"], np.int64)
    for row in others:
        basis = np.array(row["basis"]).reshape(width, -1)
        found.combine(row["n"], np.array(row["mean"]), (basis * np.sqrt(np.maximum(row["eigenvalues"], 0))).T)
        sums += np.array(row["sums"], np.int64)
    columns = {"part": first["part"] // FAN_IN, "n": found.n, "sums": sums, "mean": found.mean, "eigenvalues": found.values, "basis": found.basis}
    return pa.Table.from_batches([_lists(columns, _SPECTRUM)])


def _add(rows: pa.Table) -> pa.Table:
    rows = rows.sort_by("part")
    total = np.sum([np.asarray(m.values) for m in rows["matrix"]], axis=0)
    return pa.Table.from_batches([_lists({"part": rows["part"][0].as_py() // FAN_IN, "n": sum(rows["n"].to_pylist()), "matrix": total}, _MATRIX)])


def _folded(parts: DataFrame, combine: Callable[[pa.Table], pa.Table], name: str) -> dict | None:
    """One row from those of all tasks, ``FAN_IN`` at a time in the order of the tasks."""
    level = written(parts, name)
    while (n := level.count()) > 1:
        level = written(level.groupBy(F.expr(f"part div {FAN_IN}")).applyInArrow(combine, level.schema), name)
    return level.first().asDict() if n else None


def _centred(x: np.ndarray, n: int, sums: np.ndarray) -> np.ndarray:
    """``n * x - sums`` in whole numbers, which stay small as they are taken from near the mean."""
    near = sums // n
    return n * (x - near) - (sums - n * near)


def _gram(width: int, n: int, sums: np.ndarray, axes: np.ndarray):
    """The products of the centred vectors' coordinates on ``axes``, summed over a task, under a row of their sums."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, rows = np.zeros((axes.shape[1] + 1, axes.shape[1])), 0
        for _, x in _blocks(batches, width):
            y = (_centred(x, n, sums) / n) @ axes
            held[0] += y.sum(axis=0)
            held[1:] += y.T @ y
            rows += len(x)
        if rows:
            yield _lists({"part": TaskContext.get().partitionId(), "n": rows, "matrix": held}, _MATRIX)

    return run


def _deviations(y: np.ndarray) -> pa.Array:
    """Sums of squares; null where one does not fit a long."""
    if y.size and float(np.abs(y).max()) ** 2 * y.shape[1] >= 2.0**62:
        return pa.array([s if s < 1 << 63 else None for s in (sum(int(v) ** 2 for v in row) for row in y)], pa.int64())
    return pa.array((y * y).sum(axis=1), pa.int64())


def _project(width: int, n: int, sums: np.ndarray, axes: np.ndarray, explained: np.ndarray, error: float):
    k = axes.shape[1]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for ids, x in _blocks(batches, width):
            y, m = _centred(x, n, sums), len(x)
            rows = pa.array(np.repeat(np.arange(m), k))
            yield pa.RecordBatch.from_arrays(
                [
                    ids.take(rows), pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), m)), pa.array(np.full(m * k, n)),
                    _deviations(y).take(rows), pa.array(((y / n) @ axes).reshape(-1)), pa.array(np.tile(explained, m)),
                    pa.array(np.full(m * k, error)),
                ],
                names=["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"],
            )

    return run


_WHITENED = "component int, n long, deviation long, whitened double, explained double, identity_error double"


def usable(vectors: DataFrame, key: str = "vec_id", vec: str = "embedding") -> DataFrame:
    """(vec_id, embedding) of the vectors that are not null and hold finite entries only."""
    entry = F.col(vec)
    finite = F.forall(entry, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < _LARGEST / SCALE))
    return vectors.select(F.col(key).alias("vec_id"), entry.alias("embedding")).filter(entry.isNotNull() & (F.size(entry) > 0) & finite)


def whiten(vectors: DataFrame, components: int = 8, key: str = "vec_id", vec: str = "embedding") -> DataFrame:
    """(vec_id, component, n, deviation, whitened, explained, identity_error) of every usable row and of the
    ``components`` directions of most variance, numbered from 1.

    An entry c is the whole number ``floor(1024 * c) + 100000``. The covariance has the divisor n, the number of
    usable rows. ``deviation`` is the exact sum of ``(n * x - sum) ** 2``, null where that does not fit a long;
    ``explained`` a direction's share of the variance; ``identity_error`` the largest entry of the covariance of all
    whitened rows that differs from the identity, measured over them.

    Rows whose vector is null, empty or holds a null, a NaN or an entry beyond 2**42 are left out, and so are
    those of another length than most have (of equal counts, the longer). Repeated ids and rows are rows of their own.
    Directions without variance, to rounding, are not returned: equal vectors, or a single one, give no
    rows, as does an empty table. Other columns are not read.

    Blocks of ``BLOCK_ROWS`` rows enter a partition's spectrum as the rows of their triangular factor, which have the same
    scatter, so the cost of a rank-one update is paid per dimension and block. A task holds a square matrix of
    the dimensions, and a combining task ``FAN_IN`` of them; the driver the last one."""
    rows = usable(vectors, key, vec)
    widths = rows.groupBy(F.size("embedding").alias("width")).agg(F.count("*").alias("n"))
    top = widths.orderBy(F.col("n").desc(), F.col("width").desc()).first()
    schema = f"vec_id {rows.schema['vec_id'].dataType.simpleString()}, {_WHITENED}"
    none = vectors.sparkSession.createDataFrame([], schema)
    if top is None:
        return none
    width = top["width"]
    rows = rows.filter(F.size("embedding") == width)
    found = _folded(rows.mapInArrow(_spectra(width), _SPECTRUM), _combine, "spectra")
    n, sums = found["n"], np.array(found["sums"], np.int64)
    basis = np.array(found["basis"]).reshape(width, -1)
    if not basis.shape[1]:
        return none
    basis, _ = np.linalg.qr(basis)
    gram = _folded(rows.mapInArrow(_gram(width, n, sums, basis), _MATRIX), _add, "ritz")
    values, turn = np.linalg.eigh(np.array(gram["matrix"]).reshape(-1, basis.shape[1])[1:] / n)
    falling = np.argsort(-values, kind="stable")
    values, axes = values[falling], (basis @ turn)[:, falling]
    k = min(components, int((values > width * EPS * values[0]).sum())) if values[0] > 0 else 0
    if not k:
        return none
    explained, axes = values[:k] / values.sum(), axes[:, :k] / np.sqrt(values[:k])
    checked = _folded(rows.mapInArrow(_gram(width, n, sums, axes), _MATRIX), _add, "identity")
    matrix = np.array(checked["matrix"]).reshape(-1, k) / n
    error = float(np.abs(matrix[1:] - np.outer(matrix[0], matrix[0]) - np.eye(k)).max())
    return rows.mapInArrow(_project(width, n, sums, axes, explained, error), schema)

"""Embedding whitening by shifted CholeskyQR.

The centred rows A are orthogonalised without being moved: a distributed pass sums the Gram matrix of A R^-1, its
(shifted) Cholesky factor multiplies R from the left, and the next pass solves the rows against the new R. After the
last pass A = Q R with orthonormal Q; the singular vectors of the small R are the components, its singular values their
deviations.
"""

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from millrace.llm import vectors as V
from millrace.session import work_folder

#: Integers are held within this on either side, before ``OFFSET`` is added.
MOST = 1 << 30
OFFSET = 1_000_000
PASSES = 3

_BLOCK = "vec_id array<long>, dims int, x binary"
_EPS = float(np.finfo(np.float64).eps)


def _integer_blocks(batches, factor):
    for ids, _, x in V.pieces(batches, factor, MOST):
        yield pa.RecordBatch.from_arrays([V.as_list(ids), pa.array([x.shape[1]], pa.int32()),
                                          pa.array([(x + OFFSET).astype(np.int32).tobytes()])], ["vec_id", "dims", "x"])


def _blocks(batches, dims):
    """(ids, integers) of each block; None for integers of another dimension."""
    for batch in batches:
        for i, row in enumerate(batch.select(["dims", "x"]).to_pylist()):
            ids = batch.column("vec_id")[i].values
            x = np.frombuffer(row["x"], np.int32).astype(np.int64).reshape(len(ids), row["dims"])
            yield ids, x if row["dims"] == dims else None


def _summed(spark, blocks, size, partial):
    """Sum over all tasks of the matrix (``size`` columns) that ``partial`` makes of a task's batches. One row of the matrix
    per task and row number is shuffled; the driver gets the sum alone, whose size is that of the dimensions."""
    def rows(batches):
        total = partial(batches)
        if total is not None:
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(total), dtype=np.int32)),
                                              pa.array(total.tolist(), pa.list_(kind))], ["i", "v"])
    kind = pa.int64() if partial.exact else pa.float64()
    parts = blocks.mapInArrow(rows, f"i int, v array<{'long' if partial.exact else 'double'}>")
    total = parts.groupBy("i").agg(F.array(*[F.sum(F.get("v", F.lit(j))) for j in range(size)]).alias("v"))
    return {r["i"]: r["v"] for r in total.collect()}


class _Sums:
    """Row count and sums of every dimension, exact."""

    exact = True

    def __init__(self, dims):
        self.dims = dims

    def __call__(self, batches):
        total = None
        for _, x in _blocks(batches, self.dims):
            if x is not None:
                own = np.concatenate(([[len(x)]], [x.sum(axis=0)]), axis=1)
                total = own if total is None else total + own
        return total


class Centre:
    """The fit list's count and sums, exact; rows are centred before anything is multiplied."""

    def __init__(self, n, sums):
        self.n, self.sums = n, sums
        self.base = np.array([s // n for s in sums], np.int64)
        self.rest = np.array([s % n for s in sums], np.int64)

    def __call__(self, x):
        """``x - S / n``: the whole part is taken off exactly, so only the result is rounded."""
        return (x - self.base) - self.rest / self.n

    def deviations(self, x):
        """Sum over the dimensions of ``(n * x - S) ** 2``; None for a row whose sum passes 64 bits."""
        gap = x - self.base
        furthest = int(np.abs(gap).max(initial=0)) * self.n + self.n
        if furthest * furthest * max(1, x.shape[1]) < 1 << 63:
            return np.square(self.n * gap - self.rest).sum(axis=1).tolist()
        sums = (sum((self.n * g - r) ** 2 for g, r in zip(row, self.rest.tolist(), strict=True)) for row in gap.tolist())
        return [s if s < 1 << 63 else None for s in sums]


class _Gram:
    """Gram matrix of the centred rows, after ``solve`` if given."""

    exact = False

    def __init__(self, centre, dims, solve=None):
        self.centre, self.dims, self.solve = centre, dims, solve

    def __call__(self, batches):
        total = None
        for _, x in _blocks(batches, self.dims):
            if x is not None:
                rows = self.centre(x)
                rows = rows if self.solve is None else self.solve(rows)
                own = rows.T @ rows
                total = own if total is None else total + own
        return total


def solve_rows(rows, r):
    """``rows @ inv(r)`` by substitution, for an upper triangular ``r``."""
    out = np.empty_like(rows)
    for j in range(r.shape[0]):
        out[:, j] = (rows[:, j] - out[:, :j] @ r[:j, j]) / r[j, j]
    return out


def shifted_cholesky(gram, n):
    """Upper triangular R with R'R = gram + s I: s is 0 where the plain factor exists and is well conditioned, else the usual
    bound on the rounding of a Gram matrix of ``n`` rows, at most 1e-10 of its norm if that suffices. A shift turns no
    component; the next pass leaves of it the product of both shifts."""
    d = len(gram)
    norm = float(np.linalg.norm(gram, 2))
    if not norm:
        return np.eye(d)
    try:
        factor = np.linalg.cholesky(gram).T
        if np.abs(np.diag(factor)).min() > 1e-3 * np.sqrt(norm):
            return factor
    except np.linalg.LinAlgError:
        pass
    shift = min(11 * (n * d + d * (d + 1)) * _EPS, 1e-10)
    while True:
        try:
            return np.linalg.cholesky(gram + shift * norm * np.eye(d)).T
        except np.linalg.LinAlgError:
            shift *= 10


class _Solve:
    def __init__(self, factors):
        self.factors = factors

    def __call__(self, rows):
        for r in self.factors:
            rows = solve_rows(rows, r)
        return rows


class _Project:
    """Whitened values: centred rows on the components, over their deviations."""

    def __init__(self, axes, deviations):
        self.axes = axes / np.where(deviations > 0, deviations, np.inf)

    def __call__(self, rows):
        return rows @ self.axes


class Whitening:
    """A fit: ``centre``, ``axes`` (unit components in columns, by falling ``variances``), ``explained`` shares of the total
    variance, ``identity_error`` of the covariance of the whitened values, over the first ``kept`` components. A component
    without variance has variance 0."""

    def __init__(self, centre, axes, variances, trace, kept):
        self.centre, self.kept = centre, min(kept, len(variances))
        self.axes, self.variances = axes[:, :self.kept], variances[:self.kept]
        self.trace, self.identity_error = trace, None
        self.drop(self.variances <= 0)

    def drop(self, silent):
        """Take the variance of some components for 0."""
        self.variances = np.where(silent, 0, self.variances)
        self.explained = self.variances / self.trace if self.trace else np.full(self.kept, np.nan)
        self.project = _Project(self.axes, np.sqrt(self.variances))


def _fit(spark, blocks, dims, kept):
    sums = _summed(spark, blocks, dims + 1, _Sums(dims))[0]
    centre = Centre(sums[0], sums[1:])

    def gram(size, solve):
        found = _summed(spark, blocks, size, _Gram(centre, dims, solve))
        total = np.array([found[i] for i in range(size)], np.float64).reshape(size, size)
        return (total + total.T) / 2

    factors, composed, trace = [], np.eye(dims), 0.0
    for number in range(PASSES):
        g = gram(dims, _Solve(list(factors)) if factors else None)
        if not number:
            trace = float(np.trace(g)) / centre.n
        factors.append(shifted_cholesky(g, centre.n))
        composed = factors[-1] @ composed
    _, spread, turned = np.linalg.svd(composed)
    if not trace:
        spread = np.zeros(dims)
    model = Whitening(centre, turned.T, np.square(spread) / centre.n, trace, kept)
    if trace:
        g = gram(model.kept, model.project) / centre.n
        # What shifts or rounding alone hold up has no variance of its own.
        model.drop((np.diag(g) < 0.5) | (spread[:model.kept] <= 64 * dims * _EPS * spread[0]))
        real = model.variances > 0
        model.identity_error = float(np.abs((g - np.eye(model.kept))[np.ix_(real, real)]).max())
    return model


_ROWS = ("vec_id long, component int, n long, deviation long, whitened double, explained double, identity_error double")


def _whitened(batches, model, dims):
    kept, n = model.kept, model.centre.n
    silent, error = model.variances <= 0, pa.array([model.identity_error], pa.float64())
    for ids, x in _blocks(batches, dims):
        size = len(ids)
        each = pa.array(np.repeat(np.arange(size), kept))
        if x is None:
            deviation, whitened = pa.nulls(size, pa.int64()), pa.nulls(size * kept, pa.float64())
        else:
            deviation = pa.array(model.centre.deviations(x), pa.int64())
            whitened = pa.array(model.project(model.centre(x)).ravel(), pa.float64(), mask=np.tile(silent, size))
        yield pa.RecordBatch.from_arrays(
            [ids.take(each), pa.array(np.tile(np.arange(1, kept + 1, dtype=np.int32), size)),
             pa.array(np.full(size * kept, n, np.int64)), deviation.take(each), whitened,
             pa.array(np.tile(model.explained, size), from_pandas=True), error.take(pa.array(np.zeros(size * kept, np.int64)))],
            [c.split()[0] for c in _ROWS.split(", ")])


def whiten(vectors: DataFrame, components: int = 32, factor: int = 64):
    """(rows, :class:`Whitening`): for every usable row of ``vectors`` (``vec_id``, ``embedding``) and each of the first
    ``components`` components ``vec_id, component, n, deviation, whitened, explained, identity_error``.

    Components of a vector become ``floor(factor * c) + 1000000``; all usable vectors are the fit list. ``n`` and
    ``deviation`` are exact; ``deviation`` is null where it passes 64 bits. The covariance has divisor ``n``. Fewer
    dimensions than ``components`` give as many components as dimensions.

    Rows whose vector is null or holds null or non-finite components go. The dimension is that of the smallest id; rows of
    another one take no part in the fit and come back with null ``deviation`` and ``whitened``. A component without
    variance (constant dimensions, fewer distinct rows than dimensions, a single row) has null ``whitened``, ``explained`` 0
    (null if nothing varies) and no part in ``identity_error``, which is null if none is left. Null and repeated ids
    and repeated rows are rows of their own; other columns are ignored; an empty table gives no rows. Integers are held
    within 2 ** 30 on either side.

    The integers are written once to the folder of ``spark.checkpoint.dir`` and read six times. Each pass shuffles one matrix
    of the dimensions per task and brings their sum to the driver.
    """
    spark = vectors.sparkSession
    rows = V.finite(vectors)
    first = V.smallest(rows, 1)
    if not first:
        return spark.createDataFrame([], _ROWS), None
    dims = len(first[0])
    folder = work_folder(spark, "whitening")
    rows.mapInArrow(lambda b: _integer_blocks(b, factor), _BLOCK).write.parquet(folder)
    blocks = spark.read.schema(_BLOCK).parquet(folder)
    if not dims:
        return spark.createDataFrame([], _ROWS), None
    model = _fit(spark, blocks, dims, components)
    return blocks.mapInArrow(lambda b: _whitened(b, model, dims), _ROWS), model

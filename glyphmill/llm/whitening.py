"""Embedding whitening by Chebyshev-filtered subspace iteration.

The covariance is never built. One pass over the vectors gives ``V Q`` for a narrow block ``Q``: each task
multiplies its centred rows ``X`` as ``Xᵀ(X Q)``, and the tasks' blocks are summed. A round filters the
block by a Chebyshev polynomial of ``V`` that stays small on the unwanted part of the spectrum, which takes
one pass for each degree, makes it orthonormal by QR, and solves the small projected problem
(Rayleigh-Ritz). Rounds go on until the residuals ``V u - e u`` certify the components.

Vectors become integers, and each distinct one counts once. Sums are exact integers. Rows that hold a NULL
or a number that is not finite, and empty or NULL vectors, take no part. Only vectors of the most common
length do (of two such lengths the greater). Components without variance do not exist, so there may be
fewer than asked for, down to none for an empty table or equal vectors.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from glyphmill.llm.columns import own_name, put
from glyphmill.llm.vector_blocks import matrix, usable
from glyphmill.session import write_table

COMPONENTS = 16
# Further columns of the block: the filter separates the wanted components from what lies beyond these.
GUARDS = 16
DEGREE = 12
# Natural logarithm of how much more a filter may amplify the greatest eigenvalue than the unwanted ones.
MOST_GROWTH = 24.0
# Passes that estimate where the spectrum ends.
LANCZOS_STEPS = 10
# Residuals relative to the greatest eigenvalue: the goal, and what is accepted when rounding stops progress.
GOAL, ACCEPTED = 2e-15, 1e-11
MOST_ROUNDS = 100
# A vector of integers becomes ``floor(SCALE * entry) + OFFSET``; entries count as at most ``LARGEST``.
SCALE, OFFSET, LARGEST = 64.0, 1_000_000, 2.0**53
BLOCK_BYTES = 2 << 20
# The block of components is a constant of each task; vectors beyond this length are refused.
MOST_DIMENSIONS = 1 << 14
# Sums of tasks are added up in so many groups before the driver adds those.
GROUPS = 64
LIMB = 24


@dataclass(frozen=True)
class WhiteningModel:
    """Fit over ``n`` distinct integer vectors of length ``dim``: exact ``sums``, components as columns."""

    dim: int
    n: int
    sums: tuple[int, ...]
    components: np.ndarray
    eigenvalues: np.ndarray
    trace: float
    residual: float
    rounds: int
    identity_error: float

    def centre(self) -> tuple[np.ndarray, np.ndarray]:
        """Mean as nearest integers and what is left of it."""
        return centre_of(self.n, self.sums)


def centre_of(n: int, sums: tuple[int, ...]) -> tuple[np.ndarray, np.ndarray]:
    whole = [(2 * s + n) // (2 * n) for s in sums]
    rest = [(s - w * n) / n for s, w in zip(sums, whole)]
    return np.array(whole, np.int64), np.array(rest, np.float64)


def integers(vector: Column) -> Column:
    """``floor(SCALE * entry) + OFFSET`` of each entry."""

    def one(entry: Column) -> Column:
        scaled = F.greatest(F.least(entry.cast("double") * SCALE, F.lit(LARGEST)), F.lit(-LARGEST))
        return F.floor(scaled) + F.lit(OFFSET).cast("bigint")

    return F.transform(vector, one)


def pack_integers(vectors: DataFrame, dim: int) -> DataFrame:
    """``(data)`` of a column of integer arrays of length ``dim``: blocks of bounded bytes, row after row."""
    rows = max(1, BLOCK_BYTES // (8 * dim))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, count = [], 0

        def block() -> pa.RecordBatch:
            data = np.concatenate(held)
            return pa.RecordBatch.from_arrays([pa.array([data.tobytes()], pa.binary())], names=["data"])

        for batch in batches:
            part = matrix(batch.column(0), dim)
            for i in range(0, len(part), rows):
                held.append(part[i : i + rows])
                count += len(held[-1])
                if count >= rows:
                    yield block()
                    held, count = [], 0
        if held:
            yield block()

    return vectors.mapInArrow(run, "data binary")


def add_up(blocks: DataFrame, dim: int, kind: type, function: Callable[[np.ndarray], np.ndarray]) -> np.ndarray | None:
    """Sum over all blocks of an array that ``function`` makes of each; None if there are no blocks.

    Each task adds up its own blocks. Many tasks are added in ``GROUPS`` groups, so the driver gets a
    bounded number of arrays.
    """

    def one_task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        total = None
        for batch in batches:
            for data in batch.column(0):
                rows = np.frombuffer(data.as_buffer(), np.int64).reshape(-1, dim)
                total = function(rows) if total is None else total + function(rows)
        if total is not None:
            group = TaskContext.get().partitionId() % GROUPS
            columns = [pa.array([group], pa.int32()), pa.array([total.astype(kind).tobytes()], pa.binary())]
            yield pa.RecordBatch.from_arrays(columns, names=["part", "total"])

    def one_group(table: pa.Table) -> pa.Table:
        total = sum(np.frombuffer(t.as_buffer(), kind) for t in table.column("total"))
        return pa.table({"part": table.column("part")[:1], "total": pa.array([total.tobytes()], pa.binary())})

    schema = "part int, total binary"
    totals = blocks.mapInArrow(one_task, schema)
    if blocks.rdd.getNumPartitions() > GROUPS:
        totals = totals.groupBy("part").applyInArrow(one_group, schema)
    found = [np.frombuffer(row["total"], kind) for row in totals.collect()]
    return sum(found) if found else None


def exact_sums(blocks: DataFrame, dim: int) -> tuple[int, tuple[int, ...]]:
    """Number of rows and exact sum of each column, by limbs of ``LIMB`` bits whose sums fit 64 bits."""

    def limbs(rows: np.ndarray) -> np.ndarray:
        low = (1 << LIMB) - 1
        parts = [rows & low, (rows >> LIMB) & low, rows >> (2 * LIMB)]
        return np.concatenate([[len(rows)], *[p.sum(axis=0) for p in parts]])

    total = add_up(blocks, dim, np.int64, limbs)
    if total is None:
        return 0, ()
    low, middle, high = (total[1:].reshape(3, dim)[i].tolist() for i in range(3))
    return int(total[0]), tuple(a + (b << LIMB) + (c << 2 * LIMB) for a, b, c in zip(low, middle, high))


class Covariance:
    """Passes over the packed vectors, centred by their exact mean before any product."""

    def __init__(self, blocks: DataFrame, dim: int, n: int, sums: tuple[int, ...]):
        self.blocks, self.dim, self.n = blocks, dim, n
        self.whole, self.rest = centre_of(n, sums)
        self.passes = 0

    def _add_up(self, q: np.ndarray, function: Callable[[np.ndarray, np.ndarray], np.ndarray]) -> np.ndarray:
        """Sum of ``function(centred rows, q)`` over all blocks."""
        whole, rest = self.whole, self.rest
        shared: object = self.blocks.sparkSession.sparkContext.broadcast(q)
        try:
            total = add_up(
                self.blocks, self.dim, np.float64, lambda rows: function((rows - whole).astype(np.float64) - rest, shared.value).ravel()
            )
        finally:
            shared.unpersist()
        self.passes += 1
        return total

    def times(self, q: np.ndarray) -> np.ndarray:
        """``V q``: one pass."""
        return self._add_up(q, lambda x, q: x.T @ (x @ q)).reshape(q.shape) / self.n

    def trace(self) -> float:
        return float(self._add_up(np.zeros((self.dim, 0)), lambda x, q: np.square(x).sum(keepdims=True))[0]) / self.n

    def identity_error(self, projection: np.ndarray) -> float:
        """Largest entry of the covariance of the projected vectors minus the identity."""

        def moments(x: np.ndarray, p: np.ndarray) -> np.ndarray:
            z = x @ p
            return np.vstack([z.T @ z, z.sum(axis=0)])

        total = self._add_up(projection, moments).reshape(-1, projection.shape[1]) / self.n
        found = total[:-1] - np.outer(total[-1], total[-1])
        return float(np.abs(found - np.eye(len(found))).max())


def lowest_eigenvalue(times: Callable[[np.ndarray], np.ndarray], dim: int, steps: int = LANCZOS_STEPS, seed: int = 8) -> float:
    """A number that the smallest eigenvalue is very likely not below, by a few Lanczos steps from a random vector.

    It only sets where the filter damps: were it too high, the filter would be slower and no result other.
    """
    v = np.random.default_rng(seed).standard_normal((dim, 1))
    basis = v / np.linalg.norm(v)
    diagonal, beside = [], []
    for _ in range(min(steps, dim)):
        w = times(basis[:, -1:])
        diagonal.append(float(basis[:, -1] @ w[:, 0]))
        for _ in range(2):
            w = w - basis @ (basis.T @ w)
        beside.append(float(np.linalg.norm(w)))
        if beside[-1] <= 1e-10 * max(diagonal):
            break
        basis = np.hstack([basis, w / beside[-1]])
    small = np.diag(diagonal) + np.diag(beside[:-1], 1) + np.diag(beside[:-1], -1)
    return max(0.0, float(np.linalg.eigvalsh(small)[0]) - beside[-1])


def chebyshev_filter(
    times: Callable[[np.ndarray], np.ndarray], q: np.ndarray, low: float, cut: float, top: float, degree: int
) -> np.ndarray:
    """Block after a Chebyshev polynomial that is at most 1 in size on ``[low, cut]``, scaled to 1 at ``top``."""
    half, middle = (cut - low) / 2, (cut + low) / 2
    sigma = first = half / (top - middle)
    before, now = q, (times(q) - middle * q) * (sigma / half)
    for _ in range(degree - 1):
        following = 1 / (2 / first - sigma)
        before, now = now, (times(now) - middle * now) * (2 * following / half) - (sigma * following) * before
        sigma = following
    return now


def leading_components(
    times: Callable[[np.ndarray], np.ndarray], dim: int, wanted: int, guards: int = GUARDS, degree: int = DEGREE, seed: int = 7
) -> tuple[np.ndarray, np.ndarray, float, int]:
    """Greatest eigenvalues of a positive semidefinite operator, their vectors, the residual and the rounds.

    The residual is the greatest norm of ``V u - e u`` over the wanted components, relative to the
    greatest eigenvalue. Not reaching ``ACCEPTED`` is an error.
    """
    wanted = min(wanted, dim)
    width = min(dim, wanted + guards)
    q, _ = np.linalg.qr(np.random.default_rng(seed).standard_normal((dim, width)))
    lowest = lowest_eigenvalue(times, dim) if width < dim else 0.0
    best = np.inf
    for rounds in range(1, MOST_ROUNDS + 1):
        image = times(q)
        small = q.T @ image
        values, turn = np.linalg.eigh((small + small.T) / 2)
        values, turn = values[::-1], turn[:, ::-1]
        q, image = q @ turn, image @ turn
        top = max(float(values[0]), 0.0)
        if top == 0.0:
            return np.zeros(0), np.zeros((dim, 0)), 0.0, rounds
        residual = float(np.linalg.norm(image - q * values, axis=0)[:wanted].max()) / top
        # Rounding ends the progress somewhere near the goal.
        if residual <= GOAL or (residual <= ACCEPTED and residual > best / 2):
            return values[:wanted], q[:, :wanted], residual, rounds
        best = min(best, residual)
        cut = min(max(float(values[-1]), 1e-12 * top), 0.999 * top)
        low = min(lowest, 0.99 * cut)
        # The polynomial is about exp(degree * acosh(x)) / 2: beyond MOST_GROWTH rounding drowns small columns.
        reach = np.arccosh((2 * top - cut - low) / (cut - low))
        q, _ = np.linalg.qr(chebyshev_filter(times, q, low, cut, top, int(max(1, min(degree, MOST_GROWTH // reach)))))
    raise RuntimeError(f"components are not certified after {MOST_ROUNDS} rounds: residual {residual}")


def fit_whitening(vectors: DataFrame, components: int = COMPONENTS, vector: str = "embedding") -> WhiteningModel | None:
    """Fit of all usable vectors of the most common length; None if there is none.

    Distinct vectors are shuffled once and written in blocks; each pass reads these. Equal vectors meet in
    the map side of that shuffle, so a very common one is no hot key.
    """
    entries = vectors.select(vectors[f"`{vector}`"].alias("v")).filter(usable(F.col("v")))
    lengths = entries.groupBy(F.size("v").alias("dim")).count().orderBy(F.desc("count"), F.desc("dim")).limit(1).collect()
    if not lengths:
        return None
    dim = lengths[0]["dim"]
    if dim > MOST_DIMENSIONS:
        raise ValueError(f"vectors have at most {MOST_DIMENSIONS} entries")
    distinct = entries.filter(F.size("v") == dim).select(integers(F.col("v")).alias("x")).distinct()
    blocks = write_table(pack_integers(distinct, dim), "whitening")
    n, sums = exact_sums(blocks, dim)
    passes = Covariance(blocks, dim, n, sums)
    trace = passes.trace()
    nothing = np.zeros(0), np.zeros((dim, 0)), 0.0, 0
    values, axes, residual, rounds = leading_components(passes.times, dim, components) if trace > 0 else nothing
    there = values > dim * np.finfo(np.float64).eps * trace
    values, axes = values[there], axes[:, there]
    axes = axes * np.where(axes[np.abs(axes).argmax(axis=0), np.arange(axes.shape[1])] < 0, -1.0, 1.0) if len(values) else axes
    error = passes.identity_error(axes / np.sqrt(values)) if len(values) else 0.0
    return WhiteningModel(dim, n, sums, axes, values, trace, residual, rounds, error)


def deviations(rows: np.ndarray, n: int, sums: np.ndarray | list[int]) -> list[int | None]:
    """Sum over the entries of ``(n x - sum)²`` of each row, exact; None beyond 38 digits."""
    largest = n * int(np.abs(rows).max(initial=0)) + max(map(abs, sums), default=0)
    if largest < 1 << 62:
        far = rows * np.int64(n) - np.array(sums, np.int64)
        if rows.shape[1] * int(np.abs(far).max(initial=0)) ** 2 < 1 << 63:
            return np.square(far).sum(axis=1).tolist()
    exact = [sum((n * x - s) ** 2 for x, s in zip(row, sums)) for row in rows.tolist()]
    return [e if e < 10**38 else None for e in exact]


def apply_whitening(vectors: DataFrame, model: WhiteningModel, vector: str = "embedding", out: str = "whitening") -> DataFrame:
    """Add ``out``, a struct of ``deviation DECIMAL(38,0)`` and ``whitened ARRAY<DOUBLE>``, a number for each component.

    NULL where the vector takes no part. All other columns stay, one named ``out`` is replaced. A map
    without a shuffle; repeated vectors get equal results.
    """
    whole, rest = model.centre()
    projection = model.components / np.sqrt(model.eigenvalues)
    dim, n, sums = model.dim, model.n, list(model.sums)
    width = projection.shape[1]
    kind = pa.struct([("deviation", pa.decimal128(38, 0)), ("whitened", pa.list_(pa.float64()))])
    shared = vectors.sparkSession.sparkContext.broadcast(projection)

    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for lists in batches:
            there = lists.is_valid()
            rows = matrix(lists.drop_null(), dim)
            z = ((rows - whole).astype(np.float64) - rest) @ shared.value
            ends = np.arange(len(rows) + 1, dtype=np.int32) * width
            columns = [
                pa.array(deviations(rows, n, sums), pa.decimal128(38, 0)),
                pa.ListArray.from_arrays(pa.array(ends), pa.array(z.ravel(), pa.float64())),
            ]
            made = pa.StructArray.from_arrays(columns, fields=list(kind))
            place = np.cumsum(there.to_numpy(zero_copy_only=False)) - 1
            yield made.take(pa.array(place, mask=~there.to_numpy(zero_copy_only=False)))

    value = vectors[f"`{vector}`"]
    fits = usable(value) & (F.size(value) == dim)
    udf = F.arrow_udf(run, "struct<deviation: decimal(38,0), whitened: array<double>>").asNondeterministic()
    return put(vectors, {out: udf(F.when(fits, integers(value)))})


def whitened_components(
    spark: SparkSession, vectors: DataFrame, components: int = COMPONENTS, vec_id: str = "vec_id", vector: str = "embedding"
) -> DataFrame:
    """One row per usable vector and component, with the figures of the fit.

    ``deviation`` is NULL where it does not fit a BIGINT.
    """
    schema = (
        "vec_id bigint, component int, n bigint, deviation bigint, whitened double, explained double, identity_error double"
    )
    model = fit_whitening(vectors, components, vector)
    if model is None or not len(model.eigenvalues):
        return spark.createDataFrame([], schema)
    made = own_name(vectors, "whitening")
    rows = apply_whitening(vectors.select(vec_id, vector), model, vector, made).filter(F.col(made).isNotNull())
    explained = F.array(*[F.lit(float(e / model.trace)) for e in model.eigenvalues])
    return rows.select(
        F.col(vec_id).cast("bigint").alias("vec_id"),
        F.expr(f"try_cast({made}.deviation AS bigint)").alias("deviation"),
        F.posexplode(f"{made}.whitened").alias("place", "whitened"),
    ).select(
        "vec_id",
        (F.col("place") + 1).alias("component"),
        F.lit(model.n).cast("bigint").alias("n"),
        "deviation",
        "whitened",
        F.get(explained, F.col("place")).alias("explained"),
        F.lit(model.identity_error).alias("identity_error"),
    )

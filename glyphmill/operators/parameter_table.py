"""Softmax regression whose parameters and optimizer moments are a table.

Features are cut into pieces, and the table has one row per piece: the weights of all classes for it, with
both moments. A step multiplies the tiles of the data with the weights of their piece, adds up the pieces of
each block of rows to logits, turns these into residuals, and multiplies residuals with tiles to gradients,
which are added up in a tree. The update joins gradients and parameters on the piece. The driver gets the
loss, the number of rows and the norm of the gradient, never a parameter.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from glyphmill.operators.fit import Settings, rate_at
from glyphmill.operators.tiles import TILE_BYTES, TILE_WIDTH, Tiles, add_tiles, cut_tiles
from glyphmill.schemas import TRACE
from glyphmill.session import local_table, write_table
from glyphmill.sources import state

# Parameters up to so many bytes are broadcast; more are shuffled to the tiles of their piece.
BROADCAST_BYTES = 32 << 20
# Blocks of one piece that meet its parameters in one group of the join.
BLOCKS_PER_GROUP = 64
# Kinds of numbers a step brings to the driver.
TOTALS = "loss double, n bigint"


@dataclass(frozen=True)
class ParameterTable:
    """``rows`` are ``(piece, w, m, v)``: for each piece the numbers of all classes, class after class."""

    rows: DataFrame
    n_classes: int
    width: int
    piece_width: int
    step: int = 0
    trace: tuple[tuple[int, float, float, float], ...] = field(default=())

    def weights(self) -> DataFrame:
        """``(class, idx, value)`` in long form."""
        n_classes, piece_width = self.n_classes, self.piece_width

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for r in range(batch.num_rows):
                    w = _numbers(batch, "w", r).reshape(n_classes, -1)
                    kind, idx = np.divmod(np.arange(w.size), w.shape[1])
                    at = batch.column("piece")[r].as_py() * piece_width
                    columns = [pa.array(kind, pa.int32()), pa.array(at + idx, pa.int32()), pa.array(w.ravel())]
                    yield pa.RecordBatch.from_arrays(columns, names=["class", "idx", "value"])

        return self.rows.select("piece", "w").mapInArrow(run, "class int, idx int, value double")


def _numbers(batch: pa.RecordBatch, column: str, row: int) -> np.ndarray:
    return np.frombuffer(batch.column(column)[row].as_buffer(), np.float64)


def _binary(values: np.ndarray) -> pa.Array:
    return pa.array([np.ascontiguousarray(values).tobytes()], pa.binary())


def zeros(spark: SparkSession, n_classes: int, width: int, piece_width: int) -> DataFrame:
    """``(piece, w, m, v)`` of a new model, made on the executors."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in batch.column(0).to_pylist():
                none = _binary(np.zeros(n_classes * min(piece_width, width - piece * piece_width)))
                yield pa.RecordBatch.from_arrays([pa.array([piece], pa.int32()), none, none, none], names=["piece", "w", "m", "v"])

    pieces = spark.range(math.ceil(width / piece_width)).select(F.col("id").cast("int").alias("piece"))
    return pieces.mapInArrow(run, "piece int, w binary, m binary, v binary")


def _with_weights(tiles: Tiles, parameters: ParameterTable) -> DataFrame:
    """Tiles with the weights of their piece."""
    weights = parameters.rows.select("piece", "w")
    if 8 * parameters.n_classes * parameters.width <= BROADCAST_BYTES:
        return tiles.rows.join(F.broadcast(weights), "piece")
    groups = math.ceil(tiles.n_blocks / BLOCKS_PER_GROUP)
    own = tiles.rows.withColumn("part_of", F.pmod(F.xxhash64("block"), F.lit(groups)).cast("int"))
    copies = weights.withColumn("part_of", F.explode(F.sequence(F.lit(0), F.lit(groups - 1))))
    return own.join(copies.hint("shuffle_merge"), ["piece", "part_of"]).drop("part_of")


def _residuals(logits: np.ndarray, labels: np.ndarray) -> tuple[np.ndarray, float]:
    """Probabilities minus the one-hot labels, and the sum of the losses."""
    if labels.min() < 0 or labels.max() >= logits.shape[1]:
        raise ValueError("label is not a class of the model")
    shifted = logits - logits.max(axis=1, keepdims=True)
    norm = np.log(np.exp(shifted).sum(axis=1, keepdims=True))
    here = np.arange(len(labels))
    loss = float((norm[:, 0] - shifted[here, labels]).sum())
    p = np.exp(shifted - norm)
    p[here, labels] -= 1.0
    return p, loss


def _labels(batch: pa.RecordBatch, row: int) -> np.ndarray:
    return batch.column("keys").slice(row, 1).flatten().to_numpy(zero_copy_only=False).astype(np.int64)


def _one_piece(tiles: Tiles, parameters: ParameterTable) -> tuple[DataFrame, DataFrame | None]:
    """Gradient parts of a model of one piece: each task goes through its tiles once and adds up their parts."""
    n_classes = parameters.n_classes

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, loss, n = None, 0.0, 0
        for batch in batches:
            for r in range(batch.num_rows):
                labels, w = _labels(batch, r), _numbers(batch, "w", r).reshape(n_classes, -1)
                x = _numbers(batch, "data", r).reshape(len(labels), -1)
                residual, own = _residuals(x @ w.T, labels)
                part = residual.T @ x
                total = part if total is None else total + part
                loss, n = loss + own, n + len(labels)
        if n:
            columns = [pa.array([0], pa.int32()), _binary(total), pa.array([loss]), pa.array([n], pa.int64())]
            yield pa.RecordBatch.from_arrays(columns, names=["piece", "part", "loss", "n"])

    found = _with_weights(tiles, parameters).select("keys", "data", "w").mapInArrow(run, f"piece int, part binary, {TOTALS}")
    parts = write_table(found, "gradient-parts")
    return parts, parts


def _many_pieces(tiles: Tiles, parameters: ParameterTable) -> tuple[DataFrame, DataFrame]:
    """Gradient parts of a model of several pieces, and the residuals they come from."""
    n_classes = parameters.n_classes

    def multiply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for r in range(batch.num_rows):
                n, w = batch.column("n")[r].as_py(), _numbers(batch, "w", r).reshape(n_classes, -1)
                part = _binary(_numbers(batch, "data", r).reshape(n, -1) @ w.T)
                yield pa.RecordBatch.from_arrays([batch.column("block").slice(r, 1), part], names=["block", "part"])

    def residuals(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for r in range(batch.num_rows):
                labels = _labels(batch, r)
                residual, loss = _residuals(_numbers(batch, "part", r).reshape(len(labels), n_classes), labels)
                columns = [batch.column("block").slice(r, 1), _binary(residual), pa.array([loss]), pa.array([len(labels)], pa.int64())]
                yield pa.RecordBatch.from_arrays(columns, names=["block", "residual", "loss", "n"])

    def gradients(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for r in range(batch.num_rows):
                n = batch.column("n")[r].as_py()
                part = _binary(_numbers(batch, "residual", r).reshape(n, -1).T @ _numbers(batch, "data", r).reshape(n, -1))
                yield pa.RecordBatch.from_arrays([batch.column("piece").slice(r, 1), part], names=["piece", "part"])

    paired = _with_weights(tiles, parameters).select("block", F.size("keys").alias("n"), "data", "w")
    logits = add_tiles(paired.mapInArrow(multiply, "block bigint, part binary"), "block")
    labelled = logits.join(tiles.rows.filter("piece = 0").select("block", "keys"), "block")
    found = write_table(labelled.select("block", "part", "keys").mapInArrow(residuals, f"block bigint, residual binary, {TOTALS}"), "residuals")
    joined = tiles.rows.select("block", "piece", "data").join(found.select("block", "residual", "n"), "block")
    parts = joined.select("piece", "data", "residual", "n").mapInArrow(gradients, "piece int, part binary")
    return add_tiles(parts, "piece", shuffle=False), found


def reduce_tree(parts: DataFrame, tasks: int) -> DataFrame:
    """``(piece, part)``: sums of each piece in two levels, so that no task adds up the parts of all others."""
    fan = max(1, math.isqrt(tasks))
    if fan > 1:
        slot = F.pmod(F.spark_partition_id(), F.lit(fan)).cast("bigint")
        parts = add_tiles(parts.withColumn("slot", slot), "piece", "slot")
    return add_tiles(parts, "piece")


def _squares(part: Column) -> Column:
    """Sum of the squares of a binary of doubles."""

    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for column in batches:
            yield pa.array([float(np.square(np.frombuffer(b.as_buffer(), np.float64)).sum()) for b in column], pa.float64())

    return F.arrow_udf(run, "double")(part)


def updated(parameters: ParameterTable, gradients: DataFrame, scale: float, rate: float, s: Settings) -> DataFrame:
    """``(piece, w, m, v)`` after a step of AdamW with the gradient sums times ``scale``, decay first."""
    step = parameters.step + 1

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for r in range(batch.num_rows):
                w, m, v, part = (_numbers(batch, c, r) for c in ("w", "m", "v", "part"))
                grad = part * scale
                m = m + (1 - s.betas[0]) * (grad - m)
                v = v + (1 - s.betas[1]) * (grad * grad - v)
                root = np.sqrt(v / (1 - s.betas[1] ** step)) + s.eps
                w = w * (1 - rate * s.weight_decay) - rate * m / (1 - s.betas[0] ** step) / root
                columns = [batch.column("piece").slice(r, 1), _binary(w), _binary(m), _binary(v)]
                yield pa.RecordBatch.from_arrays(columns, names=["piece", "w", "m", "v"])

    return parameters.rows.join(gradients, "piece").mapInArrow(run, "piece int, w binary, m binary, v binary")


def _step(tiles: Tiles, parameters: ParameterTable, s: Settings) -> ParameterTable:
    spark = tiles.rows.sparkSession
    parts, told = (_one_piece if tiles.n_pieces == 1 else _many_pieces)(tiles, parameters)
    sums = write_table(reduce_tree(parts.select("piece", "part"), tiles.n_blocks), "gradients")
    none = F.lit(0.0)
    figures = told.select("loss", "n", none.alias("square")).unionByName(
        sums.select(none.alias("loss"), F.lit(0).cast("bigint").alias("n"), _squares(F.col("part")).alias("square"))
    )
    loss, n, square = figures.agg(F.sum("loss"), F.sum("n"), F.sum("square")).first()
    norm = math.sqrt(square) / n
    scale = min(1.0, s.max_norm / (norm + 1e-6)) / n
    rate = rate_at(parameters.step, s)
    rows = write_table(updated(parameters, sums, scale, rate, s), "parameters")
    trace = (*parameters.trace, (parameters.step, rate, loss / n, norm))
    return ParameterTable(rows, parameters.n_classes, parameters.width, parameters.piece_width, parameters.step + 1, trace)


def fit_parameter_table(
    rows: DataFrame,
    features: str,
    label: str,
    n_classes: int,
    settings: Settings,
    run_dir: str | None = None,
    tile_bytes: int = TILE_BYTES,
    tile_width: int = TILE_WIDTH,
) -> ParameterTable:
    """Fit by full-batch AdamW with clipped gradients and a warm-up and cosine rate, any number of features.

    Rows without features or label are left out; all others must have the same number of features. A piece
    has fewer features the more classes there are, so that tiles stay within ``tile_bytes``. With ``run_dir``
    the parameters are committed there every ``save_every`` steps, and a later call with the same folder goes
    on from the last commit; rows or settings other than its own are refused.
    """
    spark = rows.sparkSession
    there = rows.select(F.col(label).alias("y"), F.col(features).alias("x")).filter("x IS NOT NULL AND y IS NOT NULL")
    numbers = max(1, tile_bytes // 8)
    piece_width = max(1, min(tile_width, numbers // n_classes))
    tiles = cut_tiles(there, "y", "x", tile_bytes, piece_width, most_rows=max(1, numbers // n_classes))
    if not tiles.n_blocks or not tiles.width:
        raise ValueError("no rows to fit")
    same = {k: v for k, v in settings.__dict__.items() if k not in ("steps", "save_every")}
    mark = state.fingerprint(there, n_classes, tiles.piece_width, sorted(same.items())) if run_dir else ""
    committed = state.latest_step(spark, run_dir) if run_dir else None
    if committed is None:
        model = ParameterTable(
            write_table(zeros(spark, n_classes, tiles.width, tiles.piece_width), "parameters"), n_classes, tiles.width, tiles.piece_width
        )
    else:
        tables = state.load_step(spark, run_dir, committed, mark)
        trace = tuple(sorted(tuple(r) for r in tables["trace"].collect()))
        model = ParameterTable(tables["parameters"], n_classes, tiles.width, tiles.piece_width, committed, trace)
    while model.step < settings.steps:
        model = _step(tiles, model, settings)
        if run_dir and settings.save_every and model.step % settings.save_every == 0:
            state.save_step(spark, run_dir, model.step, mark, parameters=model.rows, trace=trace_table(spark, model))
    return model


def trace_table(spark: SparkSession, model: ParameterTable) -> DataFrame:
    """``(step, rate, loss, grad_norm)``, the loss before each step."""
    return local_table(spark, list(model.trace), TRACE)

"""Products of two large matrices, both in tiles: a join on the inner dimension.

The rows of each side are put together in blocks, and blocks are cut along the inner dimension into pieces.
A tile of the left side meets the tiles of the right side that have the same piece; the products of all
pieces of two blocks are added up. Neither side needs to fit a task or the driver, whatever its height and
width: a task holds a few tiles and a part of their product. Tiles of narrow rows are blocks of thousands, whose
product would be far larger than they are; it is handed on row by row and never put together.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from glyphmill.session import bound_batch_bytes, write_table

# Bytes of a tile and its greatest width; a block has as many rows as these leave.
TILE_BYTES, TILE_WIDTH = 2 << 20, 1024
# Bytes of a product that a task holds or hands on at once.
PRODUCT_BYTES = 2 << 20
# Left blocks whose sums a task holds.
SUMS_HELD = 64
# Pairs of blocks that one group of the join multiplies.
PAIRS_PER_GROUP = 64


def add_tiles(parts: DataFrame, *keys: str, shuffle: bool = True) -> DataFrame:
    """Sums of the double arrays in ``part`` over rows of equal ``keys``, which are numbers.

    Rows of a key follow each other in their task, so one sum is held at a time. Without ``shuffle`` a task
    adds up what it has, one row for each of its keys.
    """
    kinds = T.StructType([parts.schema[k] for k in keys] + [T.StructField("part", T.BinaryType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, total = None, None

        def row() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([*at_arrays, pa.array([total.tobytes()], pa.binary())], names=[*keys, "part"])

        at_arrays: list[pa.Array] = []
        for batch in batches:
            for r in range(batch.num_rows):
                own = tuple(batch.column(k)[r].as_py() for k in keys)
                part = np.frombuffer(batch.column("part")[r].as_buffer(), np.float64)
                if own == at:
                    total = total + part
                    continue
                if at is not None:
                    yield row()
                at, total, at_arrays = own, part, [batch.column(k).slice(r, 1) for k in keys]
        if at is not None:
            yield row()

    dealt = parts.select(*keys, "part")
    dealt = dealt.repartition(*keys) if shuffle else dealt
    return dealt.sortWithinPartitions(*keys).mapInArrow(run, kinds)


@dataclass(frozen=True)
class Tiles:
    """``rows`` are ``(block, piece, keys, data)``: the keys of a block's rows and the numbers of one piece."""

    rows: DataFrame
    n_blocks: int
    n_pieces: int
    width: int
    piece_width: int


@dataclass(frozen=True)
class TiledProduct:
    """``values`` are ``(key, column_block, y)``, one row per row of the left side and block of the right;
    ``columns`` are ``(column_block, out_keys)``, whose keys stand in the order of the numbers of ``y``.
    ``sums`` are ``(key, n, total, largest)`` of the numbers of each row of the left side, in some parts to be put
    together; products are summed up in the task that makes them and do not leave it."""

    values: DataFrame
    columns: DataFrame
    sums: DataFrame

    def long(self, key: str, out_key: str, value: str = "value") -> DataFrame:
        """``(key, out_key, value)``, one row per number."""
        joined = self.values.join(self.columns, "column_block")
        return joined.select(F.col("key").alias(key), F.explode(F.arrays_zip("out_keys", "y")).alias("cell")).select(
            key, F.col("cell.out_keys").alias(out_key), F.col("cell.y").alias(value)
        )

    def whole(self, key: str, vector: str = "y") -> DataFrame:
        """``(key, y)``, the blocks of each row in one array, ordered by ``column_block``. Rows that share a
        key, NULL included, are put together, so keys must be distinct."""
        parts = F.sort_array(F.collect_list(F.struct("column_block", "y")))
        return self.values.groupBy(F.col("key").alias(key)).agg(parts.alias("parts")).select(
            key, F.flatten(F.col("parts.y")).alias(vector)
        )


def cut_tiles(
    rows: DataFrame,
    key: str,
    vector: str,
    tile_bytes: int = TILE_BYTES,
    tile_width: int = TILE_WIDTH,
    most_rows: int | None = None,
) -> Tiles:
    """Tiles of ``(key, vector)``; rows without a vector are left out. All vectors must have one length."""
    there = rows.select(F.col(key).alias("key"), F.col(vector).cast("array<double>").alias("v")).filter("v IS NOT NULL")
    shortest, longest = there.agg(F.min(F.size("v")), F.max(F.size("v"))).first()
    if shortest != longest:
        raise ValueError(f"vectors have different lengths, from {shortest} to {longest}")
    width = longest or 0
    piece_width = max(1, min(width, tile_width))
    height = max(1, min(most_rows or tile_bytes, tile_bytes // (8 * piece_width)))
    starts = list(range(0, width, piece_width)) or [0]
    schema = T.StructType(
        [
            T.StructField("block", T.LongType()),
            T.StructField("piece", T.IntegerType()),
            T.StructField("keys", T.ArrayType(rows.schema[key].dataType)),
            T.StructField("data", T.BinaryType()),
        ]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        block = TaskContext.get().partitionId() << 32
        held: list[pa.RecordBatch] = []

        def tiles() -> Iterator[pa.RecordBatch]:
            batch = pa.Table.from_batches(held).combine_chunks()
            keys = batch.column(0).combine_chunks()
            numbers = batch.column(1).combine_chunks().flatten().to_numpy(zero_copy_only=False).reshape(len(keys), width)
            lists = pa.ListArray.from_arrays(pa.array([0, len(keys)], pa.int32()), keys)
            for piece, at in enumerate(starts):
                data = np.ascontiguousarray(numbers[:, at : at + piece_width]).tobytes()
                columns = [pa.array([block], pa.int64()), pa.array([piece], pa.int32()), lists, pa.array([data], pa.binary())]
                yield pa.RecordBatch.from_arrays(columns, names=schema.names)

        for batch in batches:
            while batch.num_rows:
                room = height - sum(b.num_rows for b in held)
                held.append(batch.slice(0, room))
                batch = batch.slice(room)
                if sum(b.num_rows for b in held) == height:
                    yield from tiles()
                    block, held = block + 1, []
        if held:
            yield from tiles()

    # Written, so that block numbers stay as they are when a task is repeated.
    made = write_table(there.mapInArrow(run, schema), "tiles")
    return Tiles(made, made.filter("piece = 0").count(), len(starts), width, piece_width)


def group_grid(left_blocks: int, right_blocks: int, parallelism: int, pairs: int = PAIRS_PER_GROUP) -> tuple[int, int]:
    """Groups of left and of right blocks: enough for all cores, else of about ``pairs`` pairs of blocks each,
    and nearly square in blocks, so that tiles are copied as seldom as can be."""
    wanted = max(parallelism, math.ceil(left_blocks * right_blocks / pairs))
    left = min(left_blocks, max(1, round(math.sqrt(wanted * left_blocks / max(right_blocks, 1)))))
    return max(1, left), max(1, min(right_blocks, math.ceil(wanted / max(left, 1))))


def _grouped(tiles: Tiles, own: str, own_groups: int, other: str, other_groups: int) -> DataFrame:
    """Tiles with their own group, copied to every group of the other side."""
    mine = F.pmod(F.xxhash64("block"), F.lit(own_groups)).cast("int")
    return tiles.rows.withColumns({own: mine, other: F.explode(F.sequence(F.lit(0), F.lit(other_groups - 1)))})


def grid_pairs(left: Tiles, right: Tiles) -> DataFrame:
    """All pairs of blocks, piece by piece: ``(i, j, piece, n, m, x, w, left_keys, right_keys)``.

    What is shuffled is each tile as often as the other side has groups.
    """
    left_groups, right_groups = group_grid(left.n_blocks, right.n_blocks, left.rows.sparkSession.sparkContext.defaultParallelism)
    a = _grouped(left, "lg", left_groups, "rg", right_groups)
    b = _grouped(right, "rg", right_groups, "lg", left_groups)
    pairs = a.alias("a").join(
        b.alias("b").hint("shuffle_merge"),
        (F.col("a.piece") == F.col("b.piece")) & (F.col("a.lg") == F.col("b.lg")) & (F.col("a.rg") == F.col("b.rg")),
    )
    return pairs.select(
        F.col("a.block").alias("i"),
        F.col("b.block").alias("j"),
        F.col("a.piece").alias("piece"),
        F.size("a.keys").alias("n"),
        F.size("b.keys").alias("m"),
        F.col("a.data").alias("x"),
        F.col("b.data").alias("w"),
        F.col("a.keys").alias("left_keys"),
        F.col("b.keys").alias("right_keys"),
    )


def tiled_product(left: Tiles, right: Tiles) -> TiledProduct:
    """``y = W x`` for each row ``x`` of the left side, the right side having the rows of ``W``.

    For tiles at least as high as they are wide the shuffle of the tiles is no more than about the size of
    the result.
    """
    if left.width != right.width and left.n_blocks and right.n_blocks:
        raise ValueError(f"rows of {left.width} numbers cannot meet rows of {right.width}")
    # A pair of tiles has some MB, so a batch must not hold thousands of them.
    bound_batch_bytes(left.rows.sparkSession)
    schema = T.StructType(
        [
            T.StructField("key", left.rows.schema["keys"].dataType.elementType),
            T.StructField("column_block", T.LongType()),
            T.StructField("y", T.ArrayType(T.DoubleType())),
        ]
    )
    kinds = T.StructType(
        [
            schema["key"],
            T.StructField("n", T.LongType()),
            T.StructField("total", T.DoubleType()),
            T.StructField("largest", T.DoubleType()),
        ]
    )
    columns = right.rows.filter("piece = 0").select(F.col("block").alias("column_block"), F.col("keys").alias("out_keys"))

    def whole_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Rows of the products of tiles that are whole blocks, a few rows at a time."""
        for batch in batches:
            for r in range(batch.num_rows):
                j, n, m = (batch.column(c)[r].as_py() for c in ("j", "n", "m"))
                x, w = (np.frombuffer(batch.column(c)[r].as_buffer(), np.float64) for c in ("x", "w"))
                x, w, keys = x.reshape(n, -1), w.reshape(m, -1).T, batch.column("left_keys").slice(r, 1).flatten()
                step = max(1, PRODUCT_BYTES // (8 * m))
                for first in range(0, n, step):
                    own, part = keys.slice(first, step), x[first : first + step] @ w
                    lists = pa.ListArray.from_arrays(pa.array(np.arange(len(own) + 1) * m, pa.int32()), pa.array(part.ravel()))
                    yield pa.RecordBatch.from_arrays([own, pa.array(np.full(len(own), j)), lists], names=schema.names)

    def summed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Sums of the products of tiles that are whole blocks, a few rows at a time, added up over right blocks."""
        held: dict[int, tuple[pa.Array, np.ndarray, np.ndarray, np.ndarray]] = {}

        def rows() -> Iterator[pa.RecordBatch]:
            for keys, count, total, largest in held.values():
                yield pa.RecordBatch.from_arrays([keys, *map(pa.array, (count, total, largest))], names=kinds.names)

        for batch in batches:
            for r in range(batch.num_rows):
                i, n, m = (batch.column(c)[r].as_py() for c in ("i", "n", "m"))
                x, w = (np.frombuffer(batch.column(c)[r].as_buffer(), np.float64) for c in ("x", "w"))
                x, w = x.reshape(n, -1), w.reshape(m, -1).T
                if i not in held:
                    if len(held) == SUMS_HELD:
                        yield from rows()
                        held.clear()
                    # Copied, so that the batch is not kept with them.
                    keys = pa.concat_arrays([batch.column("left_keys").slice(r, 1).flatten()])
                    keys = keys.take(pa.array(np.arange(n)))
                    held[i] = keys, np.zeros(n, np.int64), np.zeros(n), np.full(n, -np.inf)
                _, count, total, largest = held[i]
                count += m
                step = max(1, PRODUCT_BYTES // (8 * m))
                for first in range(0, n, step):
                    own, part = slice(first, first + step), x[first : first + step] @ w
                    total[own] += part.sum(axis=1)
                    np.maximum(largest[own], part.max(axis=1), out=largest[own])
        yield from rows()

    if left.n_pieces == 1:
        pairs = grid_pairs(left, right)
        values = pairs.select("j", "n", "m", "x", "w", "left_keys").mapInArrow(whole_rows, schema)
        sums = pairs.select("i", "n", "m", "x", "w", "left_keys").mapInArrow(summed, kinds)
        return TiledProduct(values, columns, sums)
    pairs = grid_pairs(left, right).select("i", "j", "piece", "n", "m", "x", "w")

    def multiply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for r in range(batch.num_rows):
                i, j, n, m = (batch.column(c)[r].as_py() for c in ("i", "j", "n", "m"))
                x, w = (np.frombuffer(batch.column(c)[r].as_buffer(), np.float64) for c in ("x", "w"))
                part = x.reshape(n, -1) @ w.reshape(m, -1).T
                columns = [pa.array([i], pa.int64()), pa.array([j], pa.int64()), pa.array([part.tobytes()], pa.binary())]
                yield pa.RecordBatch.from_arrays(columns, names=["i", "j", "part"])

    parts = add_tiles(pairs.mapInArrow(multiply, "i bigint, j bigint, part binary"), "i", "j")
    keys = left.rows.filter("piece = 0").select(F.col("block").alias("i"), "keys")

    def rows_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for r in range(batch.num_rows):
                own = batch.column("keys").slice(r, 1).flatten()
                numbers = np.frombuffer(batch.column("part")[r].as_buffer(), np.float64)
                ends = np.arange(len(own) + 1) * (len(numbers) // len(own))
                lists = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(numbers))
                where = pa.array(np.full(len(own), batch.column("j")[r].as_py()), pa.int64())
                yield pa.RecordBatch.from_arrays([own, where, lists], names=schema.names)

    def summed_parts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for r in range(batch.num_rows):
                own = batch.column("keys").slice(r, 1).flatten()
                part = np.frombuffer(batch.column("part")[r].as_buffer(), np.float64).reshape(len(own), -1)
                found = np.full(len(own), part.shape[1]), part.sum(axis=1), part.max(axis=1)
                yield pa.RecordBatch.from_arrays([own, *map(pa.array, found)], names=kinds.names)

    whole = parts.join(keys, "i")
    values = whole.select("j", "part", "keys").mapInArrow(rows_of, schema)
    return TiledProduct(values, columns, whole.select("part", "keys").mapInArrow(summed_parts, kinds))


def matrix_product(vectors: DataFrame, weights: DataFrame, key: str, vector: str, out_key: str, weight: str) -> TiledProduct:
    """``y = W x`` of two tables of any size, see :func:`tiled_product`."""
    return tiled_product(cut_tiles(vectors, key, vector), cut_tiles(weights, out_key, weight))

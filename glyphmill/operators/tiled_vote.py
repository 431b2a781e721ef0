"""Softmax-weighted votes of any number of keys for any number of queries, with any mask.

Queries and keys are put in tiles, and a tile of queries meets every tile of keys in one group of a grid. A task
keeps one running softmax per query: the greatest score so far, and sums relative to it. Running softmaxes merge
like sums do, first within a task and then over tasks, so what is shuffled a second time is queries times groups
of keys and never pairs.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from glyphmill.operators.joins import attach_by_key
from glyphmill.operators.tiles import TILE_BYTES, Tiles, cut_tiles, grid_pairs
from glyphmill.session import write_table

KEEP = ("all", "same", "different")


def merge_states(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Running softmaxes, one row per query: greatest score, sum of weights, weighted sums of values."""
    top = np.maximum(a[:, :1], b[:, :1])
    base = np.where(np.isfinite(top), top, 0.0)
    return np.hstack([top, a[:, 1:] * np.exp(a[:, :1] - base) + b[:, 1:] * np.exp(b[:, :1] - base)])


def state_of(score: np.ndarray, values: np.ndarray) -> np.ndarray:
    """Running softmax over one tile of keys; a score of ``-inf`` is a key that is not seen."""
    top = score.max(axis=1, keepdims=True)
    weight = np.exp(score - np.where(np.isfinite(top), top, 0.0))
    return np.hstack([top, weight.sum(axis=1, keepdims=True), weight @ values])


def _folded(states: DataFrame, width: int, shuffle: bool) -> DataFrame:
    """One state for each block of queries in a task, or over all tasks; blocks follow each other."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, total = None, None

        def row() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array([at], pa.int64()), pa.array([total.tobytes()], pa.binary())], names=["i", "state"])

        for batch in batches:
            for r in range(batch.num_rows):
                own = batch.column("i")[r].as_py()
                state = np.frombuffer(batch.column("state")[r].as_buffer(), np.float64).reshape(-1, width)
                if own == at:
                    total = merge_states(total, state)
                    continue
                if at is not None:
                    yield row()
                at, total = own, state
        if at is not None:
            yield row()

    dealt = states.repartition("i") if shuffle else states
    return dealt.sortWithinPartitions("i").mapInArrow(run, "i bigint, state binary")


def _places(tiles: Tiles, name: str, block: str, place: str) -> DataFrame:
    """Block and place in it of each id."""
    return tiles.rows.select(F.col("block").alias(block), F.posexplode("keys").alias(place, "key")).select(
        F.col("key.id").alias(name), block, place
    )


def _mask_bits(mask: DataFrame, queries: Tiles, keys: Tiles) -> DataFrame:
    """``(i, j, seen)``: the pairs of places that a pair of blocks has in the mask ``(q, k)``.

    An id that is in many pairs makes no task hot: see :func:`attach_by_key`.
    """
    pairs = write_table(mask.distinct(), "mask")
    for name, tiles, block, place in (("q", queries, "i", "a"), ("k", keys, "j", "b")):
        uses = pairs.groupBy(name).agg(F.count(F.lit(1)).alias("uses"))
        pairs = attach_by_key(pairs, _places(tiles, name, block, place).join(uses, name), [name], "uses")
    packed = F.col("a").cast("bigint") * (1 << 32) + F.col("b")
    return pairs.groupBy("i", "j").agg(F.collect_list(packed).alias("seen"))


def tiled_neighbour_vote(
    queries: DataFrame,
    keys: DataFrame,
    query_id: str,
    query: str,
    key_id: str,
    key: str,
    value: str,
    mask: DataFrame | None = None,
    query_group: str | None = None,
    key_group: str | None = None,
    keep: str = "all",
    tile_bytes: int = TILE_BYTES,
) -> DataFrame:
    """``(query_id, weights)``: ``softmax(q k / sqrt(d)) v`` of the keys a query sees, as one array.

    ``mask`` has a row ``(query id, key id)`` for each pair that is seen, in its first two columns; without it
    ``keep`` says which groups are: ``"all"``, the ``"same"`` or a ``"different"`` one. A query that sees no key
    gets no row; rows without a vector, and keys without a value, take no part. Ids may repeat or be NULL, but
    not where there is a mask. All queries and keys must have one length, and all values.
    """
    if keep not in KEEP:
        raise ValueError(f"keep: {keep}")
    if mask is not None and keep != "all":
        raise ValueError("a mask says all, groups are not asked")

    def side(df: DataFrame, name: str, group: str | None, vector, there) -> DataFrame:
        own = F.lit(None).cast("string") if group is None else F.col(group).cast("string")
        return df.filter(there).select(F.struct(F.col(name).alias("id"), own.alias("g")).alias("key"), vector.alias("v"))

    wide = F.concat(F.col(key).cast("array<double>"), F.col(value).cast("array<double>"))
    left = cut_tiles(side(queries, query_id, query_group, F.col(query), F.col(query).isNotNull()), "key", "v", tile_bytes, 1 << 30)
    right = cut_tiles(side(keys, key_id, key_group, wide, wide.isNotNull()), "key", "v", tile_bytes, 1 << 30)
    dim, n_values = left.width, right.width - left.width
    schema = T.StructType([queries.schema[query_id], T.StructField("weights", T.ArrayType(T.DoubleType()))])
    if not left.n_blocks or not right.n_blocks:
        return queries.sparkSession.createDataFrame([], schema)
    widths = [r[0] for r in keys.select(F.size(key)).filter(wide.isNotNull()).distinct().limit(2).collect()]
    if widths != [dim]:
        raise ValueError(f"queries of {dim} numbers cannot meet keys of {widths}")
    pairs = grid_pairs(left, right).select("i", "j", "x", "w", "left_keys", "right_keys")
    masked = mask is not None
    if masked:
        q, k, *_ = mask.columns
        pairs = pairs.join(_mask_bits(mask.select(F.col(q).alias("q"), F.col(k).alias("k")), left, right), ["i", "j"])
    else:
        pairs = pairs.withColumn("seen", F.lit(None).cast("array<bigint>"))

    def groups(batch: pa.RecordBatch, column: str, r: int) -> np.ndarray:
        return np.array(batch.column(column).slice(r, 1).flatten().field("g").to_pylist(), object)

    def vote(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for r in range(batch.num_rows):
                x, w = (np.frombuffer(batch.column(c)[r].as_buffer(), np.float64) for c in ("x", "w"))
                x, w = x.reshape(-1, dim), w.reshape(-1, dim + n_values)
                score = x @ w[:, :dim].T / math.sqrt(dim)
                hidden = None
                if masked:
                    seen = batch.column("seen").slice(r, 1).flatten().to_numpy(zero_copy_only=False)
                    hidden = np.ones(score.shape, bool)
                    hidden[seen >> 32, seen & 0xFFFFFFFF] = False
                elif keep != "all":
                    same = groups(batch, "left_keys", r)[:, None] == groups(batch, "right_keys", r)[None, :]
                    hidden = ~same if keep == "same" else same
                if hidden is not None:
                    score[hidden.astype(bool)] = -np.inf
                state = state_of(score, w[:, dim:])
                yield pa.RecordBatch.from_arrays([batch.column("i").slice(r, 1), pa.array([state.tobytes()], pa.binary())], names=["i", "state"])

    def weights(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for r in range(batch.num_rows):
                state = np.frombuffer(batch.column("state")[r].as_buffer(), np.float64).reshape(-1, n_values + 2)
                seen = np.isfinite(state[:, 0])
                ids = batch.column("keys").slice(r, 1).flatten().field("id").filter(pa.array(seen))
                found = state[seen, 2:] / state[seen, 1:2]
                ends = pa.array(np.arange(len(ids) + 1) * n_values, pa.int32())
                yield pa.RecordBatch.from_arrays([ids, pa.ListArray.from_arrays(ends, pa.array(found.ravel()))], names=schema.names)

    states = pairs.sortWithinPartitions("i").mapInArrow(vote, "i bigint, state binary")
    whole = _folded(_folded(states, n_values + 2, shuffle=False), n_values + 2, shuffle=True)
    named = whole.join(left.rows.select(F.col("block").alias("i"), "keys"), "i")
    return named.select("state", "keys").mapInArrow(weights, schema)

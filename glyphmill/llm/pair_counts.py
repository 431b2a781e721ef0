"""Counts by class of all word pairs, in shards of numbers, and the counts of the pairs that blocks of texts ask for.

A pair is a number of 42 bits, whose leading bits are its shard. A shard is one packed row: the other bits of its
pairs in ascending order, and what was counted. A block of texts sends each shard the pairs it has and gets their
counts back in the order it asked, so neither the table nor its parts go to texts that do not need them.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

PAIR_BITS, SHARD_BITS = 42, 10
LOW_BITS, SHARDS = PAIR_BITS - SHARD_BITS, 1 << SHARD_BITS
# Bytes of a number, which no step between two is beyond.
STEP_BYTES = 6
# The number of a word without one before it, which is in no shard.
NO_PAIR = 1 << PAIR_BITS
# Pairs the driver gets in one job.
PAIRS_AT_ONCE = 1 << 21
# Packed pairs: ``low`` has 32 bits a pair, ``counts`` twice 32.
PACKED = "shard int, low binary, counts binary"
# Shards of all pairs: ``small`` has 16 bits a pair, two counts below 256 each, and ``big`` three numbers of 32 bits for
# each other pair: its place and its counts.
TABLE = "shard int, n bigint, low binary, small binary, big binary"


def pair_keys(before: np.ndarray, word: np.ndarray, word_bits: int) -> np.ndarray:
    """A number for each pair of slots, a different one for each, dealt evenly; ``NO_PAIR`` where ``before`` is -1."""
    mask = np.uint64((1 << PAIR_BITS) - 1)
    key = (np.maximum(before, 0) << word_bits | word).astype(np.uint64)
    with np.errstate(over="ignore"):
        for _ in range(2):
            key = key * np.uint64(0x9E3779B97F4A7C15) & mask
            key ^= key >> np.uint64(PAIR_BITS // 2)
    return np.where(before < 0, NO_PAIR, key.astype(np.int64))


def merge(parts: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    """Distinct pairs, ascending, and their counts, added up."""
    keys, counts = (np.concatenate(c) for c in zip(*parts))
    order = np.argsort(keys, kind="stable")
    keys, counts = keys[order], counts[order]
    fresh = np.ones(len(keys), bool)
    fresh[1:] = keys[1:] != keys[:-1]
    first = np.flatnonzero(fresh)
    return keys[first], np.add.reduceat(counts, first, axis=0) if len(first) else counts


def _binary(values: np.ndarray, ends: np.ndarray) -> pa.Array:
    """One binary value for the rows between each two ``ends``."""
    width = values.itemsize * (values.shape[1] if values.ndim > 1 else 1)
    buffers = [None, pa.py_buffer((ends * width).astype(np.int32)), pa.py_buffer(np.ascontiguousarray(values))]
    return pa.Array.from_buffers(pa.binary(), len(ends) - 1, buffers)


def _cut(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Shards that sorted pairs have, and where these begin, with the end."""
    starts = np.searchsorted(keys, np.arange(SHARDS + 1) << LOW_BITS)
    shards = np.flatnonzero(np.diff(starts))
    return shards.astype(np.int32), np.append(starts[shards], starts[-1])


def _low(keys: np.ndarray) -> np.ndarray:
    return (keys & ((1 << LOW_BITS) - 1)).astype(np.uint32)


def pack(keys: np.ndarray, counts: np.ndarray) -> pa.RecordBatch:
    """Rows of ``PACKED`` from sorted pairs."""
    shards, ends = _cut(keys)
    columns = [pa.array(shards), _binary(_low(keys), ends), _binary(counts.astype(np.uint32), ends)]
    return pa.RecordBatch.from_arrays(columns, names=["shard", "low", "counts"])


def _numbers(column: pa.Array, r: int, kind: type) -> np.ndarray:
    return np.frombuffer(column[r].as_buffer(), kind)


def planes(values: np.ndarray, width: int | None = None) -> bytes:
    """First bytes of all numbers, then second ones and so on, ``width`` of them: upper ones are mostly zero and
    compress well."""
    return np.ascontiguousarray(values.view(np.uint8).reshape(len(values), values.itemsize).T[:width]).tobytes()


def from_planes(data: bytes, kind: type, width: int | None = None) -> np.ndarray:
    held = np.frombuffer(data, np.uint8).reshape(width or np.dtype(kind).itemsize, -1)
    whole = np.zeros((held.shape[1], np.dtype(kind).itemsize), np.uint8)
    whole[:, : len(held)] = held.T
    return whole.view(kind).ravel()


def sum_counts(packed: DataFrame) -> DataFrame:
    """One row of ``TABLE`` for each shard of ``packed``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, parts = None, []

        def row() -> pa.RecordBatch:
            low, counts = merge(parts)
            large = np.flatnonzero((counts > 255).any(axis=1))
            small = np.where((counts > 255).any(axis=1), 0, counts[:, 0] << np.uint32(8) | counts[:, 1]).astype(np.uint16)
            big = np.column_stack([large, counts[large]]).astype(np.uint32)
            found = [pa.array([v.tobytes()], pa.binary()) for v in (low.astype(np.uint32), small, big)]
            columns = [pa.array([at], pa.int32()), pa.array([len(low)], pa.int64()), *found]
            return pa.RecordBatch.from_arrays(columns, names=["shard", "n", "low", "small", "big"])

        for batch in batches:
            for r, shard in enumerate(batch.column("shard").to_pylist()):
                if shard != at:
                    if parts:
                        yield row()
                    at, parts = shard, []
                counts = _numbers(batch.column("counts"), r, np.uint32).reshape(-1, 2)
                parts.append((_numbers(batch.column("low"), r, np.uint32).copy(), counts.copy()))
        if parts:
            yield row()

    return packed.repartition("shard").sortWithinPartitions("shard").mapInArrow(run, TABLE)


def _unpacked(small: np.ndarray, big: np.ndarray) -> np.ndarray:
    counts = np.column_stack([small >> 8, small & 255]).astype(np.int64)
    counts[big[:, 0]] = big[:, 1:]
    return counts


@dataclass(frozen=True)
class PairCounts:
    """The rows of ``TABLE`` one after another; shard ``s`` is from ``starts[s]`` to ``starts[s + 1]``."""

    starts: np.ndarray
    low: np.ndarray
    small: np.ndarray
    big_at: np.ndarray
    big: np.ndarray

    def _of(self, places: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        n = [(self.small[places] >> 8).astype(np.int64), (self.small[places] & 255).astype(np.int64)]
        if len(self.big_at):
            at = np.minimum(np.searchsorted(self.big_at, places), len(self.big_at) - 1)
            large = self.big_at[at] == places
            n = [np.where(large, self.big[at, kind], n[kind]) for kind in (0, 1)]
        return n[0], n[1]

    def counts(self) -> tuple[np.ndarray, np.ndarray]:
        return self._of(np.arange(len(self.low)))

    def find(self, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Counts of both classes of each pair, 0 for those the table does not have."""
        found = np.zeros(len(keys), np.int64), np.zeros(len(keys), np.int64)
        if not len(self.low) or not len(keys):
            return found
        shard, low = np.minimum(keys >> LOW_BITS, SHARDS - 1), _low(keys)
        # The first place of the shard that is not below, by halving in all shards at once.
        first, end = self.starts[shard], self.starts[shard + 1]
        stop = end.copy()
        for _ in range(int((end - first).max(initial=0)).bit_length()):
            middle = (first + stop) >> 1
            below = (first < stop) & (self.low[np.minimum(middle, len(self.low) - 1)] < low)
            first, stop = np.where(below, middle + 1, first), np.where(below, stop, np.maximum(middle, first))
        there = np.flatnonzero((first < end) & (keys != NO_PAIR))
        there = there[self.low[first[there]] == low[there]]
        for own, n in zip(found, self._of(first[there])):
            own[there] = n
        return found


def collect(table: DataFrame) -> PairCounts:
    """All rows of ``TABLE`` on the driver, which gets about ``PAIRS_AT_ONCE`` of them in a job."""
    sizes = np.zeros(SHARDS + 1, np.int64)
    for row in table.select("shard", "n").collect():
        sizes[row["shard"] + 1] = row["n"]
    starts = np.cumsum(sizes)
    low, small = np.zeros(starts[-1], np.uint32), np.zeros(starts[-1], np.uint16)
    large = [np.zeros((0, 3), np.int64)]
    step = SHARDS // max(1, min(SHARDS, -(-int(starts[-1]) // PAIRS_AT_ONCE)))
    for first in range(0, SHARDS, step):
        rows = table.filter(F.col("shard").between(first, first + step - 1)).select("shard", "low", "small", "big").toArrow()
        for batch in rows.to_batches():
            for r, shard in enumerate(batch.column("shard").to_pylist()):
                own = slice(starts[shard], starts[shard + 1])
                low[own] = _numbers(batch.column("low"), r, np.uint32)
                small[own] = _numbers(batch.column("small"), r, np.uint16)
                large.append(_numbers(batch.column("big"), r, np.uint32).reshape(-1, 3) + [starts[shard], 0, 0])
    big = np.concatenate(large)
    big = big[np.argsort(big[:, 0])]
    return PairCounts(starts, low, small, big[:, 0].copy(), big[:, 1:].copy())


def attach_counts(
    asked: DataFrame, table: DataFrame, answer: Callable[[dict, np.ndarray], pa.RecordBatch], schema: str
) -> DataFrame:
    """``answer`` of every row of ``asked`` and the counts of its ``pairs``: the ``STEP_BYTES`` planes of the steps
    between sorted numbers, from 0 on.

    ``asked`` is read twice and its ``block`` must be another one in each row.
    """

    def ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for r in range(batch.num_rows):
                keys = np.cumsum(from_planes(batch.column("pairs")[r].as_buffer(), np.int64, STEP_BYTES))
                shards, ends = _cut(keys)
                block = np.full(len(shards), batch.column("block")[r].as_py())
                low = _binary(_low(keys), ends)
                yield pa.RecordBatch.from_arrays([pa.array(block), pa.array(shards), low], names=["block", "shard", "low"])

    def reply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, known, counts = None, None, None
        for batch in batches:
            blocks, shards, found = batch.column("block").to_pylist(), batch.column("shard").to_pylist(), []
            kept: list[int] = []
            for r, shard in enumerate(shards):
                low = _numbers(batch.column("low"), r, np.uint32)
                if blocks[r] < 0:
                    at, known = shard, low.copy()
                    big = _numbers(batch.column("big"), r, np.uint32).reshape(-1, 3)
                    counts = _unpacked(_numbers(batch.column("small"), r, np.uint16), big)
                elif at == shard:
                    place = np.minimum(np.searchsorted(known, low), len(known) - 1)
                    kept.append(r)
                    found.append(planes(np.where((known[place] == low)[:, None], counts[place], 0).astype(np.uint32).ravel()))
                else:
                    # No pair of the shard was counted.
                    kept.append(r)
                    found.append(bytes(8 * len(low)))
            if kept:
                own = batch.select(["block", "shard"]).take(pa.array(kept))
                yield pa.RecordBatch.from_arrays([*own.columns, pa.array(found, pa.binary())], names=["block", "shard", "counts"])

    asks = asked.select("block", "pairs").mapInArrow(ask, "block bigint, shard int, low binary")
    nothing = F.lit(None).cast("binary")
    shards = table.select(F.lit(-1).cast("bigint").alias("block"), "shard", "low", "small", "big")
    met = shards.unionByName(asks.withColumns({"small": nothing, "big": nothing}))
    replies = met.repartition("shard").sortWithinPartitions("shard", "block").mapInArrow(
        reply, "block bigint, shard int, counts binary"
    )
    plain = [c for c in asked.columns if c not in ("block", "pairs")]

    def put_together(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        row, parts = None, []

        def answered() -> pa.RecordBatch:
            return answer(row, np.concatenate([np.zeros((0, 2), np.int64), *parts]))

        for batch in batches:
            for r, shard in enumerate(batch.column("shard").to_pylist()):
                if shard < 0:
                    if row is not None:
                        yield answered()
                    row, parts = {c: batch.column(c)[r].as_py() for c in plain}, []
                else:
                    parts.append(from_planes(batch.column("counts")[r].as_buffer(), np.uint32).reshape(-1, 2).astype(np.int64))
        if row is not None:
            yield answered()

    own = asked.select("block", F.lit(-1).alias("shard"), nothing.alias("counts"), *plain)
    both = own.unionByName(replies, allowMissingColumns=True)
    return both.repartition("block").sortWithinPartitions("block", "shard").mapInArrow(put_together, schema)

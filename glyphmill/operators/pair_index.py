"""An inverted index from symbol pairs to words, kept up to date by the changes each merge makes.

Words lie in blocks, one row of a cached table each. A block holds the symbols of its words and postings
from each pair to the words that have it. Merging a pair looks up its words alone, rewrites them, and
reports by how much pair counts changed; a new pair gets postings of its own in a further segment.
Postings of words that lost the pair stay until segments are joined, and are passed over when read.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

BLOCK_WORDS = 100_000
# Segments of postings a block keeps before they are joined.
MOST_SEGMENTS = 8
# What packed blocks begin with, and how their arrays are compressed.
PACKED, CODEC = -1, "zstd"

Pair = tuple[str, str]
LOW = (1 << 32) - 1

# Kinds of rows: a block, the change of a pair the driver follows, the count of a pair with a new symbol,
# the most frequent neighbour of a candidate pair, and a triple of two candidates.
BLOCK, CHANGE, CREATED, CONTEXT, OVERLAP = range(5)
# Symbols are numbers, see ``Names``; the ``c`` of a context says on which side ``outer`` stands.
SCHEMA = "kind int, a bigint, b bigint, c bigint, n bigint, outer bigint, block binary"
BEFORE, AFTER = 0, 1


def keys_of(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    return left.astype(np.int64) << 32 | right.astype(np.int64)


def weighted(keys: np.ndarray, weights: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct keys, where each occurs first, and the exact sums of their weights."""
    distinct, first, number = np.unique(keys, return_index=True, return_inverse=True)
    sums = np.zeros(len(distinct), np.int64)
    np.add.at(sums, number, weights)
    return distinct, first, sums


def _kinds_of(n: int) -> tuple[list[type], list[bool]]:
    """Of the ``n`` arrays of a block the kinds, and whether their numbers are kept as steps."""
    later = (n - 4) // 3
    kinds = [np.int32, np.int64, np.int32, np.int64] + [np.int64, np.int64, np.int32] * later
    return kinds, [False, True, False, False] + [True] * 3 * later


def _pack(values: np.ndarray, steps: bool) -> bytes:
    """Numbers, or the steps between them, in planes of bytes, of which most are nearly all zero, compressed."""
    if not len(values):
        return b""
    kept = np.diff(values, prepend=values.dtype.type(0)) if steps else values
    planes = np.ascontiguousarray(kept).view(np.uint8).reshape(len(values), values.itemsize).T
    return pa.compress(planes.tobytes(), codec=CODEC, asbytes=True)


def _unpack(data, kind: type, size: int, steps: bool) -> np.ndarray:
    if not size:
        return np.zeros(0, kind)
    width = np.dtype(kind).itemsize
    planes = np.frombuffer(pa.decompress(pa.py_buffer(data), size * width, codec=CODEC), np.uint8).reshape(width, size)
    values = np.ascontiguousarray(planes.T).view(kind).ravel()
    # Steps back are kept modulo the width of the kind, so sums are too.
    return np.cumsum(values, dtype=kind) if steps else values


@dataclass(frozen=True)
class Segment:
    """Postings: ``words[at[i]:at[i + 1]]`` are the words that had pair ``keys[i]``; keys ascend."""

    keys: np.ndarray
    at: np.ndarray
    words: np.ndarray

    @classmethod
    def of(cls, keys: np.ndarray, words: np.ndarray) -> Segment:
        order = np.lexsort((words, keys))
        keys, words = keys[order], words[order]
        new = np.append(True, (np.diff(keys) != 0) | (np.diff(words) != 0))[: len(keys)]
        keys, words = keys[new], words[new]
        first = np.flatnonzero(np.append(True, np.diff(keys) != 0)[: len(keys)])
        return cls(keys[first], np.append(first, len(words)).astype(np.int64), words.astype(np.int32))

    def find(self, wanted: np.ndarray) -> np.ndarray:
        """Words of the wanted pairs, some of them more than once."""
        if not len(self.keys):
            return self.words
        place = np.searchsorted(self.keys, wanted)
        place = place[(place < len(self.keys)) & (self.keys[np.minimum(place, len(self.keys) - 1)] == wanted)]
        parts = [self.words[self.at[i] : self.at[i + 1]] for i in place]
        return np.concatenate(parts) if parts else self.words[:0]


@dataclass
class Selection:
    """Some words of a block, symbol after symbol, with the number of the word of each symbol."""

    symbols: np.ndarray
    word: np.ndarray

    def pairs(self) -> tuple[np.ndarray, np.ndarray]:
        """Where pairs begin, and their keys."""
        at = np.flatnonzero(self.word[:-1] == self.word[1:])
        return at, keys_of(self.symbols[at], self.symbols[at + 1])


@dataclass
class WordBlock:
    """``length[i]`` symbols from ``start[i]`` on are word ``i``, which occurs ``count[i]`` times."""

    symbols: np.ndarray
    start: np.ndarray
    length: np.ndarray
    count: np.ndarray
    segments: list[Segment]

    @classmethod
    def of(cls, symbols: np.ndarray, length: np.ndarray, count: np.ndarray) -> WordBlock:
        start = np.cumsum(length) - length
        block = cls(symbols.astype(np.int32), start, length.astype(np.int32), count, [])
        every = block.select(np.arange(len(length)))
        at, keys = every.pairs()
        block.segments = [Segment.of(keys, every.word[at])]
        return block

    def to_bytes(self) -> bytes:
        """The arrays packed one by one: blocks are cached twice in each round, and lie on disk where memory is short."""
        arrays = [self.symbols, self.start, self.length, self.count]
        for s in self.segments:
            arrays += [s.keys, s.at, s.words]
        parts = [_pack(a, steps) for a, steps in zip(arrays, _kinds_of(len(arrays))[1])]
        head = np.array([PACKED, len(arrays), *map(len, arrays), *map(len, parts)], np.int64)
        return b"".join([head.tobytes(), *parts])

    @classmethod
    def from_bytes(cls, data) -> WordBlock:
        """A block from its bytes; those of committed steps of older runs are not packed."""
        packed = int(np.frombuffer(data, np.int64, 1)[0]) == PACKED
        n = int(np.frombuffer(data, np.int64, 1, 8 * packed)[0])
        sizes = np.frombuffer(data, np.int64, n, 8 * (1 + packed)).tolist()
        kinds, steps = _kinds_of(n)
        arrays = []
        if packed:
            at = 8 * (2 + 2 * n)
            for kind, size, step, length in zip(kinds, sizes, steps, np.frombuffer(data, np.int64, n, 8 * (2 + n)).tolist()):
                arrays.append(_unpack(memoryview(data)[at : at + length], kind, size, step))
                at += length
        else:
            at = 8 * (n + 1)
            for kind, size in zip(kinds, sizes):
                arrays.append(np.frombuffer(data, kind, size, at))
                at += -(-arrays[-1].nbytes // 8) * 8
        segments = [Segment(*arrays[i : i + 3]) for i in range(4, n, 3)]
        return cls(arrays[0].copy(), arrays[1], arrays[2].copy(), arrays[3], segments)

    def words_with(self, keys: np.ndarray) -> np.ndarray:
        """Words that have one of the pairs, and words that had it."""
        return np.unique(np.concatenate([s.find(keys) for s in self.segments]))

    def select(self, words: np.ndarray) -> Selection:
        sizes = self.length[words].astype(np.int64)
        ends = np.cumsum(sizes)
        place = np.repeat(self.start[words] - (ends - sizes), sizes) + np.arange(sizes.sum())
        return Selection(self.symbols[place], np.repeat(words, sizes))

    def pair_counts(self) -> tuple[np.ndarray, np.ndarray]:
        """Counts of all pairs of the block: the full count, for a start."""
        every = self.select(np.arange(len(self.length)))
        at, keys = every.pairs()
        distinct, _, sums = weighted(keys, self.count[every.word[at]])
        return distinct, sums

    def merge(self, keys: np.ndarray, built: np.ndarray, followed: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Merge pairs at once, of which no two can overlap unless a pair overlaps itself.

        ``keys`` ascend and build the symbols ``built``. Returns the changes of the ``followed`` pairs and
        the counts of pairs that hold a symbol of ``built``.
        """
        none = np.zeros(0, np.int64)
        found = self.select(self.words_with(keys))
        at, pair = found.pairs()
        place = np.minimum(np.searchsorted(keys, pair), len(keys) - 1)
        hits = keys[place] == pair
        if not hits.any():
            return none, none, none, none
        # Only words that still have a pair change.
        changed = np.unique(found.word[at[hits]])
        found = self.select(changed)
        at, pair = found.pairs()
        weight = self.count[found.word[at]]
        place = np.minimum(np.searchsorted(keys, pair), len(keys) - 1)
        hit, to = at[keys[place] == pair], built[place[keys[place] == pair]]
        # Of overlapping places, which hold equal symbols, every second one merges, from the left.
        first = np.append(True, (np.diff(hit) > 1) | (found.word[hit[1:]] != found.word[hit[:-1]]))
        run = np.maximum.accumulate(np.where(first, np.arange(len(hit)), 0))
        taken = (np.arange(len(hit)) - run) % 2 == 0
        hit, to = hit[taken], to[taken]
        symbols, keep = found.symbols.copy(), np.ones(len(found.symbols), bool)
        symbols[hit] = to
        keep[hit + 1] = False
        merged = Selection(symbols[keep], found.word[keep])
        number = np.searchsorted(changed, merged.word)
        self.length[changed] = np.bincount(number, minlength=len(changed))
        within = np.arange(len(number)) - np.searchsorted(number, number)
        self.symbols[self.start[merged.word] + within] = merged.symbols

        new_at, new_pair = merged.pairs()
        new_weight = self.count[merged.word[new_at]]
        fresh = np.isin(merged.symbols[new_at], built) | np.isin(merged.symbols[new_at + 1], built)
        if fresh.any():
            self.segments.append(Segment.of(new_pair[fresh], merged.word[new_at[fresh]]))
        if len(self.segments) > MOST_SEGMENTS:
            self.join_segments()
        keys_both = np.append(pair, new_pair)
        weights = np.append(-weight, new_weight)
        known = np.isin(keys_both, followed)
        followed_keys, _, change = weighted(keys_both[known], weights[known])
        made, _, made_counts = weighted(new_pair[fresh], new_weight[fresh])
        return followed_keys, change, made, made_counts

    def join_segments(self) -> None:
        """Fewer segments: the later ones become one, or all are made anew once the later ones are large."""
        base, *later = self.segments
        if 2 * sum(len(s.words) for s in later) < len(base.words):
            parts = [(np.repeat(s.keys, np.diff(s.at)), s.words) for s in later]
            self.segments = [base, Segment.of(*(np.concatenate(column) for column in zip(*parts)))]
            return
        every = self.select(np.arange(len(self.length)))
        at, keys = every.pairs()
        self.segments = [Segment.of(keys, every.word[at])]

    def contexts(self, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Triples that begin or end with one of the pairs, with their counts: ``(a, b, c, is_candidate, n)``.

        ``is_candidate`` is 1 if the first two are one of the pairs, 2 if the last two are, 3 for both.
        """
        found = self.select(self.words_with(keys))
        at = np.flatnonzero(found.word[:-2] == found.word[2:])
        a, b, c = (found.symbols[at + i].astype(np.int64) for i in range(3))
        role = np.isin(keys_of(a, b), keys) + 2 * np.isin(keys_of(b, c), keys)
        there = role > 0
        a, b, c, role, at = a[there], b[there], c[there], role[there], at[there]
        _, number = np.unique(keys_of(a, b), return_inverse=True)
        _, first, n = weighted(number.astype(np.int64) << 32 | c, self.count[found.word[at]])
        return a[first], b[first], c[first], role[first], n


@dataclass
class Names:
    """Symbols as numbers: bytes first, then what merges build, in order. Equal hex strings are one symbol."""

    hexes: list[str] = field(default_factory=lambda: [f"{b:02X}" for b in range(256)])
    number: dict[str, int] = field(default_factory=lambda: {f"{b:02X}": b for b in range(256)})

    def add(self, symbol: str) -> int:
        if symbol not in self.number:
            self.number[symbol] = len(self.hexes)
            self.hexes.append(symbol)
        return self.number[symbol]

    def keys(self, pairs: Sequence[Pair]) -> np.ndarray:
        return np.array([self.number[a] << 32 | self.number[b] for a, b in pairs], np.int64)


def _rows(kind: int, n: np.ndarray, *symbols: np.ndarray) -> pa.RecordBatch:
    """Rows of one kind; columns that are not given are NULL."""
    numbers = [pa.array(column, pa.int64()) for column in symbols]
    numbers += [pa.nulls(len(n), pa.int64())] * (4 - len(numbers))
    a, b, c, outer = numbers
    arrays = [pa.array(np.full(len(n), kind), pa.int32()), a, b, c, pa.array(n, pa.int64()), outer, pa.nulls(len(n), pa.binary())]
    return pa.RecordBatch.from_arrays(arrays, names=["kind", "a", "b", "c", "n", "outer", "block"])


def _context_rows(block: WordBlock, keys: np.ndarray) -> Iterator[pa.RecordBatch]:
    """Of each candidate and side the greatest count of a triple in this block, and all triples of two candidates."""
    a, b, c, role, n = block.contexts(keys)
    both = role == 3
    yield _rows(OVERLAP, n[both], a[both], b[both], c[both])
    for side, mask, left, right, outer in ((AFTER, role & 1 > 0, a, b, c), (BEFORE, role & 2 > 0, b, c, a)):
        pair, count, outer = keys_of(left[mask], right[mask]), n[mask], outer[mask]
        order = np.lexsort((count, pair))
        best = order[np.append(np.diff(pair[order]) != 0, True)[: len(order)]]
        yield _rows(CONTEXT, count[best], pair[best] >> 32, pair[best] & LOW, np.full(len(best), side), outer[best])


def _block_row(block: WordBlock) -> pa.RecordBatch:
    row = _rows(BLOCK, np.array([len(block.length)]))
    return row.set_column(6, "block", pa.array([block.to_bytes()], pa.binary()))


def build_blocks(words: DataFrame, tasks: int) -> DataFrame:
    """Blocks of a word table ``(sym, cnt)`` at byte level, in so many even partitions; words without a pair are left out."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []

        def block() -> pa.RecordBatch:
            return _block_row(WordBlock.of(*(np.concatenate(part) for part in zip(*held))))

        for batch in batches:
            sizes = pc.binary_length(batch.column(0)).to_numpy(zero_copy_only=False).astype(np.int64)
            data = np.frombuffer("".join(batch.column(0).to_pylist()).encode(), np.uint8)
            if (sizes % 4).any() or (data[::4] != ord("<")).any():
                raise ValueError("words are given byte by byte")
            digits = np.where(data >= ord("A"), data - (ord("A") - 10), data - ord("0")).reshape(-1, 4)
            held.append((digits[:, 1] * 16 + digits[:, 2], sizes // 4, batch.column(1).to_numpy(zero_copy_only=False).astype(np.int64)))
            if sum(len(h[1]) for h in held) >= BLOCK_WORDS:
                yield block()
                held.clear()
        if held:
            yield block()

    return words.filter("instr(sym, '><') > 0").select("sym", "cnt").repartition(tasks).mapInArrow(run, SCHEMA)


def blocks_of(rows: DataFrame) -> DataFrame:
    return rows.filter(F.col("kind") == BLOCK)


def all_pair_counts(rows: DataFrame, names: Names) -> DataFrame:
    """``(l, r, n)`` counted anew over all blocks, with symbols as hex strings."""
    hexes = rows.sparkSession.sparkContext.broadcast(names.hexes)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for data in batch.column(0):
                keys, n = WordBlock.from_bytes(data.as_buffer()).pair_counts()
                symbols = pa.array(hexes.value, pa.string())
                sides = [symbols.take(pa.array(side)) for side in (keys >> 32, keys & LOW)]
                yield pa.RecordBatch.from_arrays([*sides, pa.array(n, pa.int64())], names=["l", "r", "n"])

    counted = blocks_of(rows).select("block").mapInArrow(run, "l string, r string, n bigint")
    return counted.groupBy("l", "r").agg(F.sum("n").alias("n"))


def candidate_contexts(rows: DataFrame, candidates: Sequence[Pair], names: Names) -> DataFrame:
    """Rows of kind CONTEXT and OVERLAP of the candidates, not yet added up."""
    keys = np.sort(names.keys(candidates))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for data in batch.column(0):
                yield from _context_rows(WordBlock.from_bytes(data.as_buffer()), keys)

    return blocks_of(rows).select("block").mapInArrow(run, SCHEMA)


def merge_blocks(
    rows: DataFrame, merges: Sequence[Pair], followed: Sequence[Pair], candidates: Sequence[Pair], names: Names
) -> DataFrame:
    """Blocks after the merges, with rows for the changes they made and the contexts of the next candidates.

    ``names`` has the built symbols already.
    """
    keys = names.keys(merges)
    built = np.array([names.number[a + b] for a, b in merges], np.int64)[np.argsort(keys)]
    keys, watched, asked = np.sort(keys), np.sort(names.keys(followed)), np.sort(names.keys(candidates))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for data in batch.column(0):
                block = WordBlock.from_bytes(data.as_buffer())
                pairs, change, made, counts = block.merge(keys, built, watched)
                yield _block_row(block)
                yield _rows(CHANGE, change, pairs >> 32, pairs & LOW)
                yield _rows(CREATED, counts, made >> 32, made & LOW)
                if len(asked):
                    yield from _context_rows(block, asked)

    return blocks_of(rows).select("block").mapInArrow(run, SCHEMA)


def added_up(rows: DataFrame) -> DataFrame:
    """Changes, new counts and contexts over all blocks.

    The greatest triple of a candidate is bounded by the sum of the greatest ones of the blocks.
    """
    told = rows.filter(F.col("kind") != BLOCK)
    return told.groupBy("kind", "a", "b", "c").agg(F.sum("n").alias("n"), F.max_by("outer", "n").alias("outer"))

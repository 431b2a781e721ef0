"""Distributed byte-pair training with exact greedy results.

Words stay on the executors, in blocks with an index from pairs to words. Each round merges in the
words the index names and brings back how the counts of the leading pairs changed, with the counts of
the symbol triples around them. That is enough to accept many merges at once and still give the list
that one-merge-at-a-time training gives.
"""

from __future__ import annotations

import heapq
from collections.abc import Collection, Iterable, Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F

from glyphmill.operators import pair_index
from glyphmill.operators.counts import pretoken_counts, top_pairs, words_of
from glyphmill.schemas import HEX_MERGES, NAMED_TOKENS
from glyphmill.session import local_table, write_table
from glyphmill.sources import state

# Pairs looked at per round, least and most. A pair beyond them is left to the next round, so the
# numbers change how many rounds there are and never the result.
FEWEST_LEADERS, MOST_LEADERS = 48, 384
# A second query asks for the context of the leaders when more than this many of the first ones
# were not guessed in the round before.
FIRST_LEADERS, UNKNOWN_LEADERS = 10, 2
# Rounds after which blocks and merges are committed. This also cuts the plans of the cached blocks, whose
# analysis takes twice as long with every round.
COMMIT_ROUNDS = 6
# Words of a task: it is not worth having more tasks than these make, or fewer.
LEAST_WORDS, WORDS_PER_TASK = 5_000, 500_000
# Pairs whose counts the driver follows from round to round.
FOLLOWED = 4096

Pair = pair_index.Pair


@dataclass
class TrainedMerges:
    """Merges as pairs of hex strings in creation order, and how many rounds they took."""

    merges: list[Pair] = field(default_factory=list)
    counts: list[int] = field(default_factory=list)
    rounds: int = 0


@dataclass
class Followed:
    """Exact counts of the leading pairs.

    ``floor`` is the place in greedy order, as ``(n, l, r)``, beneath which all pairs lie that are not
    followed; None if there are none. Counts of old pairs only fall, so one that is not followed stays
    beneath it.
    """

    counts: dict[Pair, int] = field(default_factory=dict)
    floor: tuple[int, str, str] | None = None

    @classmethod
    def counted(cls, pairs: DataFrame) -> Followed:
        rows = [(r["n"], r["l"], r["r"]) for r in top_pairs(pairs, FOLLOWED).collect()]
        return cls({(left, right): n for n, left, right in rows}, rows[-1] if len(rows) == FOLLOWED else None)

    def leaders(self, k: int) -> list[tuple[str, str, int]]:
        """The first ``k`` pairs in greedy order."""
        first = heapq.nlargest(k, ((n, *pair) for pair, n in self.counts.items()))
        return [(left, right, n) for n, left, right in first]

    def update(self, rows: Sequence[Row], cut: bool, names: pair_index.Names) -> None:
        """Take over changes and new pairs; with ``cut`` new pairs that are not told lie at or beneath the last one's count."""
        hexes = names.hexes
        for row in rows:
            pair = (hexes[row["a"]], hexes[row["b"]]) if row["kind"] in (pair_index.CHANGE, pair_index.CREATED) else None
            if pair:
                self.counts[pair] = row["n"] + self.counts.get(pair, 0)
        if cut:
            self.floor = max(self.floor or (0, "", ""), (rows[-1]["n"] + 1, "", ""))
        lowest = self.floor or (1, "", "")
        self.counts = {pair: n for pair, n in self.counts.items() if n > 0 and (n, *pair) >= lowest}
        if len(self.counts) > 2 * FOLLOWED:
            kept = self.leaders(FOLLOWED)
            self.counts = {(left, right): n for left, right, n in kept}
            self.floor = (kept[-1][2], *kept[-1][:2])


@dataclass
class Contexts:
    """What surrounds candidate pairs: a bound on the count of any triple that starts or ends with one, the
    counts of triples that hold two of them, and the most frequent neighbours on both sides."""

    bounds: dict[Pair, int] = field(default_factory=dict)
    overlaps: dict[tuple[str, str, str], int] = field(default_factory=dict)
    outer: dict[Pair, dict[int, str]] = field(default_factory=dict)

    @classmethod
    def read(cls, rows: Iterable[Row], candidates: Iterable[Pair], names: pair_index.Names) -> Contexts:
        found, hexes = cls(dict.fromkeys(candidates, 0)), names.hexes
        for row in rows:
            if row["kind"] == pair_index.OVERLAP:
                found.overlaps[hexes[row["a"]], hexes[row["b"]], hexes[row["c"]]] = row["n"]
            elif row["kind"] == pair_index.CONTEXT:
                pair = (hexes[row["a"]], hexes[row["b"]])
                found.bounds[pair] = max(found.bounds[pair], row["n"])
                found.outer.setdefault(pair, {})[row["c"]] = hexes[row["outer"]]
        return found

    def guess(self, leaders: Sequence[tuple[str, str, int]], chosen: Sequence[tuple[str, str, int]]) -> list[Pair]:
        """Likely leaders of the next round: those left over, and accepted pairs grown by a symbol."""
        done = {p[:2] for p in chosen}
        grown = []
        for left, right in done:
            # The neighbour may have been merged away in the same round; then the guess is idle.
            beside = self.outer.get((left, right), {})
            if pair_index.BEFORE in beside:
                grown.append((beside[pair_index.BEFORE], left + right))
            if pair_index.AFTER in beside:
                grown.append((left + right, beside[pair_index.AFTER]))
        return list(dict.fromkeys([p[:2] for p in leaders if p[:2] not in done] + grown))


def accept(
    leaders: Sequence[tuple[str, str, int]],
    bounds: dict[Pair, int],
    overlaps: dict[tuple[str, str, str], int],
    known: Collection[str],
    room: int,
) -> list[tuple[str, str, int]]:
    """Longest prefix of the greedy merge list that the counts of this round decide.

    ``leaders`` come in greedy order. A pair that shares no symbol boundary with an accepted one
    keeps its count. It is the next greedy choice as long as that count is greater than ``ceiling``,
    the most that any pair created or passed over in this round can have.
    """
    chosen: list[tuple[str, str, int]] = []
    made: set[str] = set()
    lefts: set[str] = set()
    rights: set[str] = set()
    ceiling = -1
    for left, right, n in leaders:
        if len(chosen) == room or n <= ceiling:
            break
        # Merging equal symbols, or into a symbol that exists already, changes other counts.
        special_case = left == right or left + right in known or left + right in made
        if special_case and chosen:
            break
        if right in lefts or left in rights:
            # Every triple that overlaps an accepted pair costs this pair one occurrence.
            after = sum(overlaps.get((left, right, c), 0) for a, c, _ in chosen if a == right)
            before = sum(overlaps.get((a, left, right), 0) for a, c, _ in chosen if c == left)
            ceiling = max(ceiling, n - max(after, before))
            continue
        chosen.append((left, right, n))
        if special_case:
            break
        made.add(left + right)
        lefts.add(left)
        rights.add(right)
        # Without its context known, nothing after this pair is decided.
        ceiling = max(ceiling, bounds.get((left, right), n))
    return chosen


def train_merges(
    words: DataFrame,
    n_merges: int,
    run_dir: str | None = None,
    batched: bool = True,
    commit_rounds: int = COMMIT_ROUNDS,
) -> TrainedMerges:
    """Greedy merges of a word table ``(sym, cnt)`` at byte level.

    Pairs are counted once. After that a round is one job, which merges in the words the index names and
    brings back how the counts of followed pairs changed. When the followed pairs are used up, or a merge
    builds a symbol that exists already, pairs are counted anew.

    With ``run_dir`` the blocks and the merges so far are committed there every ``commit_rounds`` rounds,
    and a later call with the same folder goes on from the last commit. A folder of another word table is
    refused.
    """
    spark = words.sparkSession
    words = write_table(words.select("sym", "cnt"), "words")
    mark = state.fingerprint(words) if run_dir else ""
    trained, names = TrainedMerges(), pair_index.Names()
    step = state.latest_step(spark, run_dir) if run_dir else None
    if step is None:
        n_words = words.count()
        tasks = max(1, min(spark.sparkContext.defaultParallelism, n_words // LEAST_WORDS), n_words // WORDS_PER_TASK)
        current, step = pair_index.build_blocks(words, tasks).persist(), 0
    else:
        tables = state.load_step(spark, run_dir, step, mark)
        for row in tables["merges"].orderBy("rank").collect():
            trained.merges.append((row["l"], row["r"]))
            trained.counts.append(row["n"])
            names.add(row["l"] + row["r"])
        trained.merges, trained.counts = trained.merges[:n_merges], trained.counts[:n_merges]
        current = tables["blocks"].persist()
    alone = current.rdd.getNumPartitions() == 1 and pair_index.blocks_of(current).count() == 1
    held: list[DataFrame] = []
    followed, contexts, n_leaders, uncommitted = None, Contexts(), FEWEST_LEADERS, 0
    while len(trained.merges) < n_merges:
        if followed is None:
            followed, contexts = Followed.counted(pair_index.all_pair_counts(current, names)), Contexts()
        room = n_merges - len(trained.merges)
        leaders = followed.leaders(n_leaders if batched and room > 1 else 1)
        if not leaders and followed.floor is None:
            break
        if not leaders:
            followed = None
            continue
        if len(leaders) > 1 and sum(p[:2] not in contexts.bounds for p in leaders[:FIRST_LEADERS]) > UNKNOWN_LEADERS:
            first = [p[:2] for p in leaders]
            rows = pair_index.added_up(pair_index.candidate_contexts(current, first, names)).collect()
            contexts = Contexts.read(rows, first, names)
        chosen = accept(leaders, contexts.bounds, contexts.overlaps, names.number, room if batched else 1)
        trained.rounds += 1
        trained.merges += [p[:2] for p in chosen]
        trained.counts += [p[2] for p in chosen]
        # Another pair may gain from a symbol that exists already: what is not followed is then unknown.
        anew = any(left + right in names.number for left, right, _ in chosen)
        for left, right, _ in chosen:
            names.add(left + right)
        if len(trained.merges) == n_merges:
            break
        n_leaders = min(max(4 * len(chosen), FEWEST_LEADERS), MOST_LEADERS)
        guess = contexts.guess(leaders, chosen)[: 2 * n_leaders] if batched else []
        merged = pair_index.merge_blocks(current, [p[:2] for p in chosen], list(followed.counts), guess, names).persist()
        rows, cut = _told(merged, followed, len(guess), alone)
        contexts = Contexts.read(rows, guess, names)
        followed = None if anew else followed
        if followed:
            followed.update(rows, cut, names)
        held.append(current)
        current, uncommitted = merged, uncommitted + 1
        if uncommitted == commit_rounds:
            uncommitted = 0
            held.append(merged)
            if run_dir:
                step += 1
                state.save_step(spark, run_dir, step, mark, blocks=pair_index.blocks_of(merged), merges=_merge_rows(spark, trained))
                current = state.load_step(spark, run_dir, step)["blocks"].persist()
            else:
                current = write_table(pair_index.blocks_of(merged), "blocks").persist()
            alone = alone and current.rdd.getNumPartitions() == 1
        # The blocks before these are no longer read.
        for old in held:
            old.unpersist()
        held = []
    current.unpersist()
    return trained


def _told(merged: DataFrame, followed: Followed, n_candidates: int, alone: bool) -> tuple[list[Row], bool]:
    """What a round brings to the driver, and whether some new pairs were left out.

    All changes and contexts, and of new pairs that may be followed the most frequent ones: at most one row
    for each followed pair, a few for each candidate and each two of them, and ``FOLLOWED`` more.
    """
    # What a single block tells is added up already.
    rows = merged.filter(F.col("kind") != pair_index.BLOCK).drop("block") if alone else pair_index.added_up(merged)
    is_new = F.col("kind") == pair_index.CREATED
    if followed.floor:
        rows = rows.filter(~is_new | (F.col("n") >= followed.floor[0]))
    most = len(followed.counts) + n_candidates * (n_candidates + 2) + FOLLOWED
    found = rows.orderBy(is_new, F.desc("n")).limit(most).collect()
    return found, len(found) == most


def _merge_rows(spark: SparkSession, trained: TrainedMerges) -> DataFrame:
    rows = [(i, l, r, n) for i, ((l, r), n) in enumerate(zip(trained.merges, trained.counts))]
    return local_table(spark, rows, HEX_MERGES)


def merges_table(spark: SparkSession, trained: TrainedMerges) -> DataFrame:
    """``(rank, left, right, n)`` with raw bytes; bounded by the vocabulary size."""
    return _merge_rows(spark, trained).select(
        "rank", F.unhex("l").alias("left"), F.unhex("r").alias("right"), "n"
    )


def assemble_vocab(merges: DataFrame, specials: Sequence[str] = ()) -> DataFrame:
    """Special tokens, then the 256 bytes, then one token per merge, with dense ids."""
    spark = merges.sparkSession
    n = len(specials)
    bytes_part = spark.range(256).select(
        (F.col("id") + n).cast("int").alias("token_id"),
        F.unhex(F.lpad(F.hex("id"), 2, "0")).alias("token"),
    )
    merge_part = merges.select(
        (F.col("rank") + n + 256).cast("int").alias("token_id"), F.concat("left", "right").alias("token")
    )
    vocab = bytes_part.unionByName(merge_part)
    if specials:
        named = local_table(spark, list(enumerate(specials)), NAMED_TOKENS)
        vocab = named.select("token_id", F.encode("t", "UTF-8").alias("token")).unionByName(vocab)
    return vocab


def train_bpe(
    docs: DataFrame,
    vocab_size: int,
    specials: Sequence[str] = (),
    text: str = "text",
    run_dir: str | None = None,
) -> tuple[DataFrame, DataFrame]:
    """Vocabulary ``(token_id, token)`` and merges ``(rank, left, right, n)`` of a corpus.

    ``vocab_size`` counts the special tokens and the 256 bytes. Training ends early when no pair is
    left.
    """
    n_merges = vocab_size - 256 - len(specials)
    if n_merges < 0:
        raise ValueError("vocab_size must hold the special tokens and 256 bytes")
    words = words_of(pretoken_counts(docs, text, specials))
    merges = merges_table(docs.sparkSession, train_merges(words, n_merges, run_dir))
    return assemble_vocab(merges, specials), merges

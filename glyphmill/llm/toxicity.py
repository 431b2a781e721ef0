"""Toxicity from class-conditional Kneser-Ney models.

By Bayes' rule the likelihood of an expression e in a class c is P(c | e) P(e) / P(c), where P(e) is
shared by the classes. P(c | e) is smoothed as Kneser and Ney do, along a chain of ever rarer
expressions: the beginnings of a word, the word, and the word with the one before it. Each takes a
discount from its class counts, and a share for its continuation count in all documents, labelled or
not, and gives both to the estimate of the expression before it in the chain; the chain starts at
P(c). So a rare expression says what its common beginning says, and one that is rare throughout says
nothing. The difference of the toxic and the ordinary log-likelihood, normalised by length, becomes a
probability.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, replace

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from glyphmill.llm.columns import chunks_of, own_name, put, text_buffer
from glyphmill.llm.pair_counts import (
    NO_PAIR,
    PACKED,
    STEP_BYTES,
    PairCounts,
    attach_counts,
    collect,
    from_planes,
    merge,
    pack,
    pair_keys,
    planes,
    sum_counts,
)
from glyphmill.llm.word_hashes import IS_LETTER, LOWER, span_hashes, word_spans
from glyphmill.operators.joins import attach_by_key
from glyphmill.session import bound_batch_bytes, write_table

# Expressions are counted by hash in this many slots, which bounds every table the executors get.
WORD_BITS = 21
WORDS = 1 << WORD_BITS
# Beginnings of words that are expressions, in bytes; the last stands for whole words.
BEGINNINGS = (3, 5, 7, None)
# Labels that are broadcast to the documents, at most; more are shuffled with them.
BROADCAST_LABELS = 1_000_000
# Word pairs that are broadcast with the model, at most; more stay in their table and texts ask for theirs.
BROADCAST_PAIRS = 1 << 24
# Word pairs a task counts before it hands them on.
PAIRS_HELD = 1 << 18
DISCOUNT = 0.9
# What a continuation of a word in the whole corpus counts against an occurrence in a labelled text.
SHARED_WEIGHT = 0.05
# An expression whose difference of log-likelihoods is above this is strong evidence, which is also
# summed apart: the small differences of hundreds of plain words would drown it.
STRONG = 2.0
N_FEATURES = 6
# Bytes of text looked at together: hashing takes some hundred bytes of memory for each.
TEXT_BYTES = 1 << 17
# Bytes of text, and texts, whose word pairs are asked for together; the numbers of the texts have 16 bits.
BLOCK_BYTES, BLOCK_TEXTS = 1 << 19, 1 << 16
# Kinds of rows: neighbours in all texts, words of class 0 and 1.
SHARED, CLASS_WORDS = 0, 1
# Left neighbours are hashed into 64 marks, and at each further level a 16th of those of the level before, so
# some level has empty marks left for any number of neighbours the slots can tell apart.
LEVELS, LEVEL_BITS = 5, 4
# Marks of the further levels that a task keeps.
MARKS_HELD = 1 << 18


@dataclass(frozen=True)
class ToxicityModel:
    """``kept[slot] + passed[slot] * backoff`` is the estimate of an expression, likewise for word pairs,
    whose counts are in ``pairs``, or in the rows of ``table`` where they are many; ``weights`` turn the
    features of a text into a log-odds."""

    prior: float
    kept: np.ndarray
    passed: np.ndarray
    pairs: PairCounts | None
    table: DataFrame | None
    weights: np.ndarray

    @property
    def pair_kept(self) -> np.ndarray:
        """What each of the pairs held here keeps."""
        return _pair_shares(*self.pairs.counts())[0]


def _words(data: np.ndarray, bounds: np.ndarray) -> tuple[list[np.ndarray], np.ndarray, np.ndarray]:
    """Slots of the beginnings of each word, its text, and the slot of the whole word before it or -1."""
    lower = LOWER[data]
    starts, ends, text = word_spans(lower, bounds, IS_LETTER[lower])
    slots = []
    for level, size in enumerate(BEGINNINGS):
        stop = ends if size is None else np.minimum(starts + size, ends)
        mixed = span_hashes(lower, starts, stop) ^ np.uint64(0xD1B54A32D192ED03 * (level + 1) % (1 << 64))
        slots.append((mixed * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(64 - WORD_BITS)).astype(np.int64))
    before = np.full(len(text), -1, np.int64)
    before[1:] = np.where(text[1:] == text[:-1], slots[-1][:-1], -1)
    return slots, text, before


def _once(text: np.ndarray, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct pairs of text and key, sorted."""
    order = np.lexsort((keys, text))
    text, keys = text[order], keys[order]
    fresh = np.ones(len(keys), bool)
    fresh[1:] = (text[1:] != text[:-1]) | (keys[1:] != keys[:-1])
    return text[fresh], keys[fresh]


def _rows(kind: int, keys: np.ndarray, n: np.ndarray, contexts: np.ndarray | None = None) -> Iterator[pa.RecordBatch]:
    for i in range(0, len(keys), 50_000):
        own = slice(i, i + 50_000)
        bits = contexts[own] if contexts is not None else np.zeros(len(keys[own]), np.uint64)
        columns = [np.full(len(bits), kind, np.int8), keys[own], n[own].astype(np.int64), bits.view(np.int64)]
        yield pa.RecordBatch.from_arrays(list(map(pa.array, columns)), names=["kind", "key", "n", "contexts"])


def _neighbours(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of a task the left neighbours of all expressions as bitmaps, a key for each level and slot."""
    seen = np.zeros(WORDS, np.uint64)
    # Marks of the further levels are few, so they are kept one by one.
    marks = np.zeros(0, np.int64)
    fresh: list[np.ndarray] = []

    def together(values: np.ndarray) -> Iterator[pa.RecordBatch]:
        keys, first = np.unique(values >> 6, return_index=True)
        bits = np.bitwise_or.reduceat(np.uint64(1) << (values & 63).astype(np.uint64), first) if len(first) else seen[:0]
        return _rows(SHARED, keys, np.zeros(len(keys), np.int64), bits)

    for batch in batches:
        data, bounds = text_buffer(batch.column(0))
        for i, j in chunks_of(bounds, TEXT_BYTES):
            slots, _, before = _words(data[bounds[i] : bounds[j]], bounds[i : j + 1] - bounds[i])
            mixed = before.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
            place = (mixed >> np.uint64(58)).astype(np.int64)
            for slot in slots:
                np.bitwise_or.at(seen, slot, np.uint64(1) << place.astype(np.uint64))
            for level in range(1, LEVELS):
                drawn = np.flatnonzero(mixed >> np.uint64(38) & np.uint64((1 << LEVEL_BITS * level) - 1) == 0)
                fresh += [(slot[drawn] | level << WORD_BITS) << 6 | place[drawn] for slot in slots]
            if sum(map(len, fresh)) >= MARKS_HELD:
                marks, fresh = np.unique(np.concatenate([marks, *fresh])), []
                if len(marks) >= MARKS_HELD:
                    yield from together(marks)
                    marks = marks[:0]
    keys = np.flatnonzero(seen)
    yield from _rows(SHARED, keys, np.zeros(len(keys), np.int64), seen[keys])
    yield from together(np.unique(np.concatenate([marks, *fresh])))


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of a task the counts of words of each class over labelled texts.

    Classes count the texts an expression is in, so a text that repeats it counts once.
    """
    # A task has less than 2**31 texts.
    by_class = np.zeros((2, WORDS), np.int32)
    for batch in batches:
        data, bounds = text_buffer(batch.column(0))
        label = batch.column(1).to_numpy(zero_copy_only=False)
        for i, j in chunks_of(bounds, TEXT_BYTES):
            slots, text, _ = _words(data[bounds[i] : bounds[j]], bounds[i : j + 1] - bounds[i])
            own = label[i:j][text]
            for kind in (0, 1):
                mine = np.flatnonzero(own == kind)
                if len(mine):
                    for slot in slots:
                        np.add.at(by_class[kind], _once(text[mine], slot[mine])[1], 1)
    for kind, n in ((CLASS_WORDS, by_class[0]), (CLASS_WORDS + 1, by_class[1])):
        keys = np.flatnonzero(n)
        yield from _rows(kind, keys, n[keys])


def _count_pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of a task the word pairs of labelled texts with the number of texts of each class that have them."""
    held: list[tuple[np.ndarray, np.ndarray]] = []
    for batch in batches:
        data, bounds = text_buffer(batch.column(0))
        label = batch.column(1).to_numpy(zero_copy_only=False)
        for i, j in chunks_of(bounds, TEXT_BYTES):
            slots, text, before = _words(data[bounds[i] : bounds[j]], bounds[i : j + 1] - bounds[i])
            text, keys = _once(text, pair_keys(before, slots[-1], WORD_BITS))
            text, keys = text[keys != NO_PAIR], keys[keys != NO_PAIR]
            held.append((keys, np.eye(2, dtype=np.uint32)[label[i:j][text]]))
            if sum(len(k) for k, _ in held) >= PAIRS_HELD:
                yield pack(*merge(held))
                held = []
    if held:
        yield pack(*merge(held))


def _labels(labels: DataFrame) -> DataFrame:
    """``(label_id, toxic)``: all rows to learn from, one for each id. Rows whose id's crc32 is divisible by five
    are never among them."""
    rows = labels.select(F.col("doc_id").cast("bigint").alias("label_id"), F.col("toxic").cast("int"))
    rows = rows.filter(F.col("toxic").isin(0, 1) & F.col("label_id").isNotNull())
    rows = rows.filter(_fold(F.col("label_id")) != 0)
    return rows.groupBy("label_id").agg(F.max("toxic").cast("tinyint").alias("toxic"))


def _fold(doc_id):
    return F.crc32(doc_id.cast("string").cast("binary")) % 5


def _smoothed(n0, n1, shared):
    """What an expression keeps of its counts for class 1, and what it passes to its backoff."""
    given = DISCOUNT * ((n0 > 0).cast("double") + (n1 > 0).cast("double")) + shared
    total = n0 + n1 + shared
    kept = F.greatest(n1 - DISCOUNT, F.lit(0.0)) / total
    return kept.cast("float").alias("kept"), (given / total).cast("float").alias("passed")


def _pair_shares(n0: np.ndarray, n1: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """What word pairs keep of their counts for class 1, and what they pass to the words; all of it without counts."""
    total = n0 + n1
    there = np.maximum(total, 1)
    return np.maximum(n1 - DISCOUNT, 0) / there, np.where(total > 0, DISCOUNT * ((n0 > 0) * 1.0 + (n1 > 0)) / there, 1.0)


def _neighbour_counts() -> Column:
    """How many left neighbours the marks of a slot tell: of the first level that is not nearly full."""
    told = []
    for level in range(LEVELS):
        empty = F.lit(64) - F.bit_count(f"contexts{level}")
        n = F.log(F.lit(64.0) / F.greatest(empty, F.lit(0.5))) * 64.0 * (1 << LEVEL_BITS * level)
        told.append(F.when(empty >= (2 if level < LEVELS - 1 else 0), n))
    return F.coalesce(*told)


def _estimate(counts: DataFrame, pairs: DataFrame, broadcast_pairs: int = BROADCAST_PAIRS) -> ToxicityModel:
    """Smoothed estimates of the expressions in labelled texts, of which the driver gets two floats each.

    An expression that labelled texts do not have keeps nothing and passes all to its backoff. All word pairs of
    labelled texts have a part in the model, also those that one text has.
    """

    def n(kind):
        return F.sum(F.when(F.col("kind") == kind, F.col("n")).otherwise(0)).cast("double")

    def contexts(level):
        here = F.shiftright("key", WORD_BITS) == level
        return F.bit_or(F.when(here, F.col("contexts")).otherwise(F.lit(0).cast("bigint")))

    words = counts.groupBy(F.col("key").bitwiseAND(F.lit(WORDS - 1)).alias("key")).agg(
        n(CLASS_WORDS).alias("n0"),
        n(CLASS_WORDS + 1).alias("n1"),
        *[contexts(level).alias(f"contexts{level}") for level in range(LEVELS)],
    )
    words = words.filter(F.col("n0") + F.col("n1") > 0)
    n0, n1 = words.agg(F.coalesce(F.sum("n0"), F.lit(0.0)), F.coalesce(F.sum("n1"), F.lit(0.0))).first()
    shared = SHARED_WEIGHT * _neighbour_counts()
    found = words.select(F.col("key").cast("int").alias("key"), *_smoothed(F.col("n0"), F.col("n1"), shared)).toArrow()
    kept, passed = np.zeros(WORDS, np.float32), np.ones(WORDS, np.float32)
    slots = found["key"].to_numpy()
    kept[slots], passed[slots] = found["kept"].to_numpy(), found["passed"].to_numpy()
    n_pairs = pairs.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    few = n_pairs <= broadcast_pairs
    held, table = (collect(pairs), None) if few else (None, pairs)
    return ToxicityModel((n1 + 1) / (n0 + n1 + 2), kept, passed, held, table, np.zeros(N_FEATURES))


def _expressions(
    model: ToxicityModel, data: np.ndarray, bounds: np.ndarray
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of the words of each text, each once with the word before it: text, word pair and the word's estimate.

    They are in the order of texts and word pairs.
    """
    slots, text, before = _words(data, bounds)
    pair = pair_keys(before, slots[-1], WORD_BITS)
    order = np.lexsort((pair, text))
    fresh = np.ones(len(order), bool)
    fresh[1:] = (text[order][1:] != text[order][:-1]) | (pair[order][1:] != pair[order][:-1])
    once = order[fresh]
    p = np.full(len(once), model.prior, np.float64)
    for slot in slots:
        p = model.kept[slot[once]] + model.passed[slot[once]] * p
    return text[once], pair[once], p.astype(np.float32)


def _sums(prior: float, text: np.ndarray, p: np.ndarray, n0: np.ndarray, n1: np.ndarray, n_texts: int) -> np.ndarray:
    """Per text: one, the log of the number of expressions, and the sums of all differences and of what
    strong ones exceed ``STRONG`` by, per expression and per root of their number."""
    kept, passed = _pair_shares(n0, n1)
    p = np.clip(kept + passed * p, 1e-6, 1 - 1e-6)
    difference = np.log(p / (1 - p)) - np.log(prior / (1 - prior))
    n = np.bincount(text, minlength=n_texts)
    at_least = np.maximum(n, 1)
    found = [np.ones(n_texts), np.log1p(n)]
    for part in (difference, np.maximum(difference - STRONG, 0)):
        total = np.bincount(text, part, n_texts)
        found += [total / at_least, total / np.sqrt(at_least)]
    return np.stack(found, axis=1)


def _features(model: ToxicityModel, data: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Features of each text, see :func:`_sums`.

    A word with the word before it counts once in a text, however often it is repeated.
    """
    text, pair, p = _expressions(model, data, bounds)
    return _sums(model.prior, text, p, *model.pairs.find(pair), len(bounds) - 1)


def _fit_weights(found: DataFrame, weight_of: dict[int, float]) -> np.ndarray:
    """Weighted logistic regression by Newton steps with a small ridge over rows of ``features`` and ``toxic``.

    A step is a job, in which every task adds up the slope and the bend of its rows.
    """
    peaks = found.agg(*[F.max(F.abs(F.element_at("features", i + 1))) for i in range(N_FEATURES)]).first()
    scale = np.maximum(np.array(peaks, np.float64), 1e-9)

    def sums(at: np.ndarray):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            total = np.zeros(N_FEATURES * (N_FEATURES + 1))
            for batch in batches:
                x = batch.column(0).flatten().to_numpy(zero_copy_only=False).reshape(-1, N_FEATURES) / scale
                label = batch.column(1).to_numpy(zero_copy_only=False)
                weight = np.where(label == 1, weight_of[1], weight_of[0])
                p = 1 / (1 + np.exp(-np.clip(x @ at, -30, 30)))
                total[:N_FEATURES] += x.T @ (weight * (label - p))
                total[N_FEATURES:] += ((x * (weight * p * (1 - p))[:, None]).T @ x).ravel()
            yield pa.RecordBatch.from_arrays([pa.array([total.tolist()], pa.list_(pa.float64()))], names=["total"])

        return run

    beta = np.zeros(N_FEATURES)
    for _ in range(50):
        # One row per task, in an order that does not depend on their numbers.
        parts = sorted(row["total"] for row in found.mapInArrow(sums(beta), "total array<double>").collect())
        total = np.sum(np.array(parts), axis=0)
        slope = total[:N_FEATURES] - 1e-3 * beta
        bend = total[N_FEATURES:].reshape(N_FEATURES, N_FEATURES) + 1e-3 * np.eye(N_FEATURES)
        step = np.linalg.solve(bend, slope)
        beta = beta + step
        if np.abs(step).max() < 1e-9:
            break
    return beta / scale


def _blocks(model: Broadcast):
    """Blocks of texts with their digests: all word pairs of a block in order, each with the estimate of its word
    and the texts that have it."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        block = TaskContext.get().partitionId() << 32
        for batch in batches:
            data, bounds = text_buffer(batch.column("text"))
            for start, stop in chunks_of(bounds, BLOCK_BYTES):
                for i in range(start, stop, BLOCK_TEXTS):
                    j = min(i + BLOCK_TEXTS, stop)
                    text, pair, p = _expressions(model.value, data[bounds[i] : bounds[j]], bounds[i : j + 1] - bounds[i])
                    order = np.lexsort((text, p, pair))
                    text, pair, p = text[order], pair[order], p[order]
                    fresh = np.ones(len(pair), bool)
                    fresh[1:] = (pair[1:] != pair[:-1]) | (p[1:] != p[:-1])
                    first = np.flatnonzero(fresh)
                    # One less than how many texts have it, which is at most BLOCK_TEXTS.
                    more = np.diff(np.append(first, len(pair))) - 1
                    # Words without one before them come last and need not be asked for.
                    steps = np.diff(pair[first[pair[first] != NO_PAIR]], prepend=0)
                    found = [planes(steps, STEP_BYTES), planes(more, 2), planes(p[first]), planes(text, 2)]
                    digests = batch.column("digest").slice(i, j - i)
                    lists = pa.ListArray.from_arrays(pa.array([0, j - i], pa.int32()), digests)
                    columns = [pa.array([block], pa.int64()), lists, *[pa.array([c], pa.binary()) for c in found]]
                    yield pa.RecordBatch.from_arrays(columns, names=["block", "digests", "pairs", "more", "p", "texts"])
                    block += 1

    return run


def _with_asked_features(docs: DataFrame, model: ToxicityModel, text: str, out: str) -> DataFrame:
    """Features where the word pairs stay in their table: blocks of texts ask for the counts of their pairs, and
    texts get what was found for their digests."""
    bound_batch_bytes(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(replace(model, table=None))
    prior, digest = model.prior, own_name(docs, "digest")
    docs = docs.withColumn(digest, F.unhex(F.md5(F.coalesce(docs[f"`{text}`"], F.lit("")).cast("binary"))))
    rows = docs.select(F.col(digest).alias("digest"), docs[f"`{text}`"].alias("text"))
    schema = "block bigint, digests array<binary>, pairs binary, more binary, p binary, texts binary"
    asked = write_table(rows.mapInArrow(_blocks(shared), schema), "asked-pairs")

    def answer(row: dict, n: np.ndarray) -> pa.RecordBatch:
        times = from_planes(row["more"], np.int64, 2) + 1
        each = np.repeat(np.arange(len(times)), times)
        n = np.concatenate([n, np.zeros((len(times) - len(n), 2), np.int64)])
        p, names = from_planes(row["p"], np.float32)[each], row["digests"]
        texts = from_planes(row["texts"], np.int64, 2)
        # In the order of texts and word pairs, in which they are added up elsewhere too.
        order = np.argsort(texts, kind="stable")
        found = _sums(prior, texts[order], p[order], n[each, 0][order], n[each, 1][order], len(names))
        lists = pa.FixedSizeListArray.from_arrays(pa.array(found.ravel()), N_FEATURES).cast(pa.list_(pa.float64()))
        return pa.RecordBatch.from_arrays([pa.array(names, pa.binary()), lists], names=["digest", "features"])

    found = attach_counts(asked, model.table, answer, "digest binary, features array<double>")
    found = found.groupBy("digest").agg(F.count(F.lit(1)).alias("uses"), F.first("features").alias(out))
    found = found.withColumnRenamed("digest", digest)
    taken = [c for c in docs.columns if c.lower() == out.lower()]
    return attach_by_key(docs.drop(*taken), found, [digest], "uses").drop(digest)


def _with_features(
    docs: DataFrame, model: ToxicityModel, text: str, out: str, shared: Broadcast | None = None
) -> DataFrame:
    """Features of texts; ``shared`` is the model as the executors have it, if they do."""
    if model.table is not None:
        return _with_asked_features(docs, model, text, out)
    shared = shared or docs.sparkSession.sparkContext.broadcast(model)

    def score(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        own = shared.value
        for texts in batches:
            data, bounds = text_buffer(texts)
            parts = [
                _features(own, data[bounds[i] : bounds[j]], bounds[i : j + 1] - bounds[i])
                for i, j in chunks_of(bounds, TEXT_BYTES)
            ]
            found = np.concatenate([np.zeros((0, N_FEATURES)), *parts])
            yield pa.FixedSizeListArray.from_arrays(pa.array(found.ravel()), N_FEATURES).cast(pa.list_(pa.float64()))

    return put(docs, {out: F.arrow_udf(score, "array<double>").asNondeterministic()(docs[f"`{text}`"])})


def train_toxicity(
    docs: DataFrame,
    labels: DataFrame,
    text: str = "text",
    doc_id: str = "doc_id",
    broadcast_labels: int = BROADCAST_LABELS,
    broadcast_pairs: int = BROADCAST_PAIRS,
) -> ToxicityModel:
    """Fit the models on ``docs`` with the labels ``(doc_id, toxic)`` of some of them.

    The shared counts cover every word of every document. The class counts come from all labelled rows but
    a fourth, which weighs the features. Rows whose id's crc32 is divisible by five teach nothing but shared
    counts. Without labels of both classes the score is the same for all texts. More than ``broadcast_pairs``
    word pairs stay in a table.
    """
    marks = write_table(_labels(labels), "labels")
    of_class = {r["toxic"]: r["n"] for r in marks.groupBy("toxic").agg(F.count(F.lit(1)).alias("n")).collect()}
    rows = docs.select(docs[f"`{doc_id}`"].cast("bigint").alias("id"), docs[f"`{text}`"].alias("text"))
    few = sum(of_class.values()) <= broadcast_labels
    marked = rows.filter(_fold(F.col("id")) != 0).join(
        F.broadcast(marks) if few else marks.hint("shuffle_merge"), F.col("id") == F.col("label_id")
    )
    schema = "kind tinyint, key bigint, n bigint, contexts bigint"
    learned = marked.filter(_fold(F.col("id")) != 4).select("text", "toxic")
    counts = (
        rows.select("text")
        .mapInArrow(_neighbours, schema)
        .unionAll(learned.mapInArrow(_count, schema))
        .groupBy("kind", "key")
        .agg(F.sum("n").alias("n"), F.bit_or("contexts").alias("contexts"))
    )
    pairs = write_table(sum_counts(learned.mapInArrow(_count_pairs, PACKED)), "class-pairs")
    model = _estimate(write_table(counts, "class-counts"), pairs, broadcast_pairs)
    shared = docs.sparkSession.sparkContext.broadcast(model) if model.table is None else None
    found = _with_features(marked.filter(_fold(F.col("id")) == 4), model, "text", "features", shared)
    found = write_table(found.select("features", "toxic"), "features")
    if shared is not None:
        shared.destroy()
    share = {r["toxic"]: r["n"] for r in found.groupBy("toxic").agg(F.count(F.lit(1)).alias("n")).collect()}
    if len(share) < 2:
        return replace(model, weights=np.array([-1.0] + [0.0] * (N_FEATURES - 1)))
    # The classes weigh as they are in the labels, a row one on average.
    mean = sum(of_class[kind] for kind in share) / sum(share.values())
    return replace(model, weights=_fit_weights(found, {kind: of_class[kind] / share[kind] / mean for kind in share}))


def score_toxicity(docs: DataFrame, model: ToxicityModel, text: str = "text", out: str = "score") -> DataFrame:
    """Add the probability that a text is toxic; NULL and texts without a word get the score of no evidence.

    Only the text is looked at, so rows that repeat score alike. Other columns stay, one named ``out``
    is replaced.
    """
    features = own_name(docs, "features")
    scored = _with_features(docs, model, text, features)
    odds = sum((F.element_at(features, i + 1) * float(w) for i, w in enumerate(model.weights)), F.lit(0.0))
    return put(scored, {out: 1 / (1 + F.exp(-odds))}).drop(features)

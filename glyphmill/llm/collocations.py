"""Phrase collocation mining over a prefix-free parse of the corpus.

Texts are lower-cased in A-Z and cut into pieces at punctuation and line ends, pieces into words. A window
of ``OVERLAP`` words whose hash is divisible by ``CHUNK_WORDS`` triggers a cut, wherever it occurs: a chunk
reaches from a trigger (or the begin of its piece) through the next trigger (or the end of the piece), so
neighbours overlap by the trigger and equal passages give equal chunks. The distinct chunks with their
parse frequencies form the dictionary, and phrases are counted in the dictionary alone, weighted. A phrase
of up to ``OVERLAP + 1`` words belongs to the chunk that owns its first word, which holds it whole; words of
the closing trigger are owned by the next chunk, so no occurrence counts twice.

Phrases of k words are counted only where both their parts of k - 1 words may be frequent: a bit map of
bounded size over hashes of the frequent parts tells. Its false alarms cost time and no result, as counts
are kept by the phrase itself.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from glyphmill.llm.columns import chunks_of, text_buffer
from glyphmill.llm.word_hashes import LOWER, joined_words, word_spans
from glyphmill.operators.joins import attach_by_key, null_safe_join
from glyphmill.session import bound_batch_bytes, write_table

MOST_WORDS = 4
OVERLAP = MOST_WORDS - 1
CHUNK_WORDS = 16
LEAST_COUNT = 30
# A phrase goes if a longer one has this share of its occurrences: KEPT_BY[0] f(longer) >= KEPT_BY[1] a.
KEPT_BY = (100, 80)
SCORE_UNITS = 2_000_000
REPORTED = 2000
NO_LANGUAGE = "und"
# Chunk bytes counted together in a task.
STEP_BYTES = 2 << 20
# Bytes of packed steps that a reader of their table takes at once.
ROW_GROUP_BYTES = 8 << 20
# Bits of the map: so many for a frequent phrase, up to the bound.
BITS_EACH, MOST_BITS = 64, 1 << 27
# Bits of one row of Spark's bit map aggregate.
ROW_BITS = 1 << 15
SALTS = 64

BREAKS_PIECE, BREAKS_WORD = np.zeros(256, bool), np.zeros(256, bool)
BREAKS_PIECE[[*b".,;:!?", *range(0x0A, 0x0E)]] = True
BREAKS_WORD[[*b" \t"]] = True
BREAKS_WORD |= BREAKS_PIECE
MULTIPLIER, SHIFT = np.uint64(0x9E3779B97F4A7C15), np.uint64(29)


def mixed(values: np.ndarray) -> np.ndarray:
    values = (values ^ (values >> SHIFT)) * MULTIPLIER
    return values ^ (values >> SHIFT)


def next_hash(so_far: np.ndarray, word: np.ndarray) -> np.ndarray:
    """Hash of phrases grown by a word."""
    return mixed(so_far * MULTIPLIER + word)


def gather(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> pa.Array:
    """Strings ``data[start:end]``, which may overlap."""
    sizes = ends - starts
    offsets = np.append(0, np.cumsum(sizes))
    place = np.repeat(starts - offsets[:-1], sizes) + np.arange(offsets[-1])
    return pa.LargeStringArray.from_buffers(len(sizes), pa.py_buffer(offsets.astype(np.int64)), pa.py_buffer(data[place]))


@dataclass
class Words:
    """Words of many texts, one after another; each is followed by one space in ``data``.

    ``starts`` has the offset of each word and the end of all, ``distinct`` the different words, each followed by
    a space, and ``own`` their hashes; ``codes`` says which of these each word is.
    """

    data: np.ndarray
    starts: np.ndarray
    distinct: pa.LargeBinaryArray
    own: np.ndarray
    codes: np.ndarray

    @classmethod
    def of(cls, data: np.ndarray, starts: np.ndarray) -> Words:
        buffers = [None, pa.py_buffer(starts.astype(np.int64)), pa.py_buffer(data)]
        coded = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(starts) - 1, buffers).dictionary_encode()
        distinct = coded.dictionary.to_pylist()
        own = np.fromiter(map(xxhash.xxh3_64_intdigest, distinct), np.uint64, len(distinct))
        return cls(data, starts, coded.dictionary, own, coded.indices.to_numpy(zero_copy_only=False))

    def __len__(self) -> int:
        return len(self.starts) - 1


def split_words(data: np.ndarray, bounds: np.ndarray) -> tuple[Words, np.ndarray, np.ndarray]:
    """Lower-cased words of texts, whether each begins a piece, and the number of its text."""
    starts, ends, text = word_spans(data, bounds, ~BREAKS_WORD[data])
    spaced, at = joined_words(LOWER[data], starts, ends)
    piece = np.cumsum(BREAKS_PIECE[data])[starts] if len(starts) else starts
    new = np.append(True, (np.diff(piece) > 0) | (np.diff(text) > 0))[: len(starts)]
    return Words.of(spaced, np.append(at, len(spaced))), new, text


def cut_chunks(words: Words, new_piece: np.ndarray, chunk_words: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of each chunk the first word, how many words it owns, and the word after its last."""
    n = len(words)
    h = words.own[words.codes]
    window = h
    for i in range(1, OVERLAP):
        window = next_hash(window[: max(n - i, 0)], h[i:])
    piece = np.cumsum(new_piece)
    whole = piece[: len(window)] == piece[OVERLAP - 1 :]
    cut = new_piece.copy()
    cut[: len(window)] |= whole & (window % np.uint64(chunk_words) == 0)
    first = np.flatnonzero(cut)
    following = np.append(first[1:], n)[: len(first)]
    piece_first = np.flatnonzero(new_piece)
    piece_end = np.append(piece_first[1:], n)[piece[first] - 1] if n else first
    return first, following - first, np.minimum(following + OVERLAP, piece_end)


def chunk_dictionary(docs: DataFrame, text: str = "text", lang: str = "lang", chunk_words: int = CHUNK_WORDS) -> DataFrame:
    """``(lang, chunk, own, freq)``: distinct chunks, how many words each owns, and how often the parse has it.

    Words of a chunk are each followed by a space. A NULL text has no chunk, a NULL language is ``und``.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, bounds = text_buffer(batch.column(1))
            for a, b in chunks_of(bounds):
                words, new, number = split_words(data[bounds[a] : bounds[b]], bounds[a : b + 1] - bounds[a])
                first, own, end = cut_chunks(words, new, chunk_words)
                # Overlaps make up to four times the bytes of a text: long ones are dealt out in steps.
                for i, j in chunks_of(np.append(0, np.cumsum(words.starts[end] - words.starts[first])), STEP_BYTES):
                    chunks = gather(words.data, words.starts[first[i:j]], words.starts[end[i:j]])
                    langs = batch.column(0).take(pa.array(a + number[first[i:j]]))
                    columns = [langs, chunks.cast(pa.string()), pa.array(own[i:j], pa.int32())]
                    yield pa.RecordBatch.from_arrays(columns, names=["lang", "chunk", "own"])

    rows = docs.select(
        F.coalesce(docs[f"`{lang}`"].cast("string"), F.lit(NO_LANGUAGE)).alias("lang"), docs[f"`{text}`"].alias("text")
    ).filter("text IS NOT NULL")
    parsed = rows.mapInArrow(run, "lang string, chunk string, own int")
    return parsed.groupBy("lang", "chunk", "own").agg(F.count(F.lit(1)).alias("freq"))


def numbered(keys: np.ndarray) -> tuple[np.ndarray, int]:
    """Numbers from 0 that are alike for equal keys, and how many there are."""
    coded = pa.array(keys).dictionary_encode()
    return coded.indices.to_numpy(zero_copy_only=False).astype(np.int64), len(coded.dictionary)


# A step as one row: words are split and hashed once, and no later pass takes chunk by chunk out of a table.
PACKED = "langs array<string>, distinct binary, own_hashes binary, codes binary, lang binary, size binary, own binary, freq binary"


@dataclass
class ChunkStep:
    """Chunks counted together: their words one after another as numbers of the distinct ones, which have a text
    and a hash, and of each chunk the number of its language, how many words it has and owns, and its frequency."""

    langs: list[str]
    distinct: pa.Array
    own_hashes: np.ndarray
    codes: np.ndarray
    lang: np.ndarray
    size: np.ndarray
    own: np.ndarray
    freq: np.ndarray

    @classmethod
    def of(cls, batch: pa.RecordBatch) -> ChunkStep:
        data, bounds = text_buffer(batch.column(1))
        starts = np.append(0, np.flatnonzero(data == 0x20) + 1)
        words, langs = Words.of(data, starts), batch.column(0).dictionary_encode()
        numbers = (langs.indices, pa.array(np.diff(np.searchsorted(starts, bounds))), batch.column(2), batch.column(3))
        lang, size, own, freq = (n.to_numpy(zero_copy_only=False) for n in numbers)
        return cls(langs.dictionary.to_pylist(), words.distinct, words.own, words.codes, lang, size, own, freq)

    def packed(self) -> pa.RecordBatch:
        kinds = (np.uint64, np.int32, np.int32, np.int32, np.int32, np.int64)
        numbers = (self.own_hashes, self.codes, self.lang, self.size, self.own, self.freq)
        words = text_buffer(self.distinct)[0].tobytes()
        binary = [words, *(n.astype(kind).tobytes() for n, kind in zip(numbers, kinds))]
        columns = [pa.array([self.langs], pa.list_(pa.string())), *(pa.array([b], pa.binary()) for b in binary)]
        return pa.RecordBatch.from_arrays(columns, names=[field.split()[0] for field in PACKED.split(", ")])

    @classmethod
    def unpacked(cls, batches: Iterator[pa.RecordBatch]) -> Iterator[ChunkStep]:
        for batch in batches:
            for i in range(len(batch)):
                langs, words, *binary = (column[i] for column in batch.columns)
                kinds = (np.uint64, np.int32, np.int32, np.int32, np.int32, np.int64)
                data = np.frombuffer(words.as_buffer(), np.uint8)
                starts = np.append(0, np.flatnonzero(data == 0x20) + 1)
                buffers = [None, pa.py_buffer(starts.astype(np.int64)), pa.py_buffer(data)]
                distinct = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(starts) - 1, buffers)
                yield cls(langs.as_py(), distinct, *(np.frombuffer(b.as_buffer(), kind) for b, kind in zip(binary, kinds)))

    def places(self, size: int) -> tuple[np.ndarray, np.ndarray]:
        """Words at which a phrase of ``size`` words begins that a chunk owns, and the chunk of each."""
        number = np.maximum(np.minimum(self.own, self.size - size + 1), 0)
        chunk = np.repeat(np.arange(len(number)), number)
        first = np.cumsum(self.size, dtype=np.int64) - self.size
        return (first - (np.cumsum(number, dtype=np.int64) - number))[chunk] + np.arange(len(chunk)), chunk

    def phrase_hashes(self, size: int) -> np.ndarray:
        """Hash of the ``size`` words from each word on, with their language; without meaning where the chunk ends before."""
        langs = np.array([xxhash.xxh3_64_intdigest(lang) for lang in self.langs], np.uint64)
        hashes = self.own_hashes[self.codes]
        found = next_hash(np.repeat(langs[self.lang], self.size), hashes)
        for i in range(1, size):
            reaches = max(len(found) - i, 0)
            found[:reaches] = next_hash(found[:reaches], hashes[i:])
        return found

    def phrases(self, place: np.ndarray, size: int) -> pa.Array:
        """Phrases of ``size`` words from the given places on."""
        spaced = text_buffer(self.distinct)
        words = gather(spaced[0], spaced[1][:-1], spaced[1][1:] - 1).cast(pa.string())
        parts = [words.take(pa.array(self.codes[place + i])) for i in range(size)]
        return parts[0] if size == 1 else pc.binary_join_element_wise(*parts, " ")

    def counts(self, size: int, bits: np.ndarray | None) -> pa.RecordBatch:
        """Weighted counts of phrases of ``size`` words whose parts may be frequent, one row for each."""
        place, chunk = self.places(size)
        if bits is not None:
            part = in_bit_map(self.phrase_hashes(size - 1), bits)
            may = part[place] & part[place + 1]
            place, chunk = place[may], chunk[may]
        key, n_keys = self.lang[chunk].astype(np.int64), len(self.langs)
        for i in range(size):
            if n_keys * len(self.distinct) >= 2**63:
                key, n_keys = numbered(key)
            key = key * len(self.distinct) + self.codes[place + i]
            n_keys *= len(self.distinct)
        code, n_keys = numbered(key)
        at = np.empty(n_keys, np.int64)
        at[code] = np.arange(len(code))
        n = np.bincount(code, self.freq[chunk], n_keys).astype(np.int64)
        columns = [
            pa.array(self.langs, pa.string()).take(pa.array(self.lang[chunk[at]])),
            self.phrases(place[at], size),
            pa.array(n, pa.int64()),
        ]
        return pa.RecordBatch.from_arrays(columns, names=["lang", "phrase", "n"])


def steps(batches: Iterator[pa.RecordBatch]) -> Iterator[ChunkStep]:
    """Batches put together to about ``STEP_BYTES`` of chunks."""
    held, size = [], 0
    for batch in batches:
        for a, b in chunks_of(text_buffer(batch.column(1))[1], STEP_BYTES):
            held.append(batch.slice(a, b - a))
            size += text_buffer(held[-1].column(1))[1][-1]
            if size >= STEP_BYTES:
                yield ChunkStep.of(pa.Table.from_batches(held).combine_chunks().to_batches()[0])
                held, size = [], 0
    if size:
        yield ChunkStep.of(pa.Table.from_batches(held).combine_chunks().to_batches()[0])


def in_bit_map(hashes: np.ndarray, bits: np.ndarray) -> np.ndarray:
    at = (hashes % np.uint64(8 * len(bits))).astype(np.int64)
    return (bits[at >> 3] >> (at & 7).astype(np.uint8)) & 1 == 1


def bit_map(phrases: DataFrame, size: int) -> np.ndarray:
    """Bits of the hashes of ``(lang, phrase)``, all of ``size`` words; at most ``MOST_BITS`` whatever their number."""
    n = phrases.count()
    width = ROW_BITS
    while width < min(BITS_EACH * n, MOST_BITS):
        width *= 2

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for step in steps(batches):
            at = step.phrase_hashes(size)[np.cumsum(step.size) - step.size] % np.uint64(width)
            columns = [pa.array(at // ROW_BITS, pa.int64()), pa.array(at % ROW_BITS, pa.int64())]
            yield pa.RecordBatch.from_arrays(columns, names=["row", "bit"])

    spaced = phrases.select("lang", F.concat("phrase", F.lit(" ")).alias("chunk"), F.lit(1).alias("own"), F.lit(1).alias("freq"))
    rows = spaced.mapInArrow(run, "row bigint, bit bigint").groupBy("row").agg(F.bitmap_construct_agg("bit").alias("bits"))
    bits = np.zeros(width // 8, np.uint8)
    for row in rows.collect():
        bits[row["row"] * ROW_BITS // 8 :][: ROW_BITS // 8] = np.frombuffer(row["bits"], np.uint8)
    return bits


def packed_steps(dictionary: DataFrame) -> DataFrame:
    """The chunks of a dictionary in packed steps, written. A step of a few MB is a row, so few rows are read together."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for step in steps(batches):
            yield step.packed()

    packed = dictionary.select("lang", "chunk", "own", "freq").mapInArrow(run, PACKED)
    return write_table(packed, "chunks", **{"parquet.block.size": ROW_GROUP_BYTES})


def word_totals(packed: DataFrame) -> DataFrame:
    """``(lang, n)``: how many words the texts of each language have."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for step in ChunkStep.unpacked(batches):
            n = np.zeros(len(step.langs), np.int64)
            np.add.at(n, step.lang, step.own * step.freq)
            yield pa.RecordBatch.from_arrays([pa.array(step.langs, pa.string()), pa.array(n)], names=["lang", "n"])

    return packed.mapInArrow(run, "lang string, n bigint").groupBy("lang").agg(F.sum("n").alias("n"))


def frequent_phrases(
    packed: DataFrame, size: int, shorter: DataFrame | None = None, least_count: int = LEAST_COUNT
) -> DataFrame:
    """``(lang, phrase, words, a)``: phrases of ``size`` words that occur ``least_count`` times, written.

    ``packed`` has the chunks in steps, ``shorter`` the frequent phrases of one word less.
    """
    bits = None if shorter is None else bit_map(shorter, size - 1)
    shared = None if bits is None else packed.sparkSession.sparkContext.broadcast(bits)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for step in ChunkStep.unpacked(batches):
            yield step.counts(size, None if shared is None else shared.value)

    found = packed.mapInArrow(run, "lang string, phrase string, n bigint")
    sums = found.groupBy("lang", "phrase").agg(F.sum("n").alias("a")).filter(F.col("a") >= least_count)
    return write_table(sums.select("lang", "phrase", F.lit(size).alias("words"), "a"), f"phrases-{size}")


def joined(parts: Column) -> Column:
    return F.array_join(parts, " ")


def lowest_cuts(phrases: DataFrame) -> DataFrame:
    """``(lang, phrase, words, a, l, r, score)`` of phrases of two words or more, by their lowest-scoring cut."""
    cuts = phrases.filter("words > 1").select(
        "lang", "phrase", "words", "a", F.split("phrase", " ").alias("parts"), F.explode(F.expr("sequence(1, words - 1)")).alias("k")
    )
    cuts = cuts.select(
        "lang",
        "phrase",
        "words",
        "a",
        "k",
        joined(F.slice("parts", F.lit(1), F.col("k"))).alias("head"),
        joined(F.slice("parts", F.col("k") + 1, F.col("words") - F.col("k"))).alias("rest"),
    )
    # The count of a part stands for how many phrases it is part of: common parts are joined apart.
    for part, count in (("head", "l"), ("rest", "r")):
        known = phrases.select("lang", F.col("phrase").alias(part), F.col("a").alias(count), F.col("a").alias("weight"))
        cuts = attach_by_key(cuts, known, ["lang", part], "weight")
    units = f"CAST({SCORE_UNITS} AS DECIMAL(8,0)) * CAST(a AS DECIMAL(20,0))"
    scored = cuts.withColumn("score", F.expr(f"({units}) div (CAST(l AS DECIMAL(20,0)) + CAST(r AS DECIMAL(20,0)))"))
    lowest = scored.groupBy("lang", "phrase", "words", "a").agg(F.min(F.struct("score", "k", "l", "r")).alias("cut"))
    return lowest.select("lang", "phrase", "words", "a", "cut.l", "cut.r", "cut.score")


def without_parts(candidates: DataFrame) -> DataFrame:
    """Candidates that no longer one contains with nearly as many occurrences."""
    inner = candidates.filter("words > 2").select("lang", "a", "words", F.split("phrase", " ").alias("parts"))
    spans = F.expr("flatten(transform(sequence(2, words - 1), k -> transform(sequence(1, words - k + 1), s -> slice(parts, s, k))))")
    covered = (
        inner.select("lang", "a", F.explode(spans).alias("span"))
        .select("lang", joined(F.col("span")).alias("phrase"), "a")
        .groupBy("lang", "phrase")
        .agg(F.max("a").alias("longer"))
    )
    # Counts of words stay far below 2**63 / 100.
    kept = null_safe_join(candidates, covered, ["lang", "phrase"], "left")
    return kept.filter(F.col("longer").isNull() | (F.col("longer") * KEPT_BY[0] < F.col("a") * KEPT_BY[1])).drop("longer")


def best_of_each(rows: DataFrame, most: int) -> DataFrame:
    """The first ``most`` rows of each language with their ``rank``, no language being one task whole."""
    order = [F.desc("score"), F.desc("a"), F.asc("phrase")]
    salted = rows.withColumn("salt", F.pmod(F.xxhash64("phrase"), F.lit(SALTS)))
    first = salted.withColumn("place", F.row_number().over(Window.partitionBy("lang", "salt").orderBy(*order)))
    few = first.filter(F.col("place") <= most).drop("salt", "place")
    return few.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order))).filter(F.col("rank") <= most)


def collocations(
    docs: DataFrame, text: str = "text", lang: str = "lang", least_count: int = LEAST_COUNT, most: int = REPORTED
) -> DataFrame:
    """``(lang, rank, phrase, a, l, r, n, score)``: the ``most`` best phrases of two to four words of each language.

    ``a`` counts the phrase, ``l`` and ``r`` the parts of its lowest-scoring cut, ``n`` all words of the
    language. Repeated documents count as often as they are there. An empty table, and a language without
    frequent phrases, give no row.
    """
    bound_batch_bytes(docs.sparkSession)
    packed = packed_steps(chunk_dictionary(docs, text, lang))
    levels: list[DataFrame] = []
    for size in range(1, MOST_WORDS + 1):
        levels.append(frequent_phrases(packed, size, levels[-1] if levels else None, least_count))
    phrases = levels[0]
    for level in levels[1:]:
        phrases = phrases.unionByName(level)
    candidates = write_table(lowest_cuts(phrases), "candidates")
    best = best_of_each(without_parts(candidates), most)
    return null_safe_join(best, word_totals(packed), ["lang"]).select(
        "lang", F.col("rank").cast("bigint").alias("rank"), "phrase", "a", "l", "r", "n", "score"
    )

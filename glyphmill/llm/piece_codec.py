"""SentencePiece encoding and decoding with the model file of a public tokenizer, by vectorised merge rounds.

The symbols of many words lie in one flat array. A round looks up the rank of every neighbouring pair,
takes the smallest rank of each word over its segment, merges the places that have it, leftmost first,
and moves the remaining symbols together, until no pair remains.

A piece counts as *touchy* if one of its merges with a neighbour ranks no later than the piece itself.
Of such a piece only the leftmost place of a word merges in a round, since the next merge may use up
symbols of the places after it. All other places of a rank are independent.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from glyphmill.llm.columns import chunks_of, own_name, put, text_buffer

# Fixed values of the model format: the mark that stands for a space, and the kinds of pieces.
SPACE = "▁"
NORMAL, UNKNOWN, CONTROL, BYTE = 1, 2, 3, 6

MAX_PIECES = 1 << 20
# Distinct words a task remembers; beyond that it starts anew.
WORDS_KEPT = 200_000
# Words merged together: their arrays stay in a processor's cache.
WORDS_AT_ONCE = 20_000
# A longer word is merged through a queue of its pairs: rounds over it would cost the square of its length.
LONG_WORD = 4096
# Decoded tokens handled together.
TOKENS_AT_ONCE = 1 << 18
NO_RANK = np.int64(1) << 40

# Cuts a text where no piece reaches across: before a mark that follows another character.
WORD = regex.compile(f"{SPACE}*[^{SPACE}]+|{SPACE}+")


@dataclass(frozen=True)
class PieceTable:
    """A piece model as arrays.

    ``keys`` are pairs ``left << 20 | right`` in ascending order, with the ``ranks`` of the pieces they
    build, their ids and whether these are touchy. ``char_ids`` has the id of each code point that is a
    piece, else -1. ``spelled`` holds the bytes of each id, ``byte_ids`` the ids of single bytes.
    """

    keys: np.ndarray
    ranks: np.ndarray
    built: np.ndarray
    touchy: np.ndarray
    char_ids: np.ndarray
    byte_ids: np.ndarray
    is_byte: np.ndarray
    is_control: np.ndarray
    spelled: tuple[bytes, ...]
    prefixed: bool


def load_pieces(path: str) -> PieceTable:
    """Read a SentencePiece model of kind BPE that has byte fallback and leaves texts as they are.

    Models with normalisation rules, unused or user-defined pieces, pieces whose characters are no
    pieces, or pieces with a space mark after another character are refused.
    """
    from sentencepiece import sentencepiece_model_pb2

    model = sentencepiece_model_pb2.ModelProto()
    with open(path, "rb") as file:
        model.ParseFromString(file.read())
    rules, trained = model.normalizer_spec, model.trainer_spec
    if trained.model_type != trained.BPE or not trained.byte_fallback or trained.treat_whitespace_as_suffix:
        raise ValueError("only BPE models with byte fallback are read")
    if rules.precompiled_charsmap or rules.remove_extra_whitespaces or not rules.escape_whitespaces:
        raise ValueError("only models that do not normalise are read")
    kinds = np.array([p.type for p in model.pieces])
    if not np.isin(kinds, [NORMAL, UNKNOWN, CONTROL, BYTE]).all() or len(kinds) > MAX_PIECES:
        raise ValueError(f"models have up to {MAX_PIECES} pieces, none unused or user-defined")
    ids = {p.piece: i for i, p in enumerate(model.pieces) if p.type == NORMAL}
    if any(SPACE in piece.lstrip(SPACE) or not set(piece) <= ids.keys() for piece in ids):
        raise ValueError("a piece has a space mark inside, or a character that is no piece")
    order = {score: rank for rank, score in enumerate(sorted({model.pieces[i].score for i in ids.values()}, reverse=True))}
    rank_of = {piece: order[model.pieces[i].score] for piece, i in ids.items()}
    pairs, touchy = [], set()
    for piece, i in ids.items():
        for cut in range(1, len(piece)):
            left, right = piece[:cut], piece[cut:]
            if left in ids and right in ids:
                pairs.append((ids[left] << 20 | ids[right], rank_of[piece], i))
                touchy.update(ids[part] for part in (left, right) if rank_of[part] >= rank_of[piece])
    keys, ranks, built = (np.array(column, np.int64) for column in zip(*sorted(pairs))) if pairs else np.zeros((3, 0), np.int64)
    char_ids = np.full(0x110000, -1, np.int32)
    for piece, i in ids.items():
        if len(piece) == 1:
            char_ids[ord(piece)] = i
    byte_ids = np.zeros(256, np.int64)
    spelled = []
    for i, p in enumerate(model.pieces):
        if p.type == BYTE:
            byte = int(p.piece[1:-1], 16)
            byte_ids[byte] = i
            spelled.append(bytes([byte]))
        else:
            surface = {CONTROL: "", UNKNOWN: trained.unk_surface}.get(p.type, p.piece.replace(SPACE, " "))
            spelled.append(surface.encode())
    is_touchy = np.isin(built, np.fromiter(touchy, np.int64, len(touchy)))
    return PieceTable(
        keys, ranks, built, is_touchy, char_ids, byte_ids, kinds == BYTE, kinds == CONTROL, tuple(spelled), rules.add_dummy_prefix
    )


def find_pairs(left: np.ndarray, right: np.ndarray, table: PieceTable) -> tuple[np.ndarray, np.ndarray]:
    """Where each pair stands in the table, and whether it does."""
    pair = left << 20 | right
    at = np.searchsorted(table.keys, pair)
    at[at == len(table.keys)] = 0
    return at, (table.keys[at] == pair) if len(table.keys) else np.zeros(len(pair), bool)


def characters(words: list[str], table: PieceTable) -> tuple[np.ndarray, np.ndarray]:
    """First symbols of all words: the ids of their characters, ``-1 - code`` where that is no piece."""
    length = np.fromiter(map(len, words), np.int64, len(words))
    codes = np.frombuffer("".join(words).encode("utf-32-le"), np.uint32).astype(np.int64)
    ids = table.char_ids[codes].astype(np.int64)
    return np.where(ids >= 0, ids, -1 - codes), length


def merge_rounds(symbols: np.ndarray, length: np.ndarray, table: PieceTable) -> tuple[np.ndarray, np.ndarray]:
    """Final symbols of words given as one flat array, word after word, and their number for each word."""
    word = np.repeat(np.arange(len(length)), length)
    counts = length.copy()
    done_symbols, done_words = [], []
    while len(symbols):
        at, known = find_pairs(symbols[:-1], symbols[1:], table)
        known &= word[:-1] == word[1:]
        rank = np.full(len(symbols), NO_RANK)
        rank[:-1][known] = table.ranks[at[known]]
        starts = np.flatnonzero(np.append(True, word[1:] != word[:-1]))
        lowest = np.repeat(np.minimum.reduceat(rank, starts), np.diff(np.append(starts, len(word))))
        open_word = lowest < NO_RANK
        done_symbols.append(symbols[~open_word])
        done_words.append(word[~open_word])
        hit = np.flatnonzero(open_word & (rank == lowest))
        if not len(hit):
            break
        # Places that follow each other directly share symbols: every second one of such a run merges.
        new_word = np.append(True, word[hit[1:]] != word[hit[:-1]])
        new_run = new_word | np.append(True, np.diff(hit) > 1)
        place = np.arange(len(hit))
        even = (place - np.maximum.accumulate(np.where(new_run, place, 0))) % 2 == 0
        # A word in which a touchy piece comes up merges its leftmost place alone.
        number = np.cumsum(new_word) - 1
        alone = np.bincount(number, table.touchy[at[hit]]) > 0
        hit = hit[np.where(alone[number], new_word, even)]
        symbols = symbols.copy()
        symbols[hit] = table.built[at[hit]]
        open_word[hit + 1] = False
        counts -= np.bincount(word[hit], minlength=len(length))
        symbols, word = symbols[open_word], word[open_word]
    if not done_symbols:
        return np.zeros(0, np.int64), counts
    order = np.argsort(np.concatenate(done_words), kind="stable")
    return np.concatenate(done_symbols)[order], counts


def merge_long(symbols: np.ndarray, table: PieceTable) -> np.ndarray:
    """Final symbols of one long word: pairs leave a queue by rank, then from left to right."""
    n = len(symbols)
    at, known = find_pairs(symbols[:-1], symbols[1:], table)
    queue = [(int(table.ranks[a]), int(i), int(table.built[a])) for i, a in zip(np.flatnonzero(known), at[known])]
    heapq.heapify(queue)
    symbol = symbols.tolist()
    # A pair is still there if the symbols its entry was made for are: each merge marks both anew.
    after, before, alive = list(range(1, n + 1)), list(range(-1, n - 1)), [True] * n
    made = {(i, b): symbol[i : i + 2] for _, i, b in queue}
    while queue:
        _, i, built = heapq.heappop(queue)
        j = after[i]
        if not alive[i] or j >= n or made.get((i, built)) != [symbol[i], symbol[j]]:
            continue
        symbol[i], alive[j] = built, False
        after[i] = after[j]
        if after[j] < n:
            before[after[j]] = i
        for a, b in ((before[i], i), (i, after[i])):
            if a >= 0 and b < n:
                place, found = find_pairs(np.array([symbol[a]]), np.array([symbol[b]]), table)
                if found[0]:
                    entry = int(table.built[place[0]])
                    made[(a, entry)] = [symbol[a], symbol[b]]
                    heapq.heappush(queue, (int(table.ranks[place[0]]), a, entry))
    return np.array([s for s, there in zip(symbol, alive) if there], np.int64)


def spell_unknown(symbols: np.ndarray, counts: np.ndarray, table: PieceTable) -> tuple[np.ndarray, np.ndarray]:
    """Ids of final symbols: a character that is no piece becomes the ids of its UTF-8 bytes."""
    unknown = np.flatnonzero(symbols < 0)
    if not len(unknown):
        return symbols, counts
    coded = [chr(-1 - s).encode() for s in symbols[unknown].tolist()]
    sizes = np.ones(len(symbols), np.int64)
    sizes[unknown] = [len(c) for c in coded]
    ends = np.cumsum(np.append(0, sizes))
    ids = np.repeat(symbols, sizes)
    ids[np.repeat(symbols < 0, sizes)] = table.byte_ids[np.frombuffer(b"".join(coded), np.uint8)]
    return ids, np.diff(ends[np.append(0, np.cumsum(counts))])


def merge_words(words: list[str], table: PieceTable) -> tuple[np.ndarray, np.ndarray]:
    """Ids of all words, one after another, and the number of ids of each word."""
    symbols, length = characters(words, table)
    ends = np.cumsum(length)
    parts, counts, first = [], [], 0
    for last in [*np.flatnonzero(length > LONG_WORD).tolist(), len(words)]:
        begin = ends[first - 1] if first else 0
        stop = ends[last - 1] if last else 0
        merged, number = merge_rounds(symbols[begin:stop], length[first:last], table)
        parts.append(merged)
        counts.append(number)
        if last < len(words):
            parts.append(merge_long(symbols[stop : ends[last]], table))
            counts.append(np.array([len(parts[-1])]))
        first = last + 1
    return spell_unknown(np.concatenate(parts), np.concatenate(counts), table)


class PieceCache:
    """Ids of the words a task has met: the number of each word, and a pool of ids."""

    def __init__(self, table: PieceTable):
        self.table = table
        self.forget()

    def forget(self) -> None:
        self.number: dict[str, int] = {}
        self.start, self.size, self.pool = (np.zeros(0, np.int64) for _ in range(3))

    def learn(self, words: list[str]) -> None:
        steps = [merge_words(words[i : i + WORDS_AT_ONCE], self.table) for i in range(0, len(words), WORDS_AT_ONCE)]
        if not steps:
            return
        ids, sizes = (np.concatenate(part) for part in zip(*steps))
        self.number.update(zip(words, range(len(self.number), len(self.number) + len(words))))
        self.start = np.append(self.start, len(self.pool) + np.cumsum(sizes) - sizes)
        self.size = np.append(self.size, sizes)
        self.pool = np.append(self.pool, ids)

    def ids_of(self, words: pa.DictionaryArray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of a sequence of words, and how many ids each word has."""
        if len(self.number) > WORDS_KEPT:
            self.forget()
        distinct = words.dictionary.to_pylist()
        self.learn([w for w in distinct if w not in self.number])
        code = np.fromiter((self.number[w] for w in distinct), np.int64, len(distinct))
        code = code[words.indices.to_numpy(zero_copy_only=False)]
        sizes = self.size[code]
        ends = np.cumsum(sizes)
        place = np.repeat(self.start[code] - (ends - sizes), sizes) + np.arange(sizes.sum())
        return self.pool[place], sizes


def encode_texts(texts: pa.Array, cache: PieceCache) -> pa.Array:
    """One list of ids per text; a NULL or empty text has none."""
    _, bounds = text_buffer(texts)
    prefix = SPACE if cache.table.prefixed else ""
    parts = []
    for first, last in chunks_of(bounds):
        words, n_words = [], []
        for text in texts.slice(first, last - first).to_pylist():
            found = WORD.findall(prefix + text.replace(" ", SPACE)) if text else []
            words += found
            n_words.append(len(found))
        ids, sizes = cache.ids_of(pa.array(words, pa.string()).dictionary_encode())
        ends = np.append(0, np.cumsum(sizes))[np.append(0, np.cumsum(n_words))]
        parts.append(pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(ids, pa.int32())))
    return pa.concat_arrays(parts) if parts else pa.array([], pa.list_(pa.int32()))


def encode(docs: DataFrame, path: str, text: str = "text", out: str = "piece_ids") -> DataFrame:
    """Add the ids of ``text`` as an array, without begin and end ids.

    NULL and ``""`` give an empty array. Any length of text or word is encoded whole. The other
    columns stay, one named ``out`` is replaced. A map without a shuffle: rows that repeat are just
    encoded again, and the words of a task are merged once.
    """
    model = docs.sparkSession.sparkContext.broadcast(load_pieces(path))

    def encode_batches(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        cache = PieceCache(model.value)
        for texts in batches:
            yield encode_texts(texts, cache)

    # Marked so that a second use of the ids does not encode again.
    udf = F.arrow_udf(encode_batches, "array<int>").asNondeterministic()
    return put(docs, {out: udf(docs[f"`{text}`"])})


def repaired(ids: np.ndarray, table: PieceTable) -> str:
    """Text of ids whose bytes are not UTF-8: in each run of byte pieces a byte that is part of no
    character becomes U+FFFD of its own."""
    out = []
    cuts = np.flatnonzero(np.diff(table.is_byte[ids].astype(np.int8))) + 1
    for run in np.split(ids, cuts):
        data = b"".join(table.spelled[i] for i in run.tolist())
        at = 0
        while at < len(data):
            try:
                out.append(data[at:].decode())
                break
            except UnicodeDecodeError as error:
                out.append(data[at : at + error.start].decode() + "�")
                at += error.start + 1
    return "".join(out)


def decode_lists(lists: pa.Array, table: PieceTable) -> pa.Array:
    """Texts of arrays of ids."""
    size = np.fromiter(map(len, table.spelled), np.int64, len(table.spelled))
    start = np.cumsum(size) - size
    spelled = np.frombuffer(b"".join(table.spelled), np.uint8)
    leads = np.array([table.prefixed and s.startswith(b" ") for s in table.spelled]) & ~table.is_byte
    leads[[i for i in range(len(leads)) if table.spelled[i].startswith(b" \xe2\x81\x87")]] = False
    bounds = np.append(0, np.cumsum(lists.value_lengths().fill_null(0).to_numpy(zero_copy_only=False)))
    flat = lists.flatten()
    if flat.null_count:
        raise ValueError("an id is NULL")
    flat = flat.to_numpy(zero_copy_only=False)
    if len(flat) and (flat.min() < 0 or flat.max() >= len(size)):
        raise ValueError("an id is outside the vocabulary")
    texts = []
    for first, last in chunks_of(bounds, TOKENS_AT_ONCE):
        ids = flat[bounds[first] : bounds[last]]
        ends = np.append(0, np.cumsum(size[ids]))
        place = np.repeat(start[ids] - ends[:-1], size[ids]) + np.arange(ends[-1])
        data = spelled[place].tobytes()
        own = bounds[first : last + 1] - bounds[first]
        # The first piece that is shown loses the space that encoding put before the text.
        shown = np.append(np.flatnonzero(~table.is_control[ids]), len(ids))
        lead = shown[np.searchsorted(shown, own[:-1])]
        strip = (lead < own[1:]) & leads[ids[np.minimum(lead, max(len(ids) - 1, 0))]] if len(ids) else np.zeros(last - first, bool)
        for i, (a, b) in enumerate(zip(own.tolist(), own[1:].tolist())):
            try:
                text = data[ends[a] : ends[b]].decode()
            except UnicodeDecodeError:
                text = repaired(ids[a:b], table)
            texts.append(text[1:] if strip[i] else text)
    return pa.array(texts, pa.string())


def decode(docs: DataFrame, path: str, ids: str = "piece_ids", out: str = "decoded") -> DataFrame:
    """Add the text of an id array; bytes that are not UTF-8 become U+FFFD, control pieces nothing.

    A NULL array gives the empty text. An id that is NULL or outside the vocabulary fails.
    """
    model = docs.sparkSession.sparkContext.broadcast(load_pieces(path))

    def decode_batches(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for lists in batches:
            yield decode_lists(lists, model.value)

    udf = F.arrow_udf(decode_batches, "string").asNondeterministic()
    return put(docs, {out: udf(docs[f"`{ids}`"])})


def recode(docs: DataFrame, path: str, text: str = "text", out: str = "pieces") -> DataFrame:
    """Add ``out``, a struct of ``ids`` and the ``decoded`` text of them, as ``encode`` and ``decode`` give them.

    One pass through Python, so each task has one worker with one copy of the model.
    """
    model = docs.sparkSession.sparkContext.broadcast(load_pieces(path))

    def recode_batches(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        cache = PieceCache(model.value)
        for texts in batches:
            ids = encode_texts(texts, cache)
            yield pa.StructArray.from_arrays([ids, decode_lists(ids, cache.table)], names=["ids", "decoded"])

    udf = F.arrow_udf(recode_batches, "struct<ids: array<int>, decoded: string>").asNondeterministic()
    return put(docs, {out: udf(docs[f"`{text}`"])})


def piece_digest(docs: DataFrame, path: str, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``(doc_id, n_tokens, ids_sha256, decoded_sha256)`` of every text.

    One row per row of ``docs``, a NULL or repeated ``doc_id`` included.
    """
    pieces = own_name(docs, "pieces")
    coded = recode(docs.select(doc_id, text), path, text, pieces)
    ids, decoded = F.col(f"{pieces}.ids"), F.col(f"{pieces}.decoded")
    return coded.select(
        F.col(doc_id).alias("doc_id"),
        F.size(ids).cast("bigint").alias("n_tokens"),
        F.sha2(F.array_join(ids.cast("array<string>"), ",").cast("binary"), 256).alias("ids_sha256"),
        F.sha2(decoded.cast("binary"), 256).alias("decoded_sha256"),
    )

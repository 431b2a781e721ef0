"""BPE encoding and decoding with a vocabulary file of a public tokenizer.

Merging runs in batched numpy rounds: the symbols of many words lie in one flat array, a binary
search over sorted pair keys gives the rank of every neighbouring pair, and each round merges the
lowest-ranked pair of every word at once.
"""

from __future__ import annotations

import json
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from glyphmill.llm.columns import chunks_of, own_name, put, text_buffer

# The published pre-token pattern of byte-level BPE vocabularies.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""

# Fixed values of the printable byte map: these bytes stand for themselves, and the n-th remaining
# byte is shown as the character 256 + n.
SHOWN_BYTES = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
HIDDEN_BYTES = [b for b in range(256) if b not in SHOWN_BYTES]
BYTE_DISPLAY = [chr(256 + HIDDEN_BYTES.index(b)) if b in HIDDEN_BYTES else chr(b) for b in range(256)]

MAX_VOCAB = 1 << 20
# Distinct words a task remembers; beyond that it starts anew.
WORDS_KEPT = 200_000
# Bytes of text looked at together: its words are Python strings of some ten times the size.
TEXT_BYTES = 1 << 18
# Words merged together: their arrays stay in a processor's cache.
WORDS_AT_ONCE = 20_000
NO_RANK = np.int64(1) << 40


@dataclass(frozen=True)
class MergeTable:
    """A byte-level BPE model as arrays.

    ``keys`` are pairs ``left << 20 | right`` in ascending order with their ``ranks`` and the id each
    builds; ``byte_ids`` are the ids of single bytes; ``tokens`` the bytes of each id.
    """

    keys: np.ndarray
    ranks: np.ndarray
    built: np.ndarray
    byte_ids: np.ndarray
    tokens: tuple[bytes, ...]
    specials: tuple[tuple[str, int], ...]


def load_merge_table(path: str) -> MergeTable:
    """Read a ``tokenizer.json`` of kind byte-level BPE. A vocabulary beyond ``MAX_VOCAB`` is refused."""
    with open(path, encoding="utf-8") as file:
        data = json.load(file)
    model, before = data["model"], data.get("pre_tokenizer") or {}
    if model.get("type") != "BPE" or before.get("type") != "ByteLevel" or before.get("add_prefix_space"):
        raise ValueError("only byte-level BPE files without a prefix space are read")
    byte_of = {shown: byte for byte, shown in enumerate(BYTE_DISPLAY)}
    vocab = model["vocab"]
    specials = tuple((t["content"], t["id"]) for t in data.get("added_tokens", []))
    size = max([*vocab.values(), *(i for _, i in specials)]) + 1
    if size > MAX_VOCAB:
        raise ValueError(f"a vocabulary holds at most {MAX_VOCAB} tokens")
    tokens = [b""] * size
    for token, i in vocab.items():
        tokens[i] = bytes(byte_of[c] for c in token)
    for token, i in specials:
        tokens[i] = token.encode()
    pairs = [pair.split(" ") if isinstance(pair, str) else pair for pair in model["merges"]]
    built = np.array([vocab[a + b] for a, b in pairs], np.int64)
    if len(np.unique(built)) < len(built):
        raise ValueError("two merges build the same token, which rounds of merges cannot follow")
    keys = np.array([vocab[a] << 20 | vocab[b] for a, b in pairs], np.int64)
    order = np.argsort(keys, kind="stable")
    byte_ids = np.array([vocab[BYTE_DISPLAY[b]] for b in range(256)], np.int64)
    return MergeTable(keys[order], order.astype(np.int64), built[order], byte_ids, tuple(tokens), specials)


def merge_words(words: list[bytes], table: MergeTable) -> tuple[np.ndarray, np.ndarray]:
    """Ids of all words, one after another, and the number of ids of each word.

    No token is built by two merges, so a merge only makes pairs of a higher rank than its own. The
    lowest pair of a word may therefore be merged at all its places in one round, leftmost first
    where places overlap. Words that have no pair left leave the rounds.
    """
    length = np.fromiter(map(len, words), np.int64, len(words))
    symbols = table.byte_ids[np.frombuffer(b"".join(words), np.uint8)]
    word = np.repeat(np.arange(len(words)), length)
    counts = length.copy()
    done_symbols, done_words = [], []
    while len(symbols):
        pair = symbols[:-1] << 20 | symbols[1:]
        at = np.searchsorted(table.keys, pair)
        at[at == len(table.keys)] = 0
        same = (word[:-1] == word[1:]) & (table.keys[at] == pair) if len(table.keys) else np.zeros(len(pair), bool)
        rank = np.full(len(symbols), NO_RANK)
        rank[:-1][same] = table.ranks[at[same]]
        starts = np.flatnonzero(np.append(True, word[1:] != word[:-1]))
        lowest = np.minimum.reduceat(rank, starts)
        sizes = np.diff(np.append(starts, len(word)))
        low = np.repeat(lowest, sizes)
        open_word = low < NO_RANK
        if not open_word.all():
            done_symbols.append(symbols[~open_word])
            done_words.append(word[~open_word])
        hit = np.flatnonzero((rank == low) & open_word)
        if not len(hit):
            break
        # Of places that follow each other directly, every second one merges.
        first = np.append(True, (np.diff(hit) > 1) | (word[hit[1:]] != word[hit[:-1]]))
        run = np.maximum.accumulate(np.where(first, np.arange(len(hit)), 0))
        hit = hit[(np.arange(len(hit)) - run) % 2 == 0]
        symbols = symbols.copy()
        symbols[hit] = table.built[at[hit]]
        keep = open_word
        keep[hit + 1] = False
        counts -= np.bincount(word[hit], minlength=len(words))
        symbols, word = symbols[keep], word[keep]
    if not done_symbols:
        return np.zeros(0, np.int64), counts
    order = np.argsort(np.concatenate(done_words), kind="stable")
    return np.concatenate(done_symbols)[order], counts


class WordCache:
    """Ids of the words a task has met: word to number, and a pool of ids."""

    def __init__(self, table: MergeTable):
        self.table = table
        self.special = dict(table.specials)
        self.clear()

    def clear(self):
        self.number: dict[str, int] = {}
        self.start, self.size, self.pool = (np.zeros(0, np.int64) for _ in range(3))

    def ids_of(self, words: pa.DictionaryArray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of a sequence of words, and how many ids each word has."""
        if len(self.number) > WORDS_KEPT:
            self.clear()
        distinct = words.dictionary.to_pylist()
        number = self.number
        new = [w for w in distinct if w not in number]
        if new:
            known = len(number)
            number.update((w, known + i) for i, w in enumerate(new))
            plain = [b"" if w in self.special else w.encode() for w in new]
            steps = [merge_words(plain[i : i + WORDS_AT_ONCE], self.table) for i in range(0, len(plain), WORDS_AT_ONCE)]
            ids, sizes = (np.concatenate(part).astype(np.int64) for part in zip(*steps))
            for i, w in enumerate(new):
                if w in self.special:
                    at = int(sizes[:i].sum())
                    ids, sizes = np.insert(ids, at, self.special[w]), sizes.copy()
                    sizes[i] = 1
            self.start = np.append(self.start, len(self.pool) + np.cumsum(sizes) - sizes)
            self.size = np.append(self.size, sizes)
            self.pool = np.append(self.pool, ids)
        code = np.fromiter((number[w] for w in distinct), np.int64, len(distinct))
        code = code[words.indices.to_numpy(zero_copy_only=False)]
        sizes = self.size[code]
        ends = np.cumsum(sizes)
        total = int(ends[-1]) if len(ends) else 0
        place = np.repeat(self.start[code] - (ends - sizes), sizes) + np.arange(total)
        return self.pool[place], sizes


def encode_texts(texts: pa.Array, find, split_specials, cache: WordCache) -> Iterator[pa.Array]:
    """One list of ids per text, in arrays of about ``TEXT_BYTES`` of text; a NULL text has no ids."""
    _, bounds = text_buffer(texts)
    for first, last in chunks_of(bounds, TEXT_BYTES):
        words, n_words = [], []
        for text in texts.slice(first, last - first).to_pylist():
            before = len(words)
            for part in split_specials(text or ""):
                if part in cache.special:
                    words.append(part)
                else:
                    words += find(part)
            n_words.append(len(words) - before)
        ids, sizes = cache.ids_of(pa.array(words, pa.string()).dictionary_encode())
        ends = np.append(0, np.cumsum(sizes))[np.append(0, np.cumsum(n_words))]
        yield pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(ids, pa.int32()))


def encode(docs: DataFrame, path: str, text: str = "text", out: str = "ids") -> DataFrame:
    """Add the ids of ``text`` as an array; special tokens that stand in a text become their ids.

    NULL and ``""`` give an empty array. Any length of text or word is encoded whole. The other
    columns stay, one named ``out`` is replaced. A map without a shuffle: rows that repeat are just
    encoded again, and the words of a task are merged once.
    """
    model = docs.sparkSession.sparkContext.broadcast(load_merge_table(path))

    def encode_batches(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        table = model.value
        cache, find = WordCache(table), regex.compile(PATTERN).findall
        names = sorted((name for name, _ in table.specials), key=len, reverse=True)
        cut = regex.compile("(" + "|".join(map(regex.escape, names)) + ")") if names else None

        def split_specials(text: str) -> list[str]:
            return [p for p in cut.split(text) if p] if cut else [text]

        for texts in batches:
            yield from encode_texts(texts, find, split_specials, cache)

    # Marked so that a second use of the ids does not encode again.
    udf = F.arrow_udf(encode_batches, "array<int>").asNondeterministic()
    return put(docs, {out: udf(docs[f"`{text}`"])})


def decode(docs: DataFrame, path: str, ids: str = "ids", out: str = "decoded") -> DataFrame:
    """Add the text of an id array; bytes that are not UTF-8 become U+FFFD, special tokens their names.

    A NULL array gives the empty text. An id that is NULL or outside the vocabulary fails.
    """
    model = docs.sparkSession.sparkContext.broadcast(load_merge_table(path))

    def decode_batches(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        tokens = model.value.tokens
        size = np.fromiter(map(len, tokens), np.int64, len(tokens))
        start = np.cumsum(size) - size
        spelled = np.frombuffer(b"".join(tokens), np.uint8)
        for lists in batches:
            n = lists.value_lengths().fill_null(0).to_numpy(zero_copy_only=False)
            bounds = np.append(0, np.cumsum(n))
            flat = lists.flatten()
            if flat.null_count:
                raise ValueError("an id is NULL")
            flat = flat.to_numpy(zero_copy_only=False)
            if len(flat) and (flat.min() < 0 or flat.max() >= len(tokens)):
                raise ValueError("an id is outside the vocabulary")
            for first, last in chunks_of(bounds, 1 << 17):
                part = flat[bounds[first] : bounds[last]]
                sizes = size[part]
                ends = np.append(0, np.cumsum(sizes))
                place = np.repeat(start[part] - ends[:-1], sizes) + np.arange(ends[-1])
                data = spelled[place].tobytes()
                cuts = ends[bounds[first : last + 1] - bounds[first]].tolist()
                yield pa.array([data[a:b].decode("utf-8", "replace") for a, b in zip(cuts, cuts[1:])], pa.string())

    udf = F.arrow_udf(decode_batches, "string").asNondeterministic()
    return put(docs, {out: udf(docs[f"`{ids}`"])})


def coding_digest(docs: DataFrame, path: str, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``(doc_id, n_tokens, ids_sha256, decoded_sha256)`` of every text, through ``encode`` and ``decode``."""
    ids = own_name(docs.select(doc_id), "ids")
    decoded = own_name(docs.select(doc_id), "decoded")
    coded = decode(encode(docs.select(doc_id, text), path, text, ids).drop(text), path, ids, decoded)
    return coded.select(
        F.col(doc_id).alias("doc_id"),
        F.size(ids).cast("bigint").alias("n_tokens"),
        F.sha2(F.array_join(F.col(ids).cast("array<string>"), ",").cast("binary"), 256).alias("ids_sha256"),
        F.sha2(F.col(decoded).cast("binary"), 256).alias("decoded_sha256"),
    )

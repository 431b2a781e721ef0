"""The inverted index of a block, and training through it, against counting everything again."""

import random
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from glyphmill.operators import bpe, counts, pair_index
from glyphmill.sources.corpus import table
from tests import brute


def make_block(words):
    symbols = np.array([ord(c) for w, _ in words for c in w], np.int64)
    return pair_index.WordBlock.of(symbols, np.array([len(w) for w, _ in words]), np.array([n for _, n in words], np.int64))


def words_in(block, names):
    found = Counter()
    for i, n in enumerate(block.count.tolist()):
        found[tuple(names[s] for s in block.select(np.array([i])).symbols.tolist())] += n
    return found


def counted(words):
    return {pair: n for pair, n in brute.pairs_of(words).items() if n}


@settings(max_examples=300, deadline=None)
@given(
    st.lists(st.tuples(st.text("abc", min_size=1, max_size=12), st.integers(1, 9)), min_size=1, max_size=12),
    st.integers(0, 10**6),
)
def test_changes_keep_the_counts_exact(words, seed):
    rng, names = random.Random(seed), {ord(c): c for c in "abc"}
    block = make_block(words)
    plain = words_in(block, names)
    followed = counted(plain)
    for step in range(14):
        pairs = counted(plain)
        if not pairs:
            break
        left, right = rng.choice(sorted(pairs))
        code = {name: i for i, name in names.items()}
        new = code.get(left + right, 1000 + step)
        fresh = new not in names
        names[new] = left + right
        code[left + right] = new
        key = {p: code[p[0]] << 32 | code[p[1]] for p in followed}
        block = pair_index.WordBlock.from_bytes(block.to_bytes())
        watched, change, made, n = block.merge(np.array([code[left] << 32 | code[right]]), np.array([new]), np.sort(list(key.values())))
        plain = brute.merge_all(plain, (left, right))
        assert words_in(block, names) == plain
        if not fresh:
            followed = counted(plain)
            continue
        pair_of = {k: p for p, k in key.items()}
        for k, c in zip(watched.tolist(), change.tolist()):
            followed[pair_of[k]] += c
        for k, c in zip(made.tolist(), n.tolist()):
            followed[names[k >> 32], names[k & pair_index.LOW]] = c
        assert {p: c for p, c in followed.items() if c} == counted(plain)


def test_contexts_are_those_of_the_words():
    rng = random.Random(2)
    words = [("".join(rng.choices("abcd", k=rng.randint(1, 9))), rng.randint(1, 5)) for _ in range(80)]
    block = make_block(words)
    asked = {("a", "b"), ("b", "c"), ("d", "d")}
    keys = np.sort([ord(a) << 32 | ord(b) for a, b in asked])
    found = {(chr(a), chr(b), chr(c)): (int(role), int(n)) for a, b, c, role, n in zip(*block.contexts(keys))}
    wanted = Counter()
    for w, n in words:
        for t in zip(w, w[1:], w[2:]):
            if t[:2] in asked or t[1:] in asked:
                wanted[t] += n
    assert found == {t: ((t[:2] in asked) + 2 * (t[1:] in asked), n) for t, n in wanted.items()}


def test_243_merges_are_the_greedy_ones(spark):
    docs = table(spark, "/root/testdata/sf0.001", "documents").select("text")
    texts = [r["text"] for r in docs.collect()]
    words = counts.words_of(counts.pretoken_counts(docs)).persist()
    trained = bpe.train_merges(words, 243)
    expected = brute.train(brute.byte_words(texts), 243)
    assert trained.merges == [(left.hex().upper(), right.hex().upper()) for (left, right), _ in expected]
    assert trained.counts == [n for _, n in expected]
    assert trained.rounds < 100


@pytest.mark.parametrize("followed", [2, 5, 40])
def test_few_followed_pairs_give_the_same_merges(spark, monkeypatch, followed):
    rng = random.Random(followed)
    rows = [" ".join("".join(rng.choices("abcde", k=rng.randint(2, 9))) for _ in range(30)) for _ in range(8)] + ["aaaa aaaaaaa " * 5]
    words = counts.words_of(counts.pretoken_counts(spark.createDataFrame([(r,) for r in rows], "text string"))).persist()
    expected = brute.train(brute.byte_words(rows), 25)
    monkeypatch.setattr(bpe, "FOLLOWED", followed)
    monkeypatch.setattr(bpe, "LEAST_WORDS", 20)
    monkeypatch.setattr(pair_index, "BLOCK_WORDS", 10)
    assert bpe.train_merges(words, 25).merges == [(a.hex().upper(), b.hex().upper()) for (a, b), _ in expected]


def test_words_of_other_symbols_are_refused(spark):
    with pytest.raises(Exception, match="byte by byte"):
        bpe.train_merges(spark.createDataFrame([("<6162><63>", 2)], "sym string, cnt bigint"), 1)


def test_blocks_are_packed_and_older_ones_are_read():
    """A block takes less than half of its arrays, and comes back as it was, packed or not."""
    rng = np.random.default_rng(4)
    length = rng.integers(1, 12, 20_000)
    block = pair_index.WordBlock.of(rng.integers(97, 123, length.sum()), length, rng.integers(1, 1 << 40, 20_000))
    assert not any(len(a) for a in block.merge(np.array([5]), np.array([300]), np.zeros(0, np.int64)))
    pair = np.array([(97 << 32) + 98, (120 << 32) + 121])
    block.merge(pair, np.array([256, 257]), np.zeros(0, np.int64))
    block.segments.append(pair_index.Segment.of(np.zeros(0, np.int64), np.zeros(0, np.int64)))
    arrays = [block.symbols, block.start, block.length, block.count]
    for s in block.segments:
        arrays += [s.keys, s.at, s.words]
    sizes = np.array([len(arrays), *map(len, arrays)], np.int64)
    plain = b"".join([sizes.tobytes(), *[a.tobytes() + bytes(-a.nbytes % 8) for a in arrays]])
    packed = block.to_bytes()
    assert len(packed) < len(plain) / 2
    for data in (packed, plain):
        again = pair_index.WordBlock.from_bytes(pa.py_buffer(data))
        found = [again.symbols, again.start, again.length, again.count]
        for s in again.segments:
            found += [s.keys, s.at, s.words]
        assert len(found) == len(arrays)
        for a, b in zip(arrays, found):
            assert a.dtype == b.dtype and (a == b).all()

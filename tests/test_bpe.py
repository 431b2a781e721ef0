import random
from collections import Counter

import pytest

from hypothesis import given, settings
from hypothesis import strategies as st

from glyphmill.operators import bpe, counts
from glyphmill.session import new_path
from glyphmill.sources import state
from tests import brute


def _statistics(words, k, asked):
    """What one round brings to the driver, computed plainly; ``asked`` picks the candidates."""
    found = brute.pairs_of(words)
    leaders = sorted(((n, *p) for p, n in found.items()), reverse=True)[:k]
    leaders = [(left, right, n) for n, left, right in leaders]
    names = {p[:2] for i, p in enumerate(leaders) if asked[i % len(asked)]}
    triples = Counter()
    for word, cnt in words.items():
        for t in zip(word, word[1:], word[2:]):
            triples[t] += cnt
    bounds, overlaps = dict.fromkeys(names, 0), {}
    for (a, b, c), n in triples.items():
        for q in {(a, b), (b, c)} & names:
            bounds[q] = max(bounds.get(q, 0), n)
        if (a, b) in names and (b, c) in names:
            overlaps[a, b, c] = n
    return leaders, bounds, overlaps


@settings(max_examples=600, deadline=None)
@given(
    st.dictionaries(st.text("abc", min_size=1, max_size=9), st.integers(1, 6), min_size=1, max_size=12),
    st.integers(1, 12),
    st.lists(st.booleans(), min_size=1, max_size=5),
)
def test_accepted_merges_are_the_greedy_ones(table, k, asked):
    words = Counter({tuple(w): n for w, n in table.items()})
    expected = brute.train(words, 40)
    done = []
    while True:
        leaders, bounds, overlaps = _statistics(words, k, asked)
        if not leaders:
            break
        known = {left + right for (left, right), _ in done}
        chosen = bpe.accept(leaders, bounds, overlaps, known, 40)
        assert chosen
        for left, right, n in chosen:
            done.append(((left, right), n))
            words = brute.merge_all(words, (left, right))
    assert done[:40] == expected


def _hex(pairs):
    return [(left.hex().upper(), right.hex().upper()) for (left, right), _ in pairs]


def _docs(spark, rows):
    return spark.createDataFrame([(r,) for r in rows], "text string")


def test_training_equals_one_merge_at_a_time(spark, texts):
    rows = [*texts, "the theme then there bathe " * 9, "abababab babab " * 4]
    expected = brute.train(brute.byte_words(rows), 40)
    words = counts.words_of(counts.pretoken_counts(_docs(spark, rows)))
    trained = bpe.train_merges(words, 40, commit_rounds=5)
    assert trained.merges == _hex(expected)
    assert trained.counts == [n for _, n in expected]
    assert trained.rounds < 35
    few = bpe.train_merges(words.repartition(7), 8, batched=False)
    assert few.merges == trained.merges[:8] and few.rounds == 8


def test_training_ends_when_no_pair_is_left(spark):
    vocab, merges = bpe.train_bpe(_docs(spark, ["ab ab", "<|x|>cd<|x|>"]), 400, ["<|x|>"])
    assert merges.count() == 3
    rows = {r["token_id"]: bytes(r["token"]) for r in vocab.collect()}
    assert rows[0] == b"<|x|>" and rows[1] == b"\x00" and rows[256] == b"\xff"
    assert sorted(rows) == list(range(260))
    assert not any(b"<|" in t for i, t in rows.items() if i)


def test_training_resumes_from_the_last_commit(spark):
    rng = random.Random(3)
    rows = [" ".join("".join(rng.choices("abcde", k=rng.randint(2, 8))) for _ in range(40)) for _ in range(10)]
    words = counts.words_of(counts.pretoken_counts(_docs(spark, rows)))
    whole = bpe.train_merges(words, 24)
    run_dir = new_path(spark, "resume")
    bpe.train_merges(words, 16, run_dir, commit_rounds=2)
    steps = state.committed_steps(spark, run_dir)
    assert len(steps) > 1
    assert len(steps) == 2
    resumed = bpe.train_merges(words, 24, run_dir, commit_rounds=2)
    with pytest.raises(ValueError):
        bpe.train_merges(words.limit(20), 24, run_dir)
    assert resumed.merges == whole.merges and resumed.counts == whole.counts


def test_a_step_without_marker_is_not_committed(spark):
    run_dir = new_path(spark, "steps")
    state.save_step(spark, run_dir, 1, t=spark.range(3))
    spark.range(3).write.parquet(f"{run_dir}/step=2/t")
    assert state.latest_step(spark, run_dir) == 1
    assert state.load_step(spark, run_dir, 1)["t"].count() == 3
    assert state.latest_step(spark, run_dir + "-none") is None

import pytest
import regex
from hypothesis import given, settings
from hypothesis import strategies as st

from glyphmill.functions import automaton
from glyphmill.functions import text as tx
from glyphmill.operators import codec
from glyphmill.operators.bpe import train_bpe
from glyphmill.operators.tokenizer import Tokenizer
from tests import brute


@settings(max_examples=800, deadline=None)
@given(st.sets(st.text("ab<|é", min_size=1, max_size=5), min_size=1, max_size=9), st.text("ab<|é", max_size=30))
def test_leftmost_longest_like_the_alternation(specials, text):
    longest = sorted(specials, key=lambda t: (-len(t), t))
    wanted = [p for p in regex.split("(" + "|".join(map(regex.escape, longest)) + ")", text) if p]
    assert automaton.split_at(text, automaton.matcher(sorted(specials))) == wanted


@pytest.fixture(scope="module")
def many():
    return [f"<|s{i}|>" for i in range(400)] + [f"<|s{i}|><|s{i}|>" for i in range(100)]


def test_many_tokens_split_and_encode_like_few(spark, many, texts):
    rows = [*texts, "a <|s7|><|s7|><|s7|>\n\n<|s399|> <|s400|>", "<|s3|>", "", None]
    docs = spark.createDataFrame(list(enumerate(rows)), "i int, text string")
    used = [t for t in many if any(t in (r or "") for r in rows)]
    found = docs.select("i", tx.special_split(docs["text"], many).alias("p"), tx.special_split(docs["text"], used).alias("q")).collect()
    assert len(used) < tx.MANY_SPECIALS and all(r["p"] == r["q"] for r in found)
    model = Tokenizer.from_tables(*train_bpe(docs, 256 + len(many) + 10, many), many)
    ranks = {p: i for i, p in enumerate(model.merges)}
    for r in codec.encode_corpus(docs, model).collect():
        assert r["ids"] == (None if r["text"] is None else brute.encode(r["text"], model.ids, ranks, many))


def test_time_does_not_grow_with_the_tokens(many):
    text = "plain words and <|s5|> more " * 2000
    parts = automaton.split_at(text, automaton.matcher(many + [f"<|long {i}|>" for i in range(20_000)]))
    assert parts.count("<|s5|>") == 2000 and "".join(parts) == text

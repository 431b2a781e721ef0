import random

import pandas as pd
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from glyphmill.operators import codec
from glyphmill.operators.bpe import train_bpe
from glyphmill.operators.tokenizer import Tokenizer
from glyphmill.session import new_path
from glyphmill.streaming import pieces
from tests import brute

SPECIALS = ["<|x|>", "<|x|><|x|>", "<a b>", " <|y|> "]
SCHEMA = "doc_id bigint, seq bigint, piece string, last boolean"


@settings(max_examples=600, deadline=None)
@given(st.lists(st.sampled_from(["a", "b1", "'", "'ll", "l", " ", "  ", "\n", "　", "。", "中", "<|x|>", "<|", "x|>", "<a", " b>", " <|y|> ", "!"]), max_size=14), st.data())
def test_both_sides_of_a_cut_encode_as_in_the_whole(parts, data):
    text = "".join(parts)
    known = data.draw(st.integers(0, len(text)))
    at = pieces.closed_length(text[:known], SPECIALS)
    split = brute.pretokens(text[:at], SPECIALS) + brute.pretokens(text[at:], SPECIALS)
    assert [t for t in split if t] == [t for t in brute.pretokens(text, SPECIALS) if t]


def test_tail_is_the_last_word():
    assert pieces.closed_length("one two  thr") == 7
    assert pieces.closed_length("one two  ") == 7
    assert pieces.closed_length("word") == 0 and pieces.closed_length("") == 0
    assert pieces.closed_length("one <a", ["<a b>"]) == 3 and pieces.closed_length("one <a b", ["<a b>"]) == 3


@pytest.fixture(scope="module")
def model(spark):
    docs = spark.createDataFrame([("the theme then there is a bathe   the\n\nend",)], "text string")
    return Tokenizer.from_tables(*train_bpe(docs, 256 + len(SPECIALS) + 12, SPECIALS), SPECIALS)


def arrivals(texts, seed):
    """Pieces of all texts, shuffled, some of them twice."""
    rng, rows = random.Random(seed), []
    for doc, text in texts.items():
        cuts = sorted(rng.randrange(len(text) + 1) for _ in range(rng.randrange(6)))
        parts = [text[a:b] for a, b in zip([0, *cuts], [*cuts, len(text)])]
        rows += [(doc, i, p or None, i == len(parts) - 1) for i, p in enumerate(parts)]
    rows += rng.choices(rows, k=len(rows) // 3)
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize("seed", [1, 2])
def test_any_cuts_and_orders_give_the_ids_of_the_whole(spark, model, texts, tmp_path, seed):
    whole = {i: t for i, t in enumerate([*texts, "the  <|x|><|x|> then <a b> <|y|> the\n", "<|x|><|x|>" * 5])}
    rows = arrivals(whole, seed)
    out = new_path(spark, "pieces")
    source = str(tmp_path / "in")
    third = len(rows) // 3 + 1
    # Three rounds of arrival, each a run of its own that goes on from the state of the one before.
    for i in range(3):
        spark.createDataFrame(rows[i * third : (i + 1) * third], SCHEMA).coalesce(1).write.mode("append").parquet(source)
        stream = spark.readStream.schema(SCHEMA).option("maxFilesPerTrigger", 1).parquet(source)
        pieces.stream_encode_pieces(stream, model, f"{out}/data", f"{out}/log").awaitTermination()
    got = {r["doc_id"]: r["ids"] for r in pieces.whole_ids(spark, f"{out}/data").collect()}
    docs = spark.createDataFrame(list(whole.items()), "doc_id bigint, text string")
    want = {r["doc_id"]: r["ids"] for r in codec.encode_corpus(docs, model).collect()}
    assert got == {doc: ids for doc, ids in want.items() if ids}


class Calls:
    """A state variable in memory that counts its calls."""

    def __init__(self):
        self.value, self.calls = None, 0

    def __getattr__(self, name):
        def call(*given):
            self.calls += 1
            if name in ("update", "put"):
                self.value = given[0]
            elif name == "appendList":
                self.value = [*(self.value or []), *given[0]]
            elif name == "clear":
                self.value = None
            return self.value is not None if name == "exists" else self.value

        return call


class Handle:
    def __init__(self):
        self.states = {}

    def make(self, name, *schemas):
        return self.states.setdefault(name, Calls())

    getValueState = getListState = getMapState = make


def processed(rounds):
    """Texts put together from rounds of rows, the calls of the state in each round, and what it holds of early pieces."""
    handle, processor = Handle(), pieces.PieceProcessor((), "bigint")
    processor.init(handle)
    texts, calls = {}, []
    for rows in rounds:
        before = sum(s.calls for s in handle.states.values())
        batch = pd.DataFrame([({"doc_id": d}, s, p, last) for d, s, p, last in rows], columns=["doc", "seq", "piece", "last"])
        for part in processor.handleInputRows((0,), iter([batch]), None):
            for doc, number, text in part.itertuples(index=False):
                assert number == len(texts.setdefault(doc, []))
                texts[doc].append(text)
        calls.append(sum(s.calls for s in handle.states.values()) - before)
    return {doc: "".join(parts) for doc, parts in texts.items()}, calls, handle.states["early"].value


def test_calls_of_the_state_do_not_grow_with_documents_and_pieces():
    rows = [(doc, s, f"p{s} of {doc} ", s == 19) for doc in range(50) for s in range(20)]
    late, first = [r for r in rows if r[1] >= 10], [r for r in rows if r[1] < 10]
    texts, calls, early = processed([late, first, rows])
    assert texts == {doc: "".join(p for d, _, p, _ in rows if d == doc) for doc in range(50)}
    assert max(calls) <= 5 and not early


@settings(max_examples=300, deadline=None)
@given(st.integers(0, 2**32), st.integers(1, 5))
def test_pieces_in_any_rounds_and_repeats_give_the_text(seed, rounds):
    rng = random.Random(seed)
    whole = {doc: "".join(rng.choice(["ab", " ", "c"]) for _ in range(rng.randrange(1, 30))) for doc in (1, 2**60 + 1, None)}
    rows = arrivals(whole, seed)
    size = len(rows) // rounds + 1
    texts, _, early = processed([rows[i : i + size] for i in range(0, len(rows), size)])
    assert texts == whole and not early


def test_a_null_id_changes_no_other(spark, model, tmp_path):
    out, source = new_path(spark, "pieces"), str(tmp_path / "in")
    for rows in ([(2**60 + 1, 1, "then", True), (None, 1, " end", True)], [(2**60 + 1, 0, "the ", False), (None, 0, "the", False)]):
        spark.createDataFrame(rows, SCHEMA).coalesce(1).write.mode("append").parquet(source)
        pieces.stream_encode_pieces(spark.readStream.schema(SCHEMA).parquet(source), model, f"{out}/data", f"{out}/log").awaitTermination()
    got = {r["doc_id"]: r["ids"] for r in pieces.whole_ids(spark, f"{out}/data").collect()}
    docs = spark.createDataFrame([(2**60 + 1, "the then"), (None, "the end")], "doc_id bigint, text string")
    assert got == {r["doc_id"]: r["ids"] for r in codec.encode_corpus(docs, model).collect()}

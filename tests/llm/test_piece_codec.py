import random

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from glyphmill.llm import piece_codec

PATH = public_tokenizers.path("piece_bpe_32k.model")
OWN = sentencepiece.SentencePieceProcessor(model_file=PATH)
TABLE = piece_codec.load_pieces(PATH)
TEXTS = [
    "",
    None,
    " ",
    "  a  b   c    ",
    " " * 1000 + "x" + " " * 37,
    "▁ ▁▁a▁b",
    "a\nb\t\r\n  c\x00d",
    "中文字符 👍🏽 naïve ﬁ x� ٣٤٥",
    "<s> </s> <unk> <0x0A>",
    "1234567890 3.14",
    "until foundation stamps tiltiltilt assails equals " * 40,
    "word " * 3000,
    "x" * 9000,
    "abcab" * 2000,
    "stamp" * 700,
    "é" * 5000 + "🙃" * 5000,
]


def test_ids_and_round_trip(make_docs):
    docs = make_docs([*enumerate(TEXTS), (0, "repeated"), (0, "repeated"), (None, "no id")]).withColumn("Piece_IDS", F.lit("mine"))
    coded = piece_codec.decode(piece_codec.encode(docs, PATH), PATH)
    assert "Piece_IDS" not in coded.columns and coded.count() == len(TEXTS) + 3
    for row in coded.collect():
        ids = OWN.encode(row["text"] or "")
        assert row["piece_ids"] == ids
        assert row["decoded"] == OWN.decode(ids)
    assert piece_codec.encode(make_docs([]), PATH).count() == 0


def test_both_ways_in_one_pass(make_docs):
    rows = piece_codec.recode(make_docs(TEXTS), PATH, out="both").collect()
    for row in rows:
        ids = OWN.encode(row["text"] or "")
        assert (row["both"]["ids"], row["both"]["decoded"]) == (ids, OWN.decode(ids))
    digests = piece_codec.piece_digest(make_docs([*TEXTS, (None, "a")]), PATH).collect()
    assert len(digests) == len(TEXTS) + 1 and {r["n_tokens"] for r in digests} >= {0}


def test_any_ids_decode_like_the_library(spark):
    rng = random.Random(3)
    some = [0, 1, 2, 3, 197, 242, 162, 132, 259, 260, 262, 264, 29871, 31999]
    lists = [[rng.choice(some) if rng.random() < 0.7 else rng.randrange(32000) for _ in range(rng.randrange(9))] for _ in range(400)]
    spelled = [TABLE.byte_ids[list(s.encode())].tolist() for s in ("👍🏽", "é中")]
    lists += [ids[i:j] for ids in spelled for i in range(len(ids)) for j in range(i, len(ids) + 1)]
    found = piece_codec.decode(spark.createDataFrame([(ids,) for ids in [*lists, None]], "piece_ids array<int>"), PATH).collect()
    assert [r["decoded"] for r in found] == [OWN.decode(ids) for ids in lists] + [""]


def test_unknown_ids_fail(spark):
    with pytest.raises(Exception, match="outside the vocabulary"):
        piece_codec.decode(spark.createDataFrame([([32000],)], "piece_ids array<int>"), PATH).collect()


@settings(max_examples=300, deadline=None)
@given(st.text(alphabet="abehinorstmplu▁ 'éß1\n", max_size=60))
def test_rounds_match_the_library(text):
    cache = piece_codec.PieceCache(TABLE)
    import pyarrow as pa

    assert piece_codec.encode_texts(pa.array([text]), cache).to_pylist() == [OWN.encode(text)]


@settings(max_examples=60, deadline=None)
@given(st.integers(0, 10**6), st.sampled_from(["stamp", "until", "ails", "thein", " ", "aeioustr", "01a "]))
def test_rounds_and_queue_agree(seed, letters):
    rng = random.Random(seed)
    word = "".join(rng.choice(letters) for _ in range(rng.randrange(1, 300))).replace(" ", "▁")
    symbols, length = piece_codec.characters([word], TABLE)
    rounds, counts = piece_codec.merge_rounds(symbols, length, TABLE)
    assert piece_codec.merge_long(symbols, TABLE).tolist() == rounds.tolist() and counts.tolist() == [len(rounds)]


def test_long_words_between_others():
    words = ["▁the", "s" * 5000, "▁and", "stamp" * 1000, "x"]
    ids, sizes = piece_codec.merge_words(words, TABLE)
    alone = [piece_codec.merge_words([w], TABLE)[0] for w in words]
    assert ids.tolist() == np.concatenate(alone).tolist() and sizes.tolist() == [len(a) for a in alone]


def test_remembering_words_changes_nothing(monkeypatch, make_docs):
    monkeypatch.setattr(piece_codec, "WORDS_KEPT", 3)
    import pyarrow as pa

    cache = piece_codec.PieceCache(TABLE)
    for text in ["one two three four five", "two six one", "six one two"]:
        assert piece_codec.encode_texts(pa.array([text]), cache).to_pylist() == [OWN.encode(text)]

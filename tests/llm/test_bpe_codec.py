import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from glyphmill.llm import bpe_codec

PATH = public_tokenizers.path("byte_bpe_50k.json")
TEXTS = [
    "",
    None,
    "a<|endoftext|>b<|endoftext|><|endoftext|>",
    "<|endoftext",
    "aaaaaaa aaa aaaaaaaaaaaaaa",
    " \n\n  x\t\r\n",
    "中文字符 👍🏽 naïve ﬁ x�",
    "word " * 400,
    "x" * 5000,
    "abcab" * 1000,
    "it's they'll I'D '' 's",
]


def plain(texts):
    own = Tokenizer.from_file(PATH)
    return [own.encode(t or "", add_special_tokens=False).ids for t in texts], own


def test_ids_and_round_trip(make_docs):
    docs = make_docs([*enumerate(TEXTS), (0, "repeated"), (0, "repeated")]).withColumn("IDS", F.lit("mine"))
    coded = bpe_codec.decode(bpe_codec.encode(docs, PATH), PATH)
    assert "IDS" not in coded.columns
    texts = [r["text"] for r in coded.collect()]
    wanted, own = plain(texts)
    for row, ids in zip(coded.collect(), wanted):
        assert row["ids"] == ids
        assert row["decoded"] == own.decode(ids, skip_special_tokens=False) == (row["text"] or "")
    assert bpe_codec.encode(make_docs([]), PATH).count() == 0


def test_parts_of_characters_decode_like_the_library(spark):
    own = Tokenizer.from_file(PATH)
    ids = own.encode("👍🏽é中").ids
    rows = [ids[:i] for i in range(len(ids) + 1)] + [ids[i:] for i in range(len(ids))] + [None, [50256]]
    found = bpe_codec.decode(spark.createDataFrame([(r,) for r in rows], "ids array<int>"), PATH).collect()
    assert [r["decoded"] for r in found] == [own.decode(r or [], skip_special_tokens=False) for r in rows]


def test_unknown_ids_fail(spark):
    df = spark.createDataFrame([([50257],)], "ids array<int>")
    with pytest.raises(Exception, match="outside the vocabulary"):
        bpe_codec.decode(df, PATH).collect()


@settings(max_examples=150, deadline=None)
@given(st.lists(st.text(alphabet="abehinort 'é", max_size=30), min_size=1, max_size=8))
def test_merge_rounds_match_the_library(words):
    table = bpe_codec.load_merge_table(PATH)
    words = [w.replace(" ", "") for w in words]
    ids, sizes = bpe_codec.merge_words([w.encode() for w in words], table)
    own = Tokenizer.from_file(PATH)
    own.pre_tokenizer = __import__("tokenizers").pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)
    assert ids.tolist() == [i for w in words for i in own.encode(w).ids]
    assert sizes.sum() == len(ids)


def test_texts_of_a_batch_are_encoded_a_few_at_a_time():
    texts = pa.array(["ab cd " * 20_000, None, *["x y"] * 100_000, "", "é" * 300_000])

    class Words:
        special = {}

        def ids_of(self, words):
            assert len(words) <= 180_000
            n = len(words)
            return np.arange(n), np.ones(n, np.int64)

    parts = list(bpe_codec.encode_texts(texts, str.split, lambda text: [text], Words()))
    assert [len(ids) for part in parts for ids in part] == [len((t or "").split()) for t in texts.to_pylist()]
    assert len(parts) >= 3

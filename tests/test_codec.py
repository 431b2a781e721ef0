import time

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from glyphmill.operators import codec
from glyphmill.operators.bpe import assemble_vocab, train_bpe
from glyphmill.operators.tokenizer import Tokenizer
from glyphmill.session import new_path
from glyphmill.sources import tokenizer_files
from tests import brute

SPECIALS = ("<|end|>", "<|end|><|end|>")


@pytest.fixture(scope="module")
def model(spark, texts):
    docs = spark.createDataFrame([(t,) for t in texts], "text string")
    return Tokenizer.from_tables(*train_bpe(docs, 256 + 2 + 40, SPECIALS), SPECIALS)


def _ids(spark, model, rows):
    docs = spark.createDataFrame(list(enumerate(rows)), "i int, text string")
    return [r["ids"] for r in codec.encode_corpus(docs, model).orderBy("i").collect()]


def test_ids_equal_plain_encoding(spark, model, texts):
    rows = [*texts, "a  <|end|><|end|><|end|>\n\nb <|end|>", "<|end|>"]
    ranks = {p: i for i, p in enumerate(model.merges)}
    expected = [brute.encode(t, model.ids, ranks, SPECIALS) for t in rows]
    assert _ids(spark, model, [*rows, None]) == [*expected, None]


def test_roundtrip(spark, model, texts):
    docs = spark.createDataFrame(list(enumerate([*texts, None, "<|end|> x"])), "i int, text string")
    coded = codec.decode_corpus(codec.encode_corpus(docs, model), model)
    assert coded.filter(~F.col("text").eqNullSafe(F.col("decoded"))).count() == 0
    audit = codec.roundtrip_audit(docs.withColumn("g", F.lit(1)), model, "g").first()
    assert audit["n_changed"] == 0 and audit["n_docs"] == len(texts) + 1
    assert audit["n_bytes"] == sum(len(t.encode()) for t in texts) + len("<|end|> x")


def test_special_tokens_stay_whole_and_the_longest_wins(spark, model):
    [ids] = _ids(spark, model, ["Hello <|end|><|end|> you<|end|>"])
    assert ids.count(model.special_ids["<|end|>"]) == 1
    assert ids.count(model.special_ids["<|end|><|end|>"]) == 1


def test_partial_characters_decode_to_the_replacement_mark(spark, model):
    rows = ["é".encode()[:1], "🙃".encode()[:3] + b"a", b"\xff\xfe", "ok".encode()]
    ids = [[model.ids[bytes([b])] for b in row] for row in rows]
    df = spark.createDataFrame(list(enumerate(ids)), "i int, ids array<int>")
    got = [r["decoded"] for r in codec.decode_corpus(df, model).orderBy("i").collect()]
    assert got == [row.decode("utf-8", errors="replace") for row in rows]


def test_unknown_id_fails(spark, model):
    df = spark.createDataFrame([([len(model.vocab)],)], "ids array<int>")
    with pytest.raises(Exception, match="unknown token id"):
        codec.decode_corpus(df, model).collect()


def test_merges_that_build_the_same_bytes(spark):
    merges = ((b"a", b"b"), (b"b", b"c"), (b"ab", b"c"), (b"a", b"bc"), (b"abc", b"d"))
    tokens = [*(bytes([b]) for b in range(256)), b"ab", b"bc", b"abc", b"abcd"]
    model = Tokenizer(dict(enumerate(tokens)), merges)
    rows = ["abc", "abcd", "bcabcd", "aabcabcd"]
    ranks = {p: i for i, p in enumerate(merges)}
    assert _ids(spark, model, rows) == [brute.encode(t, model.ids, ranks) for t in rows]


def test_files_give_the_tokenizer_back(spark, model, texts):
    docs = spark.createDataFrame([(t,) for t in texts], "text string")
    vocab, merges = train_bpe(docs, 256 + 1 + 30, SPECIALS[:1])
    folder = new_path(spark, "files")
    tokenizer_files.write_tokenizer(vocab, merges, folder)
    loaded_vocab = tokenizer_files.load_vocab(spark, f"{folder}/vocab.json")
    loaded_merges = tokenizer_files.load_merges(spark, f"{folder}/merges.txt")
    assert loaded_vocab.exceptAll(vocab).count() == 0 and loaded_vocab.count() == vocab.count()
    plain = merges.drop("n")
    assert loaded_merges.exceptAll(plain).count() == 0 and loaded_merges.count() == plain.count()
    grown = tokenizer_files.append_specials(loaded_vocab, ["<|pad|>", SPECIALS[0], "<|z|>"])
    added = grown.filter(F.col("token_id") >= vocab.count()).orderBy("token_id").collect()
    assert [(r["token_id"], bytes(r["token"])) for r in added] == [(287, b"<|pad|>"), (288, b"<|z|>")]


def test_merges_file_skips_lines_that_are_not_pairs(spark, tmp_path):
    (tmp_path / "m.txt").write_text("#version: 0.2 x\nĠ t\n\nh e \nsingle\nth e\n", encoding="utf-8")
    rows = tokenizer_files.load_merges(spark, str(tmp_path / "m.txt")).orderBy("rank").collect()
    assert [(r["rank"], bytes(r["left"]), bytes(r["right"])) for r in rows] == [
        (0, b" ", b"t"),
        (1, b"h", b"e"),
        (2, b"th", b"e"),
    ]


def test_vocabulary_without_specials_starts_with_the_bytes(spark):
    merges = spark.createDataFrame([(0, b"a", b"b")], "rank int, left binary, right binary")
    rows = {r["token_id"]: bytes(r["token"]) for r in assemble_vocab(merges).collect()}
    assert rows[97] == b"a" and rows[256] == b"ab" and len(rows) == 257


def test_a_byte_outside_the_vocabulary_fails(spark):
    tokens = [bytes([b]) for b in range(256) if b != ord("z")]
    for merges in ((), ((b"a", b"b"),), ((b"a", b"b"), (b"ab", b"c"), (b"c", b"d"))):
        model = Tokenizer(dict(enumerate([*tokens, b"ab", b"abc", b"cd"])), merges)
        assert _ids(spark, model, ["aba"])
        with pytest.raises(Exception):
            _ids(spark, model, ["azb"])


def test_many_merges_are_ready_at_once(spark):
    tokens = [*(bytes([b]) for b in range(256)), *(bytes([b % 256, b // 256]) for b in range(50_000))]
    merges = tuple((bytes([b % 256]), bytes([b // 256])) for b in range(50_000))
    model = Tokenizer(dict(enumerate(tokens)), merges)
    docs = spark.createDataFrame([("ab",)], "text string")
    started = time.time()
    encoded = codec.encode_corpus(docs, model)
    assert time.time() - started < 1
    assert encoded.first()["ids"] == [tokens.index(b"ab")]


def test_malformed_vocabularies_are_refused(spark, tmp_path):
    for name, content in (("a.json", "{\"a\": 1"), ("b.json", "[1, 2]"), ("c.json", "")):
        (tmp_path / name).write_text(content)
    for name in ("a.json", "b.json"):
        with pytest.raises(Exception):
            tokenizer_files.load_vocab(spark, str(tmp_path / name)).collect()


def test_specials_follow_the_greatest_id_and_equal_bytes_are_refused(spark):
    vocab = spark.createDataFrame([(0, b"a"), (2, b"b")], "token_id int, token binary")
    grown = tokenizer_files.append_specials(vocab, ["<|x|>"]).collect()
    assert {(r["token_id"], bytes(r["token"])) for r in grown} == {(0, b"a"), (2, b"b"), (3, b"<|x|>")}
    merges = spark.createDataFrame([], "rank int, left binary, right binary")
    twice = spark.createDataFrame([(0, b"a"), (2, b"a")], "token_id int, token binary")
    with pytest.raises(ValueError):
        tokenizer_files.write_tokenizer(twice, merges, new_path(spark, "twice"))


def test_ids_with_gaps_decode(spark):
    model = Tokenizer({0: b"a", 1_000_000_000: b"b"}, ())
    df = spark.createDataFrame([([0, 1_000_000_000],), (None,), ([],)], "ids array<int>")
    assert [r["decoded"] for r in codec.decode_corpus(df, model).collect()] == ["ab", None, ""]


def test_memory_of_encode_and_decode_follows_no_batch(spark, model):
    """Batches come out in slices of bounded length, NULL and empty rows in their places."""
    words = 3 * codec.AT_ONCE
    rows = ["a b " * 50, None, "", "the word " * (words // 2), *["z " * 1000] * 200, "<|end|>", None]
    docs = spark.createDataFrame(list(enumerate(rows)), "i int, text string").coalesce(1)
    coded = codec.decode_corpus(codec.encode_corpus(docs, model), model)
    assert [(r["i"], r["decoded"]) for r in coded.orderBy("i").collect()] == list(enumerate(rows))
    ids = pa.array([[1] * n for n in (3, 0, 5)] + [None] + [[2] * n for n in (9, 1, 1)])
    found = list(codec.short_slices(ids, 4))
    assert pa.concat_arrays(found).equals(ids)
    assert [len(s) for s in found] == [2, 1, 1, 1, 2] and list(codec.short_slices(ids[:0])) == []
    assert int(spark.conf.get("spark.sql.execution.arrow.maxBytesPerBatch")) <= 8 << 20

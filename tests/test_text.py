import pytest
from pyspark.sql import functions as F

from glyphmill.functions import text as tx
from glyphmill.operators import counts
from glyphmill.sources import corpus
from tests import brute


def _column(spark, rows, expression, kind="string"):
    df = spark.createDataFrame(list(enumerate(rows)), f"i int, v {kind}")
    return [r["x"] for r in df.select("i", expression(F.col("v")).alias("x")).orderBy("i").collect()]


def test_pretokens_equal_the_published_pattern(spark, texts):
    assert _column(spark, texts, tx.pretokens) == [brute.pretokens(t) for t in texts]


def test_null_text_has_no_pretokens(spark):
    assert _column(spark, [None, ""], tx.pretokens) == [None, []]


SPECIALS = ["<|end|>", "<|end|><|end|>", "[a.b]"]


@pytest.mark.parametrize("keep", [True, False])
def test_pretokens_with_specials(spark, keep):
    rows = [
        "hi  <|end|> there",
        "<|end|><|end|><|end|>",
        "a[a.b]b[axb] <|end|>\n\nx",
        "",
        "none",
        "🙃<|end|>🙃" * 2000,
    ]
    expected = [[t for t in brute.pretokens(r, SPECIALS) if keep or t not in SPECIALS] for r in rows]
    assert _column(spark, rows, lambda c: tx.pretokens(c, SPECIALS, keep)) == expected


def test_special_split_is_lossless_and_prefers_the_longest(spark):
    rows = ["a<|end|><|end|>b<|end|>", "<|end|>", "", None, "\n<|end|\n", "x" * 200_000 + "<|end|>"]
    parts = _column(spark, rows, lambda c: tx.special_split(c, SPECIALS))
    assert parts[0] == ["a", "<|end|><|end|>", "b", "<|end|>"]
    assert [None if p is None else "".join(p) for p in parts] == rows
    assert _column(spark, rows, lambda c: tx.special_split(c, []))[:4] == [[rows[0]], [rows[1]], [], None]


def test_invalid_bytes_are_dropped_and_the_rest_kept(spark):
    rows = [
        b"plain",
        b"\xff\xfea",
        "ok �  a b".encode() + b"\xc3",
        b"\xe2\x82 x \xf0\x9f\x98",
        b"\xed\xa0\x80",
        "�".encode(),
        b"\xc0\xafz",
    ]
    got = _column(spark, rows, lambda c: tx.drop_invalid_utf8(c.cast("string")), "binary")
    assert got == [r.decode("utf-8", errors="ignore") for r in rows]


def test_byte_display_is_reversible_and_printable(spark):
    rows = [bytes([b]) for b in range(256)] + [b" the\x00\n"]
    shown = _column(spark, rows, tx.byte_display, "binary")
    assert len(set(shown)) == 257 and all(s.isprintable() and " " not in s for s in shown)
    assert shown[32] == "Ġ" and shown[65] == "A" and shown[0] == "Ā"
    assert [bytes(b) for b in _column(spark, shown, tx.byte_parse)] == rows


def test_counts_do_not_depend_on_partitions(spark, texts):
    docs = spark.createDataFrame([(t,) for t in texts], "text string")
    expected = {}
    for t in texts:
        for w in brute.pretokens(t):
            expected[w] = expected.get(w, 0) + 1
    for n in (1, 7):
        got = counts.pretoken_counts(docs.repartition(n)).collect()
        assert {r["pretoken"]: r["cnt"] for r in got} == expected


def test_pair_counts_overlap_and_merge_left_to_right(spark):
    words = spark.createDataFrame([("<61><61><61>", 2), ("<61>", 5)], "sym string, cnt bigint")
    assert [tuple(r) for r in counts.pair_counts(words).collect()] == [("61", "61", 4)]
    merged = words.select(counts.merge_symbols(F.col("sym"), F.lit("61"), F.lit("61")).alias("s"))
    assert sorted(r["s"] for r in merged.collect()) == ["<6161><61>", "<61>"]


def test_corpus_scan_reads_documents_back(spark, tmp_path):
    docs = ["one\ntwo", "", "a <| b", "ü" * 5000]
    (tmp_path / "c.txt").write_bytes("<|endoftext|>".join(docs).encode() + b"\xff")
    got = [r["text"] for r in corpus.corpus_scan(spark, str(tmp_path / "c.txt")).collect()]
    assert got == docs
    whole = spark.createDataFrame([(d,) for d in docs], "text string")
    corpus.write_corpus(whole, str(tmp_path / "out"))
    assert sorted(r["text"] for r in corpus.corpus_scan(spark, str(tmp_path / "out")).collect()) == sorted(docs)

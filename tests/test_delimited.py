import gzip
import random

import pytest

from glyphmill.sources import delimited as dl


def cut(data, size):
    return [data[i : i + size] for i in range(0, len(data), size)]


@pytest.mark.parametrize("delimiter", [b"|", b"<|end|", b"ab"])
def test_ranges_of_any_size_give_each_document_once(delimiter):
    rng = random.Random(3)
    for _ in range(30):
        docs = [bytes(rng.choices(b"ab<|x", k=rng.randrange(12))).replace(delimiter, b"") for _ in range(20)]
        docs = [d for d in docs if delimiter not in d + delimiter[:-1]] + [b"end"]
        data = delimiter.join(docs) + rng.choice([b"", delimiter])
        expected = data.removesuffix(delimiter).split(delimiter)
        for size in (1, 2, 3, 7, 1000):
            found = []
            for start in range(0, len(data), size):
                chunks = [(data[start : start + size], True), *((c, False) for c in cut(data[start + size :], 2))]
                found += dl.owned_documents(chunks, delimiter, start == 0)
            assert found == expected


def test_delimiters_that_overlap_themselves_are_refused():
    for bad in ("", "aa", "aba"):
        with pytest.raises(ValueError):
            dl.check_delimiter(bad)


TEXTS = ["", "one", "two\nlines", "é👍" * 50_000, "", "last " * 40_000, *(f"text {i}" for i in range(2_000))]


def _texts(df):
    return sorted(r["text"] for r in df.collect())


@pytest.mark.parametrize("split", [1 << 12, 1 << 16, 1 << 30])
def test_blocked_gzip_is_read_in_ranges(spark, tmp_path, split):
    docs = spark.createDataFrame([(t,) for t in TEXTS], "text string").repartition(3)
    path = str(tmp_path / "out")
    dl.write_blocked(docs, path)
    assert not list((tmp_path / "out").glob("_writing*"))
    found = dl.read_ranges(spark, path, split=split)
    assert _texts(found) == sorted(TEXTS)
    files = sorted((tmp_path / "out").glob("*.gz"))
    # Any gzip reader reads the files.
    assert sorted(t for f in files for t in gzip.decompress(f.read_bytes()).decode().split("<|endoftext|>")[:-1]) == sorted(TEXTS)


def test_incompressible_text_fits_its_member():
    data = random.Random(1).randbytes(dl.MEMBER_TEXT)
    member = dl.gzip_member(data)
    assert dl._member_length(member) == len(member) and gzip.decompress(member) == data
    assert dl._member_text(dl.LAST_MEMBER) == b""


def test_plain_and_other_gzip_files(spark, tmp_path):
    data = "|".join(t or "-" for t in TEXTS).encode()
    folder = tmp_path / "in"
    folder.mkdir()
    (folder / "a.txt").write_bytes(data)
    (folder / "b.txt.gz").write_bytes(b"".join(gzip.compress(c) for c in cut(data, 70_000)))
    (folder / "_left.txt").write_bytes(b"not|this")
    (folder / "empty.txt").write_bytes(b"")
    found = dl.read_ranges(spark, str(folder), "|", split=10_000)
    assert _texts(found) == sorted([t or "-" for t in TEXTS] * 2)
    (tmp_path / "none").mkdir()
    assert dl.read_ranges(spark, str(tmp_path / "none")).count() == 0


def test_faults_fail_the_job(spark, tmp_path):
    bad = spark.createDataFrame([("a<|endoftext|>b",)], "text string")
    with pytest.raises(Exception, match="holds the delimiter"):
        dl.write_blocked(bad, str(tmp_path / "bad"))
    whole = gzip.compress(b"one|two" * 1000)
    (tmp_path / "cut.gz").write_bytes(whole[:-9])
    with pytest.raises(Exception, match="ends inside a member"):
        dl.read_ranges(spark, str(tmp_path / "cut.gz"), "|").count()

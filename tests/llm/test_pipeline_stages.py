"""Each stage over a table of odd rows, and over an empty one."""

import pytest
from pyspark.sql import functions as F

import corpus_pipeline

SMALL = "/root/testdata/sf0.001"
ODD = [
    (1, None, "en", "a"),
    (2, "", None, None),
    (None, "no id and token=abcdefgh", "en", "a"),
    (None, None, None, None),
    (5, "the same words in a row of the same words", "de", "b"),
    (5, "the same words in a row of the same words", "de", "b"),
    (6, "the same words in a row of the same words", "fr", "b"),
    (7, "x" * 50_000 + " " + "long words " * 3000, "es", None),
]


@pytest.mark.parametrize("name,stage", corpus_pipeline.STAGES)
def test_odd_rows_and_nothing(spark, make_docs, name, stage):
    docs = make_docs(ODD).withColumns({c: F.lit("mine") for c in ("score", "fp", "copies", "spans", "decoded")})
    kept = stage(spark, docs, SMALL).collect()
    assert stage(spark, docs.limit(0), SMALL).count() == 0
    found = stage(spark, docs, SMALL)
    if name != "bpe_codec":
        assert found.columns == docs.columns
    else:
        assert all(r["round_trip"] for r in kept) and found.columns[: len(docs.columns)] == docs.columns
    assert all(r["score"] == r["copies"] == "mine" for r in kept)
    if name in ("secret_scans", "bpe_codec"):
        assert len(kept) == len(ODD)
    if name == "simhash_near_dedup":
        assert sum("same words" in (r["text"] or "") for r in kept) == 1
    if name == "secret_scans":
        assert sum("abcdefgh" in (r["text"] or "") for r in kept) == 0

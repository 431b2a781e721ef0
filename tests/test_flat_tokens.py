import os

import numpy as np
import pytest

from glyphmill.operators import token_stream as ts
from glyphmill.sources import flat_tokens as ft

DOCS = [(7, [1, 2, 3]), (2, []), (3, [4] * 25), (1, [5, 6]), (9, list(range(100, 140)))]
FLAT = [i for _, ids in sorted(DOCS) for i in ids]


@pytest.fixture(scope="module")
def stream(spark):
    encoded = spark.createDataFrame(DOCS, "doc_id bigint, ids array<int>").repartition(3)
    return ts.token_stream(encoded, 8, 5)


@pytest.mark.parametrize("dtype", ["uint16", "uint32"])
def test_the_file_is_the_stream(spark, stream, tmp_path, dtype):
    path = str(tmp_path / "ids.bin")
    ft.write_flat_tokens(stream, path, dtype)
    assert os.listdir(tmp_path) == ["ids.bin"]
    assert np.fromfile(path, ft.DTYPES[dtype]).tolist() == FLAT
    assert ft.count_flat_tokens(path, dtype) == len(FLAT)
    rows = ft.read_flat_tokens(spark, path, dtype, block=7).orderBy("start_pos").collect()
    assert [r["start_pos"] for r in rows] == list(range(0, len(FLAT), 7))
    assert [i for r in rows for i in r["tokens"]] == FLAT


def test_an_existing_file_is_replaced_only_on_request(stream, tmp_path):
    path = tmp_path / "ids.bin"
    path.write_bytes(b"old")
    with pytest.raises(Exception):
        ft.write_flat_tokens(stream, str(path))
    assert path.read_bytes() == b"old"
    ft.write_flat_tokens(stream, str(path), overwrite=True)
    assert np.fromfile(path, "<u2").tolist() == FLAT


def test_windows_equal_those_of_the_blocks(spark, stream, tmp_path):
    path = str(tmp_path / "ids.bin")
    ft.write_flat_tokens(stream, path)
    starts = ts.window_starts(spark, len(FLAT), 4, 50, 3)
    found = {tuple(map(str, r)) for r in ft.flat_windows(starts, path, 4).collect()}
    assert found == {tuple(map(str, r)) for r in ts.context_windows(stream, 4, 50, 3).collect()}
    beyond = spark.createDataFrame([(0, len(FLAT) - 3)], "sample_id bigint, start bigint")
    with pytest.raises(Exception, match="not in the file"):
        ft.flat_windows(beyond, path, 4).collect()


def test_gaps_repeats_and_wide_ids_leave_no_file(spark, tmp_path):
    def attempt(rows, n):
        blocks = spark.createDataFrame(rows, "block_id bigint, start_pos bigint, n_tokens int, tokens array<int>")
        ft.write_flat_tokens(ts.TokenStream(blocks, n, 2, 0), str(tmp_path / "ids.bin"))

    good = [(0, 0, 2, [1, 2]), (1, 2, 2, [3, 4])]
    for rows, n in (
        (good[1:], 4),
        (good, 5),
        ([*good, good[1]], 6),
        ([(0, 0, 2, [1, 70_000])], 2),
        ([(0, 0, 2, [1, None])], 2),
        ([(0, 0, 2, [1, -1])], 2),
    ):
        with pytest.raises(Exception):
            attempt(rows, n)
        assert os.listdir(tmp_path) == []
    attempt([], 0)
    assert os.path.getsize(tmp_path / "ids.bin") == 0

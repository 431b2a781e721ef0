import pytest

from glyphmill.operators import token_stream as ts

DOCS = [(7, [1, 2, 3]), (2, []), (3, [4] * 25), (11, None), (1, [5, 6]), (9, list(range(100, 140)))]


def _encoded(spark, n=3):
    return spark.createDataFrame(DOCS, "doc_id bigint, ids array<int>").repartition(n)


def _flat(separator):
    tail = [] if separator is None else [separator]
    return [i for _, ids in sorted(DOCS) if ids is not None for i in [*ids, *tail]]


@pytest.mark.parametrize("separator", [None, 0])
@pytest.mark.parametrize("size, overlap", [(8, 0), (8, 5), (1, 3), (1000, 2)])
def test_blocks_hold_the_stream_in_order(spark, separator, size, overlap):
    stream = ts.token_stream(_encoded(spark), size, overlap, separator)
    flat = _flat(separator)
    rows = stream.blocks.orderBy("block_id").collect()
    assert stream.n_tokens == len(flat) == sum(r["n_tokens"] for r in rows)
    for i, row in enumerate(rows):
        assert row["block_id"] == i and row["start_pos"] == i * size
        assert row["tokens"] == flat[i * size : (i + 1) * size + overlap]


def test_stream_does_not_depend_on_partitions(spark):
    blocks = [
        sorted(map(str, ts.token_stream(_encoded(spark, n), 16, 4, 0).blocks.collect())) for n in (1, 9)
    ]
    assert blocks[0] == blocks[1]


def test_windows_are_slices_shifted_by_one(spark):
    stream = ts.token_stream(_encoded(spark), 8, 5, 0)
    flat = _flat(0)
    rows = ts.context_windows(stream, 5, 300, seed=1).collect()
    assert len(rows) == 300
    for r in rows:
        assert r["x"] == flat[r["start"] : r["start"] + 5]
        assert r["y"] == flat[r["start"] + 1 : r["start"] + 6]
    again = ts.context_windows(stream, 5, 300, seed=1)
    assert sorted(map(str, again.collect())) == sorted(map(str, rows))
    with pytest.raises(ValueError):
        ts.context_windows(stream, 6, 1)
    with pytest.raises(ValueError):
        ts.window_starts(spark, 5, 5, 1, 0)


def test_starts_are_uniform_over_all_valid_positions(spark):
    starts = ts.window_starts(spark, 100, 7, 32_000, seed=42)
    bins = ts.start_uniformity(starts, 93, 32_000).collect()
    assert len(bins) == 93 and all(r["inside"] for r in bins)
    assert min(r["cnt"] for r in bins) > 0
    wide = ts.start_uniformity(starts, 93, 32_000, 10).collect()
    assert len(wide) == 10 and sum(r["cnt"] for r in wide) == 32_000 and all(r["inside"] for r in wide)
    skewed = ts.start_uniformity(starts.filter("start < 50"), 93, 32_000).collect()
    assert not all(r["inside"] for r in skewed)


def test_the_only_window_is_over_range_totals_and_no_join_moves_ids(spark):
    placed = ts.placed_documents(_encoded(spark))
    plan = placed._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Window [") == 1 and "ShuffledHashJoin" not in plan and "SortMergeJoin" not in plan
    stream = ts.token_stream(_encoded(spark), 8)
    assert "Exchange" not in stream.blocks._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("extra, why", [((None, [1]), "no id"), ((9, [1]), "repeats")])
def test_documents_without_an_id_of_their_own_are_refused(spark, extra, why):
    df = spark.createDataFrame([*DOCS, extra], "doc_id bigint, ids array<int>").repartition(3)
    with pytest.raises(Exception, match=why):
        ts.token_stream(df, 8)


def test_empty_stream(spark):
    assert ts.token_stream(spark.createDataFrame([], "doc_id bigint, ids array<int>"), 8).n_tokens == 0

import numpy as np
import pytest

from glyphmill.operators import tiles

RNG = np.random.default_rng(9)


def make(spark, matrix, parts=3, kind="bigint"):
    rows = [(i if kind == "bigint" else f"k{i}", [float(v) for v in row]) for i, row in enumerate(matrix)]
    return spark.createDataFrame([*rows, (None, None)], f"id {kind}, x array<double>").repartition(parts)


def product(spark, x, w, tile_bytes, tile_width, parts=3):
    left = tiles.cut_tiles(make(spark, x, parts), "id", "x", tile_bytes, tile_width)
    right = tiles.cut_tiles(make(spark, w, parts, "string"), "id", "x", tile_bytes, tile_width)
    return left, right, tiles.tiled_product(left, right)


@pytest.mark.parametrize("tile_bytes,tile_width", [(2 << 20, 1024), (800, 7), (8, 1), (400, 50)])
def test_equals_the_plain_product(spark, tile_bytes, tile_width):
    x, w = RNG.normal(size=(23, 20)), RNG.normal(size=(11, 20))
    left, right, y = product(spark, x, w, tile_bytes, tile_width)
    assert left.n_pieces == -(-20 // min(20, tile_width))
    found = {(r["a"], r["b"]): r["v"] for r in y.long("a", "b", "v").collect()}
    assert len(found) == 23 * 11
    for i in range(23):
        for j in range(11):
            assert abs(found[i, f"k{j}"] - x[i] @ w[j]) < 1e-12


def test_whole_vectors_follow_the_columns(spark):
    x, w = RNG.normal(size=(9, 6)), RNG.normal(size=(40, 6))
    *_, y = product(spark, x, w, 200, 6)
    order = [k for r in sorted(y.columns.collect()) for k in r["out_keys"]]
    assert sorted(order) == sorted(f"k{j}" for j in range(40)) and y.columns.count() > 5
    for row in y.whole("id").collect():
        np.testing.assert_allclose(row["y"], [x[row["id"]] @ w[int(k[1:])] for k in order], atol=1e-12)


def test_many_rows_of_weights_are_not_refused(spark):
    w = spark.range(300_000).selectExpr("id", "array(cast(id as double), 1.0) AS x")
    y = tiles.matrix_product(make(spark, np.array([[2.0, 3.0], [0.5, 0.0]])), w, "id", "x", "id", "x")
    sums = {r["key"]: r["s"] for r in y.values.selectExpr("key", "aggregate(y, 0d, (a, v) -> a + v) AS s").groupBy("key").sum("s").toDF("key", "s").collect()}
    assert sums == {0: 2.0 * 299_999 * 150_000 + 900_000, 1: 0.5 * 299_999 * 150_000}


def test_nothing_and_different_lengths(spark):
    none = make(spark, np.zeros((0, 3)))
    assert tiles.matrix_product(none, make(spark, np.ones((2, 3))), "id", "x", "id", "x").values.count() == 0
    with pytest.raises(ValueError, match="different lengths"):
        tiles.cut_tiles(spark.createDataFrame([(1, [1.0]), (2, [1.0, 2.0])], "id int, x array<double>"), "id", "x")
    with pytest.raises(ValueError, match="cannot meet"):
        tiles.matrix_product(make(spark, np.ones((2, 3))), make(spark, np.ones((2, 4))), "id", "x", "id", "x")


@pytest.mark.parametrize("left,right", [(1, 1), (1000, 1), (1, 1000), (300, 7), (10_000, 10_000)])
def test_groups_are_enough_and_not_more_than_blocks(left, right):
    rows, columns = tiles.group_grid(left, right, 8)
    assert 1 <= rows <= left and 1 <= columns <= right
    assert left * right / (rows * columns) <= 2 * tiles.PAIRS_PER_GROUP
    assert rows * columns >= min(8, left * right) / 2


def test_products_of_high_tiles_are_handed_on_in_parts(spark, monkeypatch):
    """Batches of the rows of a product have a few rows each, where the block has many."""
    monkeypatch.setattr(tiles, "PRODUCT_BYTES", 8 * 50 * 4)
    x, w = RNG.normal(size=(60, 5)), RNG.normal(size=(50, 5))
    left, right, y = product(spark, x, w, 2 << 20, 1024, parts=1)
    assert (left.n_blocks, right.n_blocks) == (1, 1)
    plan = y.values._jdf.queryExecution().executedPlan().toString()
    assert plan.count("MapInArrow") == 1 and "binary" not in y.values.schema.simpleString()
    found = {r["key"]: r["y"] for r in y.values.collect()}
    [names] = [r["out_keys"] for r in y.columns.collect()]
    for i in range(60):
        np.testing.assert_allclose(found[i], [x[i] @ w[int(k[1:])] for k in names], atol=1e-12)


@pytest.mark.parametrize("tile_bytes,tile_width,held", [(2 << 20, 1024, 64), (800, 7, 64), (200, 50, 64), (200, 50, 1)])
def test_sums_of_all_numbers(spark, tile_bytes, tile_width, held, monkeypatch):
    """Each row's outputs are all counted, added up and compared, whatever tasks hold and however matrices are cut."""
    monkeypatch.setattr(tiles, "SUMS_HELD", held)
    monkeypatch.setattr(tiles, "PRODUCT_BYTES", 64)
    x, w = RNG.normal(size=(23, 20)), RNG.normal(size=(31, 20))
    *_, y = product(spark, x, w, tile_bytes, tile_width)
    parts = y.sums.groupBy("key").agg({"n": "sum", "total": "sum", "largest": "max"})
    found = {r["key"]: r for r in parts.collect()}
    assert sorted(found) == list(range(23)) and y.sums.count() < 23 * 31
    for i, row in enumerate(x @ w.T):
        assert found[i]["sum(n)"] == 31
        assert abs(found[i]["sum(total)"] - row.sum()) < 1e-9 and abs(found[i]["max(largest)"] - row.max()) < 1e-12

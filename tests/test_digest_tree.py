import pytest
from pyspark.sql import functions as F

from glyphmill.operators import diff, digest_tree
from glyphmill.session import new_path

COLUMNS = ["n", "x", "tags"]
SCHEMA = "id bigint, n int, x double, tags array<string>"
ROWS = [(i, i % 7, i / 3, [f"t{i % 5}", None]) for i in range(400)]


def make(spark, rows):
    return spark.createDataFrame(rows, SCHEMA).repartition(5)


def trees(spark, *tables):
    return [digest_tree.digest_tree(t, "id", COLUMNS) for t in tables]


def test_equal_tables_in_any_order(spark):
    nan = float("nan")
    rows = [*ROWS, (None, 1, None, None), (500, None, nan, []), (501, 0, 0.0, None)]
    other = [*reversed(rows[:-1]), (501, 0, -0.0, None)]
    left, right = make(spark, rows), make(spark, other).repartition(2)
    assert digest_tree.unequal_leaves(*trees(spark, left, right)).count() == 0
    assert digest_tree.trees_diff(left, right, *trees(spark, left, right)).count() == 0


def test_finds_what_a_full_comparison_finds(spark):
    changed = {3: (3, 99, 1.0, ["t3", None]), 77: (77, 0, 77 / 3, ["t2"]), 200: (200, None, 200 / 3, ["t0", None])}
    rows = [changed.get(r[0], r) for r in ROWS if r[0] != 150] + [(1000, 1, 1.0, None), ROWS[10], (None, 2, 0.0, None)]
    left, right = make(spark, rows), make(spark, ROWS)
    found = trees(spark, left, right)
    got = digest_tree.trees_diff(left, right, *found)
    want = diff.tables_diff(left, right, "id", COLUMNS, exact=True)
    assert sorted(map(str, got.collect())) == sorted(map(str, want.collect())) != []
    # Seven keys differ, so no more leaves do.
    assert 5 <= digest_tree.unequal_leaves(*found).count() <= 7


def test_inner_nodes_add_up_their_leaves(spark):
    (tree,) = trees(spark, make(spark, ROWS))
    roots = tree.level(0).collect()
    assert [r["n_rows"] for r in roots] == [400]
    for bits in digest_tree.LEVELS:
        assert tree.level(bits).agg(F.sum("n_rows"), F.sum("total")).first()[:] == (400, roots[0]["total"])


def test_a_written_tree_is_read_again(spark):
    path = new_path(spark, "tree")
    digest_tree.digest_tree(make(spark, ROWS), "id", COLUMNS, path)
    again = digest_tree.load_tree(spark, path, "id", COLUMNS)
    assert digest_tree.unequal_leaves(again, *trees(spark, make(spark, ROWS))).count() == 0


def test_nulls_move_and_empty_tables(spark):
    left, right = make(spark, [(1, None, 2.0, None)]), make(spark, [(1, 2, None, None)])
    assert digest_tree.unequal_leaves(*trees(spark, left, right)).count() == 1
    empty = make(spark, [])
    assert digest_tree.trees_diff(empty, empty, *trees(spark, empty, empty)).count() == 0
    assert digest_tree.trees_diff(empty, left, *trees(spark, empty, left)).filter("kind = 'missing'").count() == 3
    with pytest.raises(ValueError, match="different columns"):
        digest_tree.unequal_leaves(digest_tree.digest_tree(left, "id", ["n"]), digest_tree.digest_tree(left, "id", ["x"]))

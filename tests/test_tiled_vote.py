import numpy as np
import pytest

from glyphmill.operators import tiled_vote, vectors

RNG = np.random.default_rng(6)
Q, K, V = RNG.normal(size=(13, 4)) * 3, RNG.normal(size=(37, 4)) * 3, RNG.normal(size=(37, 3))
QG, KG = [i % 3 for i in range(13)], [i % 4 if i % 9 else None for i in range(37)]


def listed(row):
    return [float(v) for v in row]


@pytest.fixture(scope="module")
def sides(spark):
    queries = [(i, listed(q), g) for i, (q, g) in enumerate(zip(Q, QG))] + [(99, None, 0)]
    keys = [(f"k{j}", listed(k), listed(v), g) for j, (k, v, g) in enumerate(zip(K, V, KG))] + [("none", None, [1.0] * 3, 1)]
    return (
        spark.createDataFrame(queries, "q int, x array<double>, g int").repartition(3),
        spark.createDataFrame(keys, "k string, y array<double>, v array<double>, h int").repartition(4),
    )


def plain(seen):
    """Weights of every query that sees a key."""
    out = {}
    for i in range(13):
        own = [j for j in range(37) if seen(i, j)]
        if own:
            s = K[own] @ Q[i] / 2
            p = np.exp(s - s.max())
            out[i] = p @ V[own] / p.sum()
    return out


def check(df, wanted):
    found = {r[0]: r[1] for r in df.collect()}
    assert found.keys() == wanted.keys()
    for i, w in wanted.items():
        np.testing.assert_allclose(found[i], w, atol=1e-12)


@pytest.mark.parametrize("tile_bytes", [2 << 20, 300, 60])
@pytest.mark.parametrize("keep", ["all", "same", "different"])
def test_groups(sides, tile_bytes, keep):
    queries, keys = sides
    found = tiled_vote.tiled_neighbour_vote(queries, keys, "q", "x", "k", "y", "v", None, "g", "h", keep, tile_bytes)
    rules = {"all": lambda i, j: True, "same": lambda i, j: QG[i] == KG[j], "different": lambda i, j: QG[i] != KG[j]}
    check(found, plain(rules[keep]))


@pytest.mark.parametrize("tile_bytes", [2 << 20, 200])
def test_any_mask(spark, sides, tile_bytes):
    queries, keys = sides
    seen = RNG.random((13, 37)) < 0.2
    seen[4], seen[7] = False, True
    pairs = [(int(i), f"k{j}") for i, j in zip(*np.nonzero(seen))]
    mask = spark.createDataFrame([*pairs, *pairs[:5], (1, "gone"), (500, "k1")], "q int, k string").repartition(3)
    found = tiled_vote.tiled_neighbour_vote(queries, keys, "q", "x", "k", "y", "v", mask, tile_bytes=tile_bytes)
    check(found, plain(lambda i, j: seen[i, j]))


def test_more_blocks_than_the_bound_take_tiles(sides, monkeypatch):
    queries, keys = sides
    queries, keys = queries.filter("x IS NOT NULL"), keys.filter("y IS NOT NULL")
    few = vectors.soft_neighbour_vote(queries, keys, "q", "x", "y", "v", "g", "h", "different").collect()
    monkeypatch.setattr(vectors, "MOST_BLOCKS", 2)
    many = vectors.soft_neighbour_vote(queries, keys, "q", "x", "y", "v", "g", "h", "different", block_rows=2).collect()
    shown = [sorted((r["q"], r["idx"], round(r["weight"], 9)) for r in rows) for rows in (few, many)]
    assert shown[0] == shown[1] and len(shown[0]) == 39
    y = vectors.project_vectors(queries.select("q", "x"), keys.select("k", "y"), "q", "x", "k", "y", block_rows=4).collect()
    assert len(y) == 13 * 37
    for r in y:
        assert abs(r["value"] - Q[r["q"]] @ K[int(r["k"][1:])]) < 1e-12


def test_nothing_to_see_and_bad_input(spark, sides):
    queries, keys = sides
    assert tiled_vote.tiled_neighbour_vote(queries.limit(0), keys, "q", "x", "k", "y", "v").count() == 0
    empty = spark.createDataFrame([], "q int, k string")
    assert tiled_vote.tiled_neighbour_vote(queries, keys, "q", "x", "k", "y", "v", empty).count() == 0
    with pytest.raises(ValueError, match="cannot meet"):
        tiled_vote.tiled_neighbour_vote(queries, keys, "q", "x", "k", "v", "y")
    with pytest.raises(ValueError, match="keep"):
        tiled_vote.tiled_neighbour_vote(queries, keys, "q", "x", "k", "y", "v", keep="some")

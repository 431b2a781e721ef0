import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from glyphmill.llm import epsilon_join, max_score

SCHEMA = "vec_id bigint, embedding array<float>, label int"


def with_oddities(rows):
    nan, inf = float("nan"), float("inf")
    odd = [None, [], [0.0] * 8, [nan] + [1.0] * 7, [inf] + [1.0] * 7, [None] + [1.0] * 7, [1.0, 0.0]]
    return rows + [(10_000 + i, v, None) for i, v in enumerate(odd)]


def clusters(seed, n=40, dim=8):
    rng = np.random.default_rng(seed)
    rows = []
    for _ in range(n):
        centre = rng.normal(size=dim)
        for _ in range(rng.integers(1, 8)):
            rows.append((centre + rng.normal(size=dim) * rng.choice([0.0, 0.1, 0.4])) * rng.choice([0.5, 1, 3]))
    return [(i, [float(np.float32(x)) for x in row], i % 3) for i, row in enumerate(rows)]


def plain_join(rows, cosine):
    usable = {i: np.array(v, np.float64) for i, v, _ in rows if v and all(x is not None and np.isfinite(x) for x in v) and any(v)}
    links = {i: set() for i, _, _ in rows}
    for i, a in usable.items():
        for j, b in usable.items():
            if i != j and len(a) == len(b) and a @ b / np.linalg.norm(a) / np.linalg.norm(b) >= cosine:
                links[i].add(j)
    least = {i: i for i in links}
    while True:
        new = {i: min([least[i], *(least[j] for j in links[i])]) for i in links}
        if new == least:
            return {i: (len(links[i]), least[i], least[i] == i) for i in links}
        least = new


@pytest.mark.parametrize("seed, block, leaf", [(1, 1 << 19, 128), (2, 60, 3)])
def test_join_matches_brute_force(spark, monkeypatch, seed, block, leaf):
    monkeypatch.setattr(epsilon_join, "BLOCK_NUMBERS", block)
    monkeypatch.setattr(epsilon_join, "LEAF_ROWS", leaf)
    rows = with_oddities(clusters(seed))
    rows += [(20_000 + i, rows[3][1], 1) for i in range(30)]
    found = epsilon_join.near_vectors(spark.createDataFrame(rows, SCHEMA)).collect()
    assert {r["vec_id"]: (r["n_links"], r["component_id"], r["kept"]) for r in found} == plain_join(rows, 0.95)


def test_join_of_repeated_rows_and_nothing(spark):
    rows = [(1, [1.0, 0.0], 0), (1, [1.0, 0.0], 0), (2, [2.0, 0.0], 0), (None, [1.0, 0.0], 0), (3, [1e30, 1e30], 0), (4, [1e-30, 1e-30], 0)]
    found = epsilon_join.near_vectors(spark.createDataFrame(rows, SCHEMA)).collect()
    shown = sorted((r["vec_id"] or -1, r["n_links"], r["component_id"] or -1, r["kept"]) for r in found)
    assert shown == [(-1, 0, -1, False), (1, 2, 1, True), (1, 2, 1, True), (2, 2, 1, False), (3, 1, 3, True), (4, 1, 3, False)]
    assert epsilon_join.near_vectors(spark.createDataFrame([], SCHEMA)).count() == 0
    assert epsilon_join.near_vectors(spark.createDataFrame([(1, None, 0)], SCHEMA)).collect()[0]["n_links"] == 0


def plain_top(rows, k, asks):
    usable = [(i, [int(np.floor(float(x) * 256)) for x in v]) for i, v, _ in rows if v and all(x is not None and np.isfinite(x) for x in v)]
    found = []
    for i, q in usable:
        if asks(i):
            scores = [(-sum(a * b for a, b in zip(q, v)), j) for j, v in usable if j != i and len(v) == len(q)]
            found += [(i, n + 1, j, -s) for n, (s, j) in enumerate(sorted(scores)[:k])]
    return sorted(found)


@pytest.mark.parametrize("shard", [8192, 16])
def test_search_matches_brute_force(spark, monkeypatch, shard):
    monkeypatch.setattr(max_score, "SHARD_ROWS", shard)
    monkeypatch.setattr(max_score, "QUERY_ROWS", 5)
    rows = with_oddities(clusters(7, dim=30))
    rows += [(30_000 + i, rows[0][1], 0) for i in range(8)]
    found = max_score.top_k(spark.createDataFrame(rows, SCHEMA), F.col("vec_id") % 10 == 0)
    assert sorted((r["query_id"], r["rank"], r["vec_id"], r["score"]) for r in found.collect()) == plain_top(rows, 5, lambda i: i % 10 == 0)


def test_search_of_few_great_and_no_vectors(spark):
    schema = SCHEMA.replace("float", "double")
    few = [(0, [1.0, -1.0], 0), (1, [0.5, 0.25], 0), (None, [9.0, 9.0], 0)]
    found = max_score.top_k(spark.createDataFrame(few, schema), F.col("vec_id") == 0).collect()
    assert [tuple(r) for r in found] == [(0, 1, 1, 256 * 128 - 256 * 64)]
    great = [(0, [1e9, 3.0], 0), (1, [1e9, -1.0], 0), (2, [1e300, 0.0], 0), (3, [1e308, 0.0], 0)]
    found = max_score.top_k(spark.createDataFrame(great, schema), F.col("vec_id") == 0).collect()
    assert [tuple(r)[2:] for r in found] == [(1, 2**63 - 1), (2, 2**63 - 1)]
    assert max_score.top_k(spark.createDataFrame([], schema), F.col("vec_id") == 0).count() == 0
    assert max_score.top_k(spark.createDataFrame(few, schema), F.col("vec_id") == 77).count() == 0


def test_max_score_skips_without_losing(spark):
    random.seed(2)
    rng = np.random.default_rng(0)
    shard = np.floor(rng.normal(size=(3000, 40)) * np.linspace(60, 1, 40))
    ids = rng.permutation(3000)
    for own in range(20):
        query = shard[own]
        got = max_score.max_score(query, shard, shard.min(axis=0), shard.max(axis=0), ids, int(ids[own]), 5)
        scores = shard @ query
        order = [i for i in np.lexsort((ids, -scores)) if i != own][:5]
        assert got[0].tolist() == ids[order].tolist() and got[1].tolist() == scores[order].tolist()

import numpy as np
import pytest
from pyspark.sql import functions as F

from glyphmill.functions import vector
from glyphmill.operators import vectors
from glyphmill.operators.joins import attach_by_key

RNG = np.random.default_rng(5)
X = RNG.normal(size=(40, 6))
W = RNG.normal(size=(9, 6))


def _table(spark, matrix, key, value, **extra):
    rows = [(i, [float(v) for v in row], *[extra[c][i] for c in extra]) for i, row in enumerate(matrix)]
    names = "".join(f", {c} string" for c in extra)
    return spark.createDataFrame(rows, f"{key} bigint, {value} array<double>{names}")


def _dense(df, row, col, value):
    rows = df.collect()
    out = np.full((max(r[row] for r in rows) + 1, max(r[col] for r in rows) + 1), np.nan)
    for r in rows:
        assert np.isnan(out[r[row], r[col]])
        out[r[row], r[col]] = r[value]
    return out


@pytest.mark.parametrize("block_rows", [4096, 4])
def test_projection(spark, block_rows):
    x = _table(spark, X, "vec_id", "x").repartition(5)
    y = vectors.project_vectors(x, _table(spark, W, "out", "w"), "vec_id", "x", "out", "w", block_rows)
    np.testing.assert_allclose(_dense(y, "vec_id", "out", "value"), X @ W.T, atol=1e-9)


def _attention(q, k, v, keep):
    score = q @ k.T / np.sqrt(q.shape[1])
    score = np.where(keep, score, -np.inf)
    p = np.exp(score - score.max(axis=1, keepdims=True))
    return p / p.sum(axis=1, keepdims=True) @ v


@pytest.mark.parametrize("scale", [1.0, 1000.0])
@pytest.mark.parametrize("keep", ["all", "same", "different"])
@pytest.mark.parametrize("block_rows", [4096, 4])
def test_soft_vote(spark, keep, block_rows, scale):
    values = RNG.normal(size=(40, 3))
    groups = [str(i % 4) for i in range(40)]
    q_groups = [str(i % 4) for i in range(9)]
    q = _table(spark, W * scale, "q", "x", g=q_groups)
    k = _table(spark, X, "k", "x", g=groups).join(_table(spark, values, "k", "v"), "k").repartition(6)
    got = vectors.soft_neighbour_vote(q, k, "q", "x", "x", "v", "g", "g", keep, block_rows)
    same = np.array(q_groups)[:, None] == np.array(groups)[None, :]
    mask = {"all": np.ones_like(same), "same": same, "different": ~same}[keep]
    np.testing.assert_allclose(_dense(got, "q", "idx", "weight"), _attention(W * scale, X, values, mask), atol=1e-6)


def test_query_without_keys_gets_no_row(spark):
    q = _table(spark, W[:2], "q", "x", g=["a", "none"])
    k = _table(spark, X[:5], "k", "x", g=["a"] * 5)
    got = vectors.soft_neighbour_vote(q, k, "q", "x", "x", "x", "g", "g", "same")
    assert {r["q"] for r in got.collect()} == {0}


@pytest.mark.parametrize("lookup_numbers", [32_000_000, 1])
def test_mean_vectors(spark, lookup_numbers):
    docs = [(0, [0, 0, 1, 99]), (1, []), (2, None), (3, [39] * 500 + [2]), (4, [77])]
    df = spark.createDataFrame(docs, "doc_id bigint, ids array<int>")
    got = vectors.mean_vectors(df, _table(spark, X, "vec_id", "x"), "doc_id", "ids", "vec_id", "x", lookup_numbers)
    rows = {}
    for r in got.collect():
        rows.setdefault(r["doc_id"], {})[r["idx"]] = r["mean"]
    assert set(rows) == {0, 3}
    for doc, ids in docs:
        if doc in rows:
            want = X[[i for i in ids if i < 40]].mean(axis=0)
            np.testing.assert_allclose([rows[doc][i] for i in range(6)], want, atol=1e-9)


@pytest.mark.parametrize("lookup_numbers", [32_000_000, 1])
def test_mean_vectors_of_negative_unknown_and_repeated_ids(spark, lookup_numbers):
    table = spark.createDataFrame([(-1, [5.0]), (0, [3.0])], "vec_id bigint, x array<double>")
    df = spark.createDataFrame([(1, [0, 77]), (2, [-1, 0])], "doc_id bigint, ids array<int>")
    got = vectors.mean_vectors(df, table, "doc_id", "ids", "vec_id", "x", lookup_numbers).collect()
    assert {r["doc_id"]: r["mean"] for r in got} == {1: 3.0, 2: 4.0}
    for bad in ([(0, [1.0]), (0, [2.0])], [(None, [1.0])]):
        with pytest.raises(ValueError):
            vectors.mean_vectors(df, spark.createDataFrame(bad, table.schema), "doc_id", "ids", "vec_id", "x", lookup_numbers)


@pytest.mark.parametrize("limits", [(100_000, 1 << 26), (2, 1 << 26), (100_000, 100)])
def test_attach_by_key_keeps_null_keys(spark, limits):
    rows = spark.createDataFrame([(i, None if i % 3 else i % 6) for i in range(300)], "id bigint, k bigint")
    per_key = rows.groupBy("k").agg(F.count(F.lit(1)).alias("n"), F.max("id").alias("top"))
    got = attach_by_key(rows, per_key, ["k"], "n", *limits)
    assert got.count() == 300 and got.filter("k is null and top = 299").count() == 200
    whole = attach_by_key(rows, rows.agg(F.count(F.lit(1)).alias("n"), F.max("id").alias("top")), [], "n")
    assert whole.filter("top = 299").count() == 300


@pytest.mark.parametrize("broadcast_rows", [100_000, 2])
def test_attach_by_key_keeps_every_row(spark, broadcast_rows):
    # Key 0 holds most rows; key 99 has no partner.
    rows = spark.range(3000).select("id", F.when(F.col("id") % 3 > 0, 0).otherwise(F.col("id") % 60).alias("k"))
    rows = rows.unionByName(spark.createDataFrame([(9999, 99)], "id bigint, k bigint"))
    per_key = rows.filter("k < 99").groupBy("k").agg(F.count(F.lit(1)).alias("n"), F.max("id").alias("top"))
    got = attach_by_key(rows, per_key, ["k"], "n", broadcast_rows)
    want = rows.join(per_key.drop("n"), "k").select(*got.columns)
    assert got.count() == 3000 and got.exceptAll(want).count() == 0


def test_lookup_repeats_vectors_for_repeated_ids(spark):
    tokens = spark.createDataFrame([(0, 3), (1, 3), (2, 5), (3, 400)], "pos int, id bigint")
    table = _table(spark, X, "vec_id", "x")
    for limit in (100_000, 1):
        got = {r["pos"]: r["x"] for r in vectors.embedding_lookup(tokens, table, "id", "vec_id", limit).collect()}
        assert set(got) == {0, 1, 2}
        np.testing.assert_allclose(got[0], X[3])
        np.testing.assert_allclose(got[2], X[5])


def test_array_functions(spark):
    df = spark.createDataFrame([([float(v) for v in X[0]], [float(v) for v in W[0]])], "x array<double>, w array<double>")
    row = df.select(
        vector.silu_vector(F.col("x")).alias("silu"),
        vector.rms_normalise(F.col("x"), F.col("w")).alias("rms"),
        vector.softmax_vector(F.col("x")).alias("p"),
        vector.softmax_vector(F.transform("x", lambda v: v * 1000)).alias("big"),
    ).first()
    x, w = X[0], W[0]
    np.testing.assert_allclose(row["silu"], x / (1 + np.exp(-x)), atol=1e-12)
    np.testing.assert_allclose(row["rms"], x / np.sqrt((x * x).mean() + 1e-5) * w, atol=1e-12)
    p = np.exp(x) / np.exp(x).sum()
    np.testing.assert_allclose(row["p"], p, atol=1e-12)
    assert np.isfinite(row["big"]).all() and abs(sum(row["big"]) - 1) < 1e-9


def test_keys_are_counted_and_numbered_dense_or_not():
    rng = np.random.default_rng(4)
    for keys in ([], [5], [3, 0, 3], [-7, 2, -7], [1 << 40, 3, 1 << 40], rng.integers(0, 300, 5000), rng.integers(0, 1 << 50, 500)):
        keys = np.array(keys, np.int64)
        found, n = vectors.counted(keys)
        want, inverse, count = np.unique(keys, return_inverse=True, return_counts=True)
        assert (found == want).all() and (n == count).all()
        assert (vectors.numbered(keys)[0] == want).all() and (vectors.numbered(keys)[1] == inverse).all()

import numpy as np
import pytest
from pyspark.sql import functions as F

from glyphmill.llm import whitening

SCHEMA = "vec_id bigint, embedding array<float>, label int"


def plain(vectors, components=16):
    """Integers, distinct fit list, covariance and its leading eigenvectors by numpy."""
    x = np.floor(64.0 * np.array(vectors, np.float32).astype(np.float64)).astype(np.int64) + 1_000_000
    fit = np.unique(x, axis=0)
    centred = fit - fit.mean(axis=0)
    values, axes = np.linalg.eigh(centred.T @ centred / len(fit))
    order = np.argsort(-values)[:components]
    whitened = (x - fit.mean(axis=0)) @ axes[:, order] / np.sqrt(values[order])
    sums, n = fit.sum(axis=0), len(fit)
    deviation = [sum((n * int(a) - int(s)) ** 2 for a, s in zip(row, sums)) for row in x]
    return n, deviation, whitened, values[order] / values.sum()


def make(spark, vectors, first=0):
    return spark.createDataFrame([(first + i, v, 1) for i, v in enumerate(vectors)], SCHEMA)


def table_of(rows, n_rows, components):
    out = np.zeros((n_rows, components))
    for r in rows:
        out[r["vec_id"], r["component"] - 1] = r["whitened"]
    return out


@pytest.mark.parametrize("dim", [3, 16, 60])
def test_equals_numpy(spark, dim, monkeypatch):
    monkeypatch.setattr(whitening, "BLOCK_BYTES", 4096)
    rng = np.random.default_rng(dim)
    vectors = (rng.standard_normal((400, dim)) * np.linspace(1, 4, dim)).astype(np.float32).tolist()
    vectors += vectors[:50]
    df = make(spark, vectors).repartition(5).withColumn("x", F.lit("mine")).withColumn("component", F.lit("mine"))
    rows = whitening.whitened_components(spark, df).collect()
    n, deviation, wanted, explained = plain(vectors)
    width = wanted.shape[1]
    assert width == min(dim, 16) and len(rows) == len(vectors) * width
    found = table_of(rows, len(vectors), width)
    signs = np.sign((found * wanted).sum(axis=0))
    assert np.allclose(found * signs, wanted, atol=1e-9)
    for r in rows:
        assert r["n"] == n == 400 and r["deviation"] == deviation[r["vec_id"]]
        assert abs(r["explained"] - explained[r["component"] - 1]) < 1e-12 and r["identity_error"] < 1e-9


def test_unusable_rows_and_ties(spark):
    inf, nan = float("inf"), float("nan")
    good = [[1.0, 2.0], [1.0, 2.0], [3.0, -1.0], [0.5, 0.25], [-1.0, 7.0]]
    df = make(spark, [*good, None, [], [1.0, None], [nan, 1.0], [inf, 0.0], [1.0], [1.0, 2.0, 3.0]])
    df = df.unionByName(spark.createDataFrame([(None, good[0], None)], SCHEMA))
    rows = whitening.whitened_components(spark, df).collect()
    assert {r["vec_id"] for r in rows} == {0, 1, 2, 3, 4, None} and len(rows) == 12 and {r["n"] for r in rows} == {4}
    of = {(r["vec_id"], r["component"]): r["whitened"] for r in rows}
    assert of[0, 1] == of[1, 1] == of[None, 1]
    applied = whitening.apply_whitening(df.withColumn("WHITENING", F.lit(1)), whitening.fit_whitening(df), out="whitening")
    assert applied.columns == ["vec_id", "embedding", "label", "whitening"]
    assert applied.filter("whitening IS NULL").count() == 7


def test_no_variance_no_components(spark):
    assert whitening.whitened_components(spark, make(spark, [])).collect() == []
    assert whitening.whitened_components(spark, make(spark, [None, []])).collect() == []
    assert whitening.whitened_components(spark, make(spark, [[1.0, 2.0]] * 3)).collect() == []
    line = whitening.whitened_components(spark, make(spark, [[float(i), 5.0, 2.0 * i] for i in range(9)])).collect()
    assert {r["component"] for r in line} == {1} and abs(line[0]["explained"] - 1) < 1e-12


def test_many_tasks_are_added_in_groups(spark, monkeypatch):
    vectors = np.random.default_rng(1).standard_normal((300, 5)).astype(np.float32).tolist()
    df = make(spark, vectors)
    one = whitening.fit_whitening(df)
    monkeypatch.setattr(whitening, "GROUPS", 1)
    blocks = whitening.pack_integers(df.select(whitening.integers(F.col("embedding")).alias("x")).repartition(6), 5)
    assert whitening.exact_sums(blocks, 5) == (one.n, one.sums)


def test_large_entries_stay_exact(spark):
    vectors = [[1e30, 1.0], [-1e30, 2.0], [5e12, 3.0], [0.0, 4.0]]
    model = whitening.fit_whitening(make(spark, vectors))
    x = [[max(min(int(np.floor(64.0 * float(np.float32(v)))), 2**53), -(2**53)) + 1_000_000 for v in row] for row in vectors]
    assert model.sums == tuple(map(sum, zip(*x)))
    rows = np.array(x)
    assert whitening.deviations(rows, 4, list(model.sums)) == [sum((4 * a - s) ** 2 for a, s in zip(r, model.sums)) for r in x]
    assert whitening.deviations(rows, 10**9, list(model.sums))[0] is None


@pytest.mark.parametrize("spectrum", ["flat", "clustered", "steep"])
def test_filter_certifies_hard_spectra(spectrum):
    rng = np.random.default_rng(4)
    values = {"flat": np.linspace(1.2, 1, 200), "clustered": np.r_[np.full(10, 5.0), 4.99, np.ones(189)], "steep": 10.0 ** -np.linspace(0, 14, 200)}
    axes, _ = np.linalg.qr(rng.standard_normal((200, 200)))
    operator = axes * values[spectrum] @ axes.T
    found, vectors, residual, _ = whitening.leading_components(lambda q: operator @ q, 200, 16)
    assert np.allclose(found, np.sort(values[spectrum])[::-1][:16], rtol=1e-9, atol=1e-13) and residual < 1e-11
    assert np.allclose(vectors.T @ vectors, np.eye(16), atol=1e-12)

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from glyphmill.functions.schedule import cosine_rate
from glyphmill.operators import diff, metrics

RNG = np.random.default_rng(11)


@pytest.mark.parametrize("shift", [0.0, 100.0, -700.0, 5000.0])
def test_group_softmax(spark, shift):
    scores = {g: RNG.normal(scale=90.0, size=n) for g, n in (("a", 400), ("b", 3), ("c", 1))}
    rows = [(g, i, float(s + shift)) for g, v in scores.items() for i, s in enumerate(v)]
    df = spark.createDataFrame([*rows, ("a", -1, None)], "g string, i int, s double").repartition(7)
    got = {(r["g"], r["i"]): r["p"] for r in metrics.group_softmax(df, ["g"], "s").collect()}
    assert len(got) == len(rows)
    for g, v in scores.items():
        p = np.exp(v - v.max())
        np.testing.assert_allclose([got[g, i] for i in range(len(v))], p / p.sum(), atol=1e-9)


@pytest.mark.parametrize("scale", [1.0, 1000.0])
def test_cross_entropy(spark, scale):
    logits = RNG.random(size=(8, 5)) * scale
    target = RNG.integers(0, 5, 8)
    df = spark.createDataFrame(
        [([float(v) for v in row], int(t), i % 2) for i, (row, t) in enumerate(zip(logits, target))],
        "x array<double>, t int, g int",
    )
    top = logits.max(axis=1)
    losses = top + np.log(np.exp(logits - top[:, None]).sum(axis=1)) - logits[np.arange(8), target]
    assert abs(metrics.cross_entropy(df, "x", "t").first()["loss"] - losses.mean()) < 1e-6
    by_group = {r["g"]: r["loss"] for r in metrics.cross_entropy(df, "x", "t", ["g"]).collect()}
    np.testing.assert_allclose([by_group[0], by_group[1]], [losses[::2].mean(), losses[1::2].mean()], atol=1e-6)


def test_target_outside_the_classes_fails(spark):
    df = spark.createDataFrame([([0.1, 0.2], 2)], "x array<double>, t int")
    with pytest.raises(Exception, match="target is not a class"):
        metrics.cross_entropy(df, "x", "t").collect()


def test_clip_uses_the_norm_of_all_parameters_and_skips_frozen_ones(spark):
    grads = RNG.normal(size=(6, 25))
    rows = [(g, f"p{p}", i, None if p == 5 else float(v * g)) for g in (1, 0) for p, r in enumerate(grads) for i, v in enumerate(r)]
    df = spark.createDataFrame(rows, "g int, name string, i int, grad double").withColumn("grad", F.col("grad") * 0.001 ** (1 - F.col("g")))
    norm = np.sqrt((grads[:5] ** 2).sum())
    for r in metrics.clip_global_norm(df, 1e-2, ["g"]).collect():
        if r["name"] == "p5":
            assert r["clipped"] is None
        elif r["g"] == 1:
            assert abs(r["clipped"] - r["grad"] * 1e-2 / (norm + 1e-6)) < 1e-9
        else:
            assert r["clipped"] == r["grad"]


def test_rate_schedule(spark):
    def plain(it):
        if it < 7:
            return it / 7
        return 0.1 + 0.5 * (1 + math.cos(math.pi * (it - 7) / 14)) * 0.9 if it <= 21 else 0.1

    rows = spark.range(25).select("id", cosine_rate(F.col("id"), 1.0, 0.1, 7, 21).alias("r")).orderBy("id").collect()
    np.testing.assert_allclose([r["r"] for r in rows], [plain(i) for i in range(25)], atol=1e-12)
    # Fixed values of the schedule: start, peak, middle and end of the cosine.
    assert [round(rows[i]["r"], 6) for i in (0, 7, 14, 21, 24)] == [0.0, 1.0, 0.55, 0.1, 0.1]
    no_warmup = spark.range(3).select(cosine_rate(F.col("id"), 1.0, 0.1, 0, 0).alias("r")).collect()
    assert [r["r"] for r in no_warmup] == [1.0, 0.1, 0.1]


def _diff(spark, actual, expected, **options):
    schema = "k string, v double"
    got = diff.table_diff(
        spark.createDataFrame(actual, schema), spark.createDataFrame(expected, schema), "k", "v", **options
    )
    return sorted((r["key"], r["kind"]) for r in got.collect())


def test_table_diff(spark):
    nan = float("nan")
    expected = [("same", 1.0), ("near", 1.0), ("far", 1.0), ("gone", 1.0), ("nan", nan), ("was", 1.0), ("inf", float("inf"))]
    actual = [("same", 1.0), ("near", 1.01), ("far", 1.02), ("new", 0.0), ("nan", nan), ("was", nan), ("inf", 5.0)]
    assert _diff(spark, actual, expected) == [
        ("far", "different"), ("gone", "missing"), ("inf", "different"), ("new", "extra"), ("was", "different"),
    ]
    assert ("near", "different") in _diff(spark, actual, expected, exact=True)
    assert ("gone", "missing") not in _diff(spark, actual, expected, ignore_missing=True)
    assert _diff(spark, expected, expected, exact=True) == []
    assert _diff(spark, [("a", 1.0)] * 500, [("a", 1.0)] * 500) == [("a", "repeated")]


def test_table_diff_of_arrays(spark):
    schema = "k bigint, v array<float>"
    a = spark.createDataFrame([(1, [1.0, 2.0, 3.0]), (2, [1.0])], schema)
    b = spark.createDataFrame([(1, [1.0, 2.5, 3.0]), (2, [1.0, 1.0])], schema)
    got = sorted((r["key"], r["idx"], r["kind"]) for r in diff.table_diff(a, b, "k", "v").collect())
    assert got == [("1", 1, "different"), ("2", 1, "missing")]


def test_softmax_of_masked_undefined_and_null_groups(spark):
    inf, nan = float("inf"), float("nan")
    rows = [("a", 0, 1.0), ("a", 1, -inf), ("a", 2, 1.0), ("b", 3, nan), ("b", 4, 1.0), ("c", 5, -inf), (None, 6, 2.0), ("d", 7, inf)]
    df = spark.createDataFrame(rows, "g string, i int, s double")
    got = {r["i"]: r["p"] for r in metrics.group_softmax(df, ["g"], "s").collect()}
    np.testing.assert_allclose([got[i] for i in (0, 2, 6)], [0.5, 0.5, 1.0])
    assert got[1] == 0.0
    assert all(math.isnan(got[i]) for i in (3, 4, 5, 7))
    whole = {r["i"]: r["p"] for r in metrics.group_softmax(df.filter("i < 3"), [], "s").collect()}
    np.testing.assert_allclose([whole[i] for i in range(3)], [0.5, 0.0, 0.5])


def test_clip_without_groups_and_with_a_null_group(spark):
    df = spark.createDataFrame([(None, 3.0), (1, 4.0), (2, None)], "g int, grad double")
    got = sorted(r["clipped"] for r in metrics.clip_global_norm(df, 1.0).collect() if r["clipped"] is not None)
    np.testing.assert_allclose(got, [3 / (5 + 1e-6), 4 / (5 + 1e-6)])
    assert metrics.clip_global_norm(df, 1.0, ["g"]).count() == 3


def test_exact_diff_of_any_type(spark):
    schema = "k bigint, n bigint, s string, b binary"
    big = 2**53
    a = spark.createDataFrame([(1, big + 1, "x", b"a"), (None, 1, "y", b"b"), (3, 3, None, b"c")], schema)
    b = spark.createDataFrame([(1, big, "x", b"a"), (None, 1, "y", b"b"), (4, 3, None, b"d"), (3, 3, "", b"c")], schema)
    got = {(r["column"], r["key"], r["kind"], r["actual"], r["expected"]) for r in diff.tables_diff(a, b, "k", ["n", "s", "b"], exact=True).collect()}
    assert got == {
        ("n", "1", "different", str(big + 1), str(big)),
        ("n", "4", "missing", None, "3"),
        ("s", "4", "missing", None, None),
        ("s", "3", "different", None, ""),
        ("b", "4", "missing", None, "64"),
    }
    with pytest.raises(ValueError):
        diff.table_diff(a, b, "k", "s")


def test_diff_keeps_keys_of_empty_arrays(spark):
    schema = "k bigint, v array<double>"
    a = spark.createDataFrame([(1, [1.0])], schema)
    b = spark.createDataFrame([(1, [1.0]), (2, []), (3, None)], schema)
    got = sorted((r["key"], r["kind"]) for r in diff.table_diff(a, b, "k", "v").collect())
    assert got == [("2", "missing"), ("3", "missing")]
    assert diff.table_diff(b, b, "k", "v").count() == 0

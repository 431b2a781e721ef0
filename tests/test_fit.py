import numpy as np
import pytest

from glyphmill.operators import fit
from glyphmill.session import new_path
from glyphmill.sources import state

RNG = np.random.default_rng(2)
Y = RNG.integers(0, 3, 90)
X = RNG.normal(size=(90, 4)) + np.eye(3, 4)[Y] * 2
SETTINGS = fit.Settings(steps=8, max_rate=0.1, warmup=1, cycle=8, max_norm=0.3, save_every=2)


@pytest.fixture(scope="module")
def rows(spark):
    data = [([float(v) for v in x], int(y)) for x, y in zip(X, Y)]
    return spark.createDataFrame([*data, (None, 1)], "x array<double>, y int")


def _plain(settings):
    model = fit.Model.zeros(3, 4)
    losses = []
    for step in range(settings.steps):
        z = X @ model.w.T
        p = np.exp(z) / np.exp(z).sum(axis=1, keepdims=True)
        losses.append(-np.log(p[np.arange(90), Y]).mean())
        grad = (p - np.eye(3)[Y]).T @ X / 90
        grad *= min(1, settings.max_norm / (np.sqrt((grad**2).sum()) + 1e-6))
        fit.adamw_update(model, grad, fit.rate_at(step, settings), settings)
    return model, losses


def test_fit_equals_a_plain_fit(rows):
    got = fit.fit_softmax_regression(rows.repartition(5), "x", "y", 3, SETTINGS)
    model, losses = _plain(SETTINGS)
    np.testing.assert_allclose(got.w, model.w, atol=1e-9)
    np.testing.assert_allclose([t[2] for t in got.trace], losses, atol=1e-9)
    assert losses[-1] < losses[0]


def test_adamw_first_step_moves_by_the_rate():
    model = fit.Model.zeros(1, 2)
    fit.adamw_update(model, np.array([[3.0, -0.5]]), 0.1, SETTINGS)
    np.testing.assert_allclose(model.w, [[-0.1, 0.1]], atol=1e-6)


def test_resumed_fit_equals_the_whole_one(spark, rows):
    run_dir = new_path(spark, "fit-test")
    half = fit.Settings(**{**SETTINGS.__dict__, "steps": 5})
    fit.fit_softmax_regression(rows, "x", "y", 3, half, run_dir)
    assert state.committed_steps(spark, run_dir) == [2, 4]
    resumed = fit.fit_softmax_regression(rows, "x", "y", 3, SETTINGS, run_dir)
    whole = fit.fit_softmax_regression(rows, "x", "y", 3, SETTINGS)
    np.testing.assert_allclose(resumed.w, whole.w, atol=1e-9)
    assert [t[0] for t in resumed.trace] == list(range(8))
    loaded = fit.load_model(spark, run_dir)
    assert loaded.step == 8
    for name in ("w", "m", "v"):
        np.testing.assert_array_equal(getattr(loaded, name), getattr(resumed, name))


def test_label_outside_the_classes_fails(spark):
    bad = spark.createDataFrame([([1.0], 3)], "x array<double>, y int")
    with pytest.raises(Exception, match="label is not a class"):
        fit.fit_softmax_regression(bad, "x", "y", 3, SETTINGS)

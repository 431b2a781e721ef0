import numpy as np
import pytest

from glyphmill.operators import fit, parameter_table
from glyphmill.session import new_path
from glyphmill.sources import state

RNG = np.random.default_rng(5)
Y = RNG.integers(0, 3, 70)
X = RNG.normal(size=(70, 10)) + np.eye(3, 10)[Y] * 2
SETTINGS = fit.Settings(steps=4, max_rate=0.1, warmup=1, cycle=4, max_norm=0.3, save_every=2)


@pytest.fixture(scope="module")
def rows(spark):
    data = [([float(v) for v in x], int(y)) for x, y in zip(X, Y)]
    return spark.createDataFrame([*data, (None, 1), ([9.0] * 10, None)], "x array<double>, y int").repartition(3).cache()


def weights_of(model):
    w = np.zeros((3, 10))
    for r in model.weights().collect():
        w[r["class"], r["idx"]] = r["value"]
    return w


@pytest.fixture(scope="module")
def whole(rows):
    return fit.fit_softmax_regression(rows, "x", "y", 3, SETTINGS)


@pytest.mark.parametrize("tile_bytes,tile_width,broadcast", [(2 << 20, 1024, True), (2000, 4, True), (400, 3, False)])
def test_equals_the_fit_of_one_matrix(rows, whole, monkeypatch, tile_bytes, tile_width, broadcast):
    if not broadcast:
        monkeypatch.setattr(parameter_table, "BROADCAST_BYTES", 0)
        monkeypatch.setattr(parameter_table, "BLOCKS_PER_GROUP", 2)
    model = parameter_table.fit_parameter_table(rows, "x", "y", 3, SETTINGS, tile_bytes=tile_bytes, tile_width=tile_width)
    assert model.rows.count() == -(-10 // tile_width) and model.step == 4
    np.testing.assert_allclose(np.array(model.trace), np.array(whole.trace), atol=1e-12)
    np.testing.assert_allclose(weights_of(model), whole.w, atol=1e-12)


def test_resumes_from_a_committed_table(spark, rows, whole):
    run_dir = new_path(spark, "parameters-test")
    half = fit.Settings(**{**SETTINGS.__dict__, "steps": 3})
    parameter_table.fit_parameter_table(rows, "x", "y", 3, half, run_dir, tile_width=4)
    assert state.committed_steps(spark, run_dir) == [2]
    resumed = parameter_table.fit_parameter_table(rows, "x", "y", 3, SETTINGS, run_dir, tile_width=4)
    np.testing.assert_allclose(weights_of(resumed), whole.w, atol=1e-12)
    assert [t[0] for t in resumed.trace] == [0, 1, 2, 3]
    with pytest.raises(ValueError, match="another input"):
        parameter_table.fit_parameter_table(rows.limit(20), "x", "y", 3, SETTINGS, run_dir, tile_width=4)


def test_gradients_of_many_tasks_are_added_in_a_tree(spark):
    parts = spark.range(90).selectExpr("cast(id % 4 as int) AS piece", "id").repartition(9)

    def run(batches):
        import pyarrow as pa

        for batch in batches:
            data = [np.array([i, 1.0]).tobytes() for i in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(data, pa.binary())], names=["piece", "part"])

    sums = parameter_table.reduce_tree(parts.mapInArrow(run, "piece int, part binary"), 9).collect()
    assert {r["piece"]: np.frombuffer(r["part"]).tolist() for r in sums} == {
        p: [float(sum(range(p, 90, 4))), float(len(range(p, 90, 4)))] for p in range(4)
    }


def test_bad_input_is_refused(spark, rows):
    with pytest.raises(Exception, match="label is not a class"):
        parameter_table.fit_parameter_table(rows, "x", "y", 2, SETTINGS)
    with pytest.raises(ValueError, match="no rows"):
        parameter_table.fit_parameter_table(rows.limit(0), "x", "y", 2, SETTINGS)

import random
from collections import Counter

import pytest

from glyphmill.session import new_path
from glyphmill.sources import state
from glyphmill.streaming.compaction import RunningSums

SCHEMA = "k string, n bigint"


def add(spark, sums, batch_id, words):
    sums.add(spark.createDataFrame(list(Counter(words).items()), SCHEMA), batch_id)


def test_sums_and_sizes_over_many_batches(spark):
    rng, sums, whole = random.Random(4), RunningSums(new_path(spark, "sums"), ("k",), "n"), Counter()
    for batch_id in range(14):
        words = [f"w{int(rng.paretovariate(0.7)) % 60}" for _ in range(rng.choice([0, 5, 40]))]
        whole.update(words)
        add(spark, sums, batch_id, words)
        sizes = sums.sizes(spark)
        assert dict(map(tuple, sums.current(spark).collect())) == dict(whole)
        assert all(older >= 2 * newer for older, newer in zip(sizes, sizes[1:])) and sum(sizes) <= 2 * max(len(whole), 1)
    # Of all runs written only those stay that the last two manifests name.
    assert len(state.sub_folders(spark, f"{sums.out}/runs")) <= 2 * len(sizes) + 2


def test_a_batch_that_runs_again_counts_once(spark):
    sums = RunningSums(new_path(spark, "sums"), ("k",), "n")
    add(spark, sums, 0, ["a", "b", "c", "d", "e", "f"])
    add(spark, sums, 1, ["a"])
    add(spark, sums, 1, ["a"])
    assert dict(map(tuple, sums.current(spark).collect())) == {"a": 2, "b": 1, "c": 1, "d": 1, "e": 1, "f": 1}
    # A run without a manifest, of a batch that died, is not read.
    spark.createDataFrame([("z", 9)], SCHEMA).write.parquet(f"{sums.out}/runs/batch=2")
    assert "z" not in {r["k"] for r in sums.current(spark).collect()}
    add(spark, sums, 2, ["b"])
    assert dict(map(tuple, sums.current(spark).collect()))["b"] == 2


def test_nothing_committed(spark):
    sums = RunningSums(new_path(spark, "sums"), ("k",), "n")
    with pytest.raises(ValueError, match="no committed batch"):
        sums.current(spark)
    add(spark, sums, 0, [])
    assert sums.current(spark).count() == 0

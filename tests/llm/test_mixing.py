from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from glyphmill.llm import mixing


def targets_of(sizes):
    """Weighted shares with every source held at three times its size, one source at a time."""
    names = sorted((s for s in sizes if s is not None), key=lambda s: s.encode()) + ([None] if None in sizes else [])
    weight = {s: (5, 2, 1)[i % 3] for i, s in enumerate(names)}
    total, full = sum(sizes.values()), {}
    while len(full) < len(names):
        free = [s for s in names if s not in full]
        level = (total - sum(full.values())) / sum(weight[s] for s in free)
        above = [s for s in free if level * weight[s] > 3 * sizes[s]]
        if not above:
            return {**full, **{s: level * weight[s] for s in free}}
        full.update({s: 3.0 * sizes[s] for s in above})
    return full


def test_targets_copies_and_nulls(make_docs):
    rows = [(i, "w " * (i % 7), "en", s) for i, s in enumerate(["b", "a", "a", None, "é", "z", "Z", "a"] * 20)]
    rows += [(None, "x y", "en", "b"), (5, None, "en", "a"), (5, " \t\x0b", "en", "a"), (900, "\x85a\xa0b c", "en", "b")]
    docs = make_docs(rows)
    plan = mixing.mix_plan(docs).collect()
    sizes = defaultdict(int)
    for row in plan:
        expected = len([w for w in __import__("re").split(r"[\x20\x09-\x0D]+", row["text"] or "") if w])
        assert row["size"] == expected
        sizes[row["source"]] += expected
    wanted = targets_of(sizes)
    for row in plan:
        assert row["source_size"] == sizes[row["source"]]
        assert row["target"] == pytest.approx(wanted[row["source"]])
        rate = row["target"] / row["source_size"]
        assert int(rate) <= row["copies"] <= min(3, int(rate) + 1)
    again = mixing.mix_plan(docs.repartition(3)).collect()
    assert sorted(map(str, plan)) == sorted(map(str, again))
    mixed = mixing.mix(docs)
    assert mixed.columns == docs.columns
    assert mixed.count() == sum(row["copies"] for row in plan)


def test_taken_words_come_near_the_target(make_docs):
    docs = make_docs([(i, "w " * (1 + i % 5), "en", f"s{i % 3}") for i in range(6000)])
    found = mixing.mix_plan(docs).groupBy("source").agg(F.max("target").alias("t"), F.sum(F.col("copies") * F.col("size")).alias("n"))
    for row in found.collect():
        assert row["n"] == pytest.approx(row["t"], rel=0.05)


def test_no_words_no_rows_and_clashing_names(make_docs):
    empty = mixing.mix_plan(make_docs([]))
    assert empty.count() == 0
    bare = mixing.mix_plan(make_docs([(1, None), (2, "")])).collect()
    assert {(r["size"], r["target"], r["copies"]) for r in bare} == {(0, 0.0, 0)}
    docs = make_docs([(1, "a b"), (2, "c")]).withColumn("Size", F.lit("mine")).withColumn("copies", F.lit(7))
    assert "Size" not in mixing.mix_plan(docs).columns
    mixed = mixing.mix(docs)
    assert mixed.columns == docs.columns and {r["copies"] for r in mixed.collect()} == {7}

"""Mixing sources to target weights.

Tokens are summed per source, each source gets a target, and a document is emitted as often as its
source's repetition rate says: the whole part of the rate for certain, and one more copy when a draw
from its id falls below the fraction.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from glyphmill.llm.columns import own_name, put
from glyphmill.session import write_table

# Weights of the sources in code point order, repeating.
WEIGHTS = (5, 2, 1)
# A source is repeated at most this often.
MOST_REPEATS = 3
SEED = 42


def word_count(text: Column) -> Column:
    """Number of runs of anything but ASCII white space; NULL has none."""
    return F.coalesce(F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("bigint")


def draw(doc_id: Column, seed: int = SEED) -> Column:
    """A number in [0, 1) that depends on seed and id only: 52 bits of a digest."""
    name = F.concat(F.lit(f"{seed}-"), F.coalesce(doc_id.cast("string"), F.lit("null")))
    bits = F.conv(F.substring(F.md5(name.cast("binary")), 1, 13), 16, 10).cast("bigint")
    return bits.cast("double") / F.lit(float(1 << 52))


def source_targets(
    docs: DataFrame,
    text: str = "text",
    source: str = "source",
    weights: Sequence[int] = WEIGHTS,
    most_repeats: int = MOST_REPEATS,
) -> DataFrame:
    """``(source, source_size, target)`` per source.

    Sources in code point order, NULL last, take the weights in turn and share the size of the whole
    corpus by them. A target stops at ``most_repeats`` times the size of its source; what that leaves
    is shared again by weight until no target is above. The order comes from range partitions and
    their row counts, and each round of sharing brings three sums to the driver, so no task sees all
    sources. With no words at all every target is zero.
    """
    sized = docs.select(F.col(source).alias("source"), word_count(F.col(text)).alias("size"))
    sums = sized.groupBy("source").agg(
        F.sum("size").alias("source_size")
    )
    ranged = write_table(
        sums.repartitionByRange(F.col("source").asc_nulls_last()).withColumn("part", F.spark_partition_id()),
        "sources",
    )
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    # One row per range partition.
    bases = ranged.groupBy("part").agg(F.count(F.lit(1)).alias("n")).select(
        "part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base")
    )
    inside = F.row_number().over(Window.partitionBy("part").orderBy(F.col("source").asc_nulls_last()))
    turn = (F.col("base") + inside - 1) % len(weights)
    weighed = write_table(
        ranged.join(F.broadcast(bases), "part")
        .withColumn("turn", turn.cast("int"))
        .select("source", "source_size", F.element_at(F.array(*map(F.lit, weights)), F.col("turn") + 1).alias("weight")),
        "source-weights",
    )
    level, full = None, -1
    most = F.col("source_size") * most_repeats
    while True:
        above = F.lit(False) if level is None else most < F.lit(level) * F.col("weight")
        n_above, held, free, total = weighed.agg(
            F.count_if(above),
            F.coalesce(F.sum(F.when(above, most)), F.lit(0)),
            F.coalesce(F.sum(F.when(~above, F.col("weight"))), F.lit(0)),
            F.coalesce(F.sum("source_size"), F.lit(0)),
        ).first()
        if n_above == full or not free:
            break
        full, level = n_above, float(total - held) / float(free)
    target = F.least(most.cast("double"), F.lit(level or 0.0) * F.col("weight"))
    return weighed.select("source", "source_size", target.alias("target"))


def _planned(docs: DataFrame, plan: str, text: str, source: str, doc_id: str, seed: int, sharing: dict) -> DataFrame:
    """``docs`` with a column ``plan`` that holds what the mix does with each row."""
    targets = source_targets(docs.select(F.col(f"`{source}`").alias("source"), F.col(f"`{text}`").alias("text")), **sharing)
    joined = docs.join(targets, docs[f"`{source}`"].eqNullSafe(targets["source"]))
    rate = F.when(targets["source_size"] > 0, targets["target"] / targets["source_size"]).otherwise(0.0)
    extra = draw(docs[f"`{doc_id}`"], seed) < rate - F.floor(rate)
    return joined.select(
        *[docs[f"`{c}`"] for c in docs.columns],
        F.struct(
            word_count(docs[f"`{text}`"]).alias("size"),
            targets["source_size"].alias("source_size"),
            targets["target"].alias("target"),
            (F.floor(rate).cast("int") + extra.cast("int")).alias("copies"),
        ).alias(plan),
    )


def mix_plan(
    docs: DataFrame, text: str = "text", source: str = "source", doc_id: str = "doc_id", seed: int = SEED, **sharing
) -> DataFrame:
    """``docs`` with ``size``, ``source_size``, ``target`` and ``copies``, how often the mix takes a row.

    The rate of a source is its target over its size. A copy is drawn from the id alone, so reruns
    agree and rows that repeat an id are taken equally often; rows with a NULL id share one draw. A
    source without words is not taken. Other columns stay; those named like a result are replaced. An
    empty table gives an empty one.
    """
    plan = own_name(docs, "mix")
    planned = _planned(docs, plan, text, source, doc_id, seed, sharing)
    found = {c: F.col(f"{plan}.{c}") for c in ("size", "source_size", "target", "copies")}
    return put(planned, found).drop(plan)


def mix(
    docs: DataFrame, text: str = "text", source: str = "source", doc_id: str = "doc_id", seed: int = SEED, **sharing
) -> DataFrame:
    """The mixed corpus: the columns of ``docs``, each row as often as ``mix_plan`` says."""
    plan = own_name(docs, "mix")
    planned = _planned(docs, plan, text, source, doc_id, seed, sharing).filter(F.col(f"{plan}.copies") > 0)
    once = F.explode(F.sequence(F.lit(1), F.col(f"{plan}.copies")))
    return planned.withColumn(plan, once).drop(plan)

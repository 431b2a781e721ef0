"""Grouped softmax, loss and norm metrics."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from glyphmill.functions.vector import log_sum_exp
from glyphmill.operators.joins import attach_by_key

# Scores are summed in bands of this width, each relative to its own lower edge.
BAND = 64.0


def group_log_sum_exp(rows: DataFrame, keys: Sequence[str], score: str) -> DataFrame:
    """Per group ``log_norm = log(sum(exp(score)))`` and the row count, in one pass over the rows.

    A band's sum lies between 1 and exp(64) per row, so nothing overflows and the highest band is
    never lost. Bands are partial aggregates like any other, and a group of any size stays spread
    over all tasks until only its bands are left. NULL is a group, no keys make one group. A score of
    ``-inf`` adds nothing; with NaN or ``inf`` in a group, or nothing but ``-inf``, ``log_norm`` is NaN.
    """
    value = F.col(score).cast("double")
    finite = ~F.isnan(value) & (F.abs(value) < float("inf"))
    band = F.when(finite, F.floor(value / BAND).cast("double"))
    bands = (
        rows.filter(value.isNotNull())
        .groupBy(*keys, band.alias("band"))
        .agg(
            F.sum(F.when(finite, F.exp(value - band * BAND))).alias("part"),
            F.max(F.isnan(value) | (value == float("inf"))).alias("undefined"),
            F.count(F.lit(1)).alias("n_rows"),
        )
    )
    top = F.max("band").over(Window.partitionBy(*keys))
    total = F.sum(F.col("part") * F.exp((F.col("band") - F.col("top")) * BAND))
    defined = ~F.max("undefined") & F.max("top").isNotNull()
    return (
        bands.withColumn("top", top)
        .groupBy(*keys)
        .agg(
            F.when(defined, F.max("top") * BAND + F.log(total)).otherwise(F.lit(float("nan"))).alias("log_norm"),
            F.sum("n_rows").alias("n_rows"),
        )
    )


def group_softmax(rows: DataFrame, keys: Sequence[str], score: str, out: str = "p") -> DataFrame:
    """Add ``exp(score) / sum(exp(score))`` within each group; rows without a score are left out.

    A masked score, ``-inf``, gets probability 0. Without keys all rows are one group.
    """
    norms = group_log_sum_exp(rows, keys, score)
    return (
        attach_by_key(rows.filter(F.col(score).isNotNull()), norms, keys, "n_rows")
        .withColumn(out, F.exp(F.col(score) - F.col("log_norm")))
        .drop("log_norm")
    )


def cross_entropy(rows: DataFrame, logits: str, target: str, keys: Sequence[str] = ()) -> DataFrame:
    """Mean of ``log(sum(exp(logits))) - logits[target]`` over the rows, or over each group.

    A target that is not a class of its row fails the job.
    """
    picked = F.when(
        (F.col(target) >= 0) & (F.col(target) < F.size(logits)), F.get(F.col(logits), F.col(target))
    ).otherwise(F.raise_error(F.concat(F.lit("target is not a class: "), F.col(target).cast("string"))))
    losses = rows.select(*keys, (log_sum_exp(F.col(logits)) - picked).alias("loss"))
    return losses.groupBy(*keys).agg(F.avg("loss").alias("loss"), F.count("loss").alias("n_rows"))


def clip_global_norm(
    grads: DataFrame, max_norm: float, keys: Sequence[str] = (), grad: str = "grad"
) -> DataFrame:
    """Scale all gradients of a group by one factor when their common L2 norm exceeds ``max_norm``.

    Without keys all gradients have one norm; a NULL key is a group.
    A NULL gradient belongs to a frozen parameter: it adds nothing to the norm and stays NULL.
    """
    norms = grads.groupBy(*keys).agg(
        F.sqrt(F.coalesce(F.sum(F.col(grad) * F.col(grad)), F.lit(0.0))).alias("norm"),
        F.count(F.lit(1)).alias("n_rows"),
    )
    # 1e-6 is the fixed value the usual implementations add to the norm.
    factor = F.least(F.lit(1.0), F.lit(float(max_norm)) / (F.col("norm") + 1e-6))
    return attach_by_key(grads, norms, keys, "n_rows").withColumn("clipped", F.col(grad) * factor)

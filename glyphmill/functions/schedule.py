"""Learning rates as a function of the step."""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F


def cosine_rate(
    it: Column, max_rate: float, min_rate: float, warmup: Column | int, cycle: Column | int
) -> Column:
    """Linear warm-up to ``max_rate``, then a half cosine down to ``min_rate``, then ``min_rate``."""
    warmup = F.lit(warmup) if isinstance(warmup, int) else warmup
    cycle = F.lit(cycle) if isinstance(cycle, int) else cycle
    wave = (1 + F.cos(math.pi * F.try_divide(it - warmup, cycle - warmup))) / 2
    return (
        F.when(it < warmup, F.try_divide(max_rate * it, warmup))
        .when(it <= cycle, min_rate + F.coalesce(wave, F.lit(1.0)) * (max_rate - min_rate))
        .otherwise(F.lit(float(min_rate)))
    )

"""Connected components of a table of links, by rounds of joins and minimum aggregates."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from glyphmill.session import write_table


def connected_components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """``(node, root)`` for every node of a link: the smallest node of its component.

    Alternating large-star and small-star steps: every node hands its larger neighbours, then its
    smaller ones, to the smallest node it knows. A step takes minima with partial sums before the
    shuffle and joins them back, so a node with very many links is split like any skewed join key.
    Steps are written to the shared folder until nothing changes. No link at all gives no row.
    """
    pairs = links.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).filter("u > v")
    pairs = write_table(pairs.distinct(), "links")
    before = None
    while True:
        state = pairs.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if state == before:
            return pairs.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(
                pairs.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct()
            )
        before = state
        both = pairs.unionByName(pairs.select(F.col("v").alias("u"), F.col("u").alias("v")))
        lowest = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.filter("v > u").join(lowest, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = write_table(large.distinct(), "large-star")
        lowest = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(lowest, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).filter("u > v")
        pairs = write_table(small.unionByName(lowest.select("u", F.col("m").alias("v"))).distinct(), "small-star")


class Forest:
    """Which of the links seen so far join different groups; nodes are numbered from zero."""

    def __init__(self, size: int):
        self.parent = np.arange(size)

    def roots(self, nodes: np.ndarray) -> np.ndarray:
        found = self.parent[nodes]
        while True:
            up = self.parent[found]
            if np.array_equal(up, found):
                break
            found = up
        self.parent[nodes] = found
        return found

    def join(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Add links; returns the places of those that were needed to keep all groups together."""
        needed = []
        place = np.arange(len(left))
        while len(place):
            a, b = self.roots(left[place]), self.roots(right[place])
            apart = a != b
            place, a, b = place[apart], a[apart], b[apart]
            if not len(place):
                break
            low, high = np.minimum(a, b), np.maximum(a, b)
            # One link for every root that gets a smaller parent in this round.
            _, first = np.unique(high, return_index=True)
            self.parent[high[first]] = low[first]
            needed.append(place[first])
            place = np.delete(place, first)
        return np.concatenate(needed) if needed else np.zeros(0, np.int64)

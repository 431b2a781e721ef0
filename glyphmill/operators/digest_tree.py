"""Comparing large tables by trees of digests.

Rows are dealt into leaves by a hash of their key. A leaf has the number of its rows and two digests of them that
do not depend on order; an inner node has those of the leaves beneath it. A tree is written once beside its
table. Two tables are compared from the root down: only children of nodes that differ are looked at, and only
rows of leaves that differ are read and joined. Tables that agree are told so by one row each.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from glyphmill.operators.diff import tables_diff
from glyphmill.schemas import DIGESTS
from glyphmill.session import new_path

# Bits of the key's hash that name a node, level by level. The deepest level has a million leaves.
LEVELS = (0, 8, 14, 20)
SEEDS = (17, 101)


@dataclass(frozen=True)
class DigestTree:
    """``nodes`` are ``(level, node, n_rows, total, mixed)``, stored by level; ``columns`` what was digested."""

    nodes: DataFrame
    columns: tuple[str, ...]
    key: str

    def level(self, bits: int) -> DataFrame:
        return self.nodes.filter(F.col("level") == bits).drop("level")


def leaf_of(key: Column, bits: int = LEVELS[-1]) -> Column:
    """The first bits of the hash of a key's text; NULL is a key like any other."""
    text = F.coalesce(F.concat(F.lit("k"), key.cast("string")), F.lit(""))
    return F.shiftrightunsigned(F.xxhash64(text), 64 - bits) if bits else F.lit(0).cast("bigint")


def _row_digest(columns: Sequence[str], kinds: dict[str, T.DataType], seed: int) -> Column:
    """Digest of a row. Every value comes with a mark whether it is NULL, which hashing alone passes over."""
    parts: list[Column] = [F.lit(seed)]
    for name in columns:
        value = F.col(f"`{name}`")
        if isinstance(kinds[name], (T.FloatType, T.DoubleType)):
            # Both zeros are equal, and so are all NaNs.
            value = F.when(F.isnan(value), F.lit("NaN")).otherwise((value + 0.0).cast("string"))
        elif isinstance(kinds[name], (T.ArrayType, T.MapType, T.StructType)):
            # Hashing alone passes over NULLs inside as well.
            value = F.to_json(F.struct(value), {"ignoreNullFields": "false"})
        parts += [value.isNull(), value]
    return F.xxhash64(*parts)


def digest_tree(df: DataFrame, key: str, columns: Sequence[str], path: str | None = None) -> DigestTree:
    """Make and write the tree of a table over ``key`` and ``columns``: one scan and one shuffle of leaves.

    Rows that repeat count as often as they are there. An empty table has a root alone.
    """
    spark = df.sparkSession
    kinds = {f.name: f.dataType for f in df.schema}
    named = (key, *columns)
    sums = [F.count(F.lit(1)).alias("n_rows")]
    first, second = (_row_digest(named, kinds, seed) for seed in SEEDS)
    sums += [F.sum(first.cast("decimal(38,0)")).alias("total"), F.bit_xor(second).alias("mixed")]
    leaves = df.groupBy(leaf_of(F.col(f"`{key}`")).alias("node")).agg(*sums)
    path = path or new_path(spark, "digests")
    deepest = LEVELS[-1]
    leaves.select(F.lit(deepest).alias("level"), "node", "n_rows", "total", "mixed").write.partitionBy("level").parquet(path)
    stored = spark.read.schema(DIGESTS).parquet(path).filter(F.col("level") == deepest)
    parts = []
    for bits in LEVELS[:-1]:
        up = F.shiftrightunsigned("node", deepest - bits)
        inner = stored.groupBy(up.alias("node")).agg(
            F.sum("n_rows").alias("n_rows"), F.sum("total").cast("decimal(38,0)").alias("total"), F.bit_xor("mixed").alias("mixed")
        )
        parts.append(inner.select(F.lit(bits).alias("level"), "node", "n_rows", "total", "mixed"))
    reduce(DataFrame.unionByName, parts).write.mode("append").partitionBy("level").parquet(path)
    return load_tree(spark, path, key, columns)


def load_tree(spark: SparkSession, path: str, key: str, columns: Sequence[str]) -> DigestTree:
    return DigestTree(spark.read.schema(DIGESTS).parquet(path), tuple(columns), key)


def _unequal(left: DataFrame, right: DataFrame) -> DataFrame:
    """Nodes that one side lacks or that differ."""
    ours = left.select("node", *[F.col(c).alias(f"l_{c}") for c in ("n_rows", "total", "mixed")])
    both = ours.join(right, "node", "full_outer")
    same = reduce(Column.__and__, [F.col(f"l_{c}").eqNullSafe(F.col(c)) for c in ("n_rows", "total", "mixed")])
    return both.filter(~same).select("node")


def unequal_leaves(left: DigestTree, right: DigestTree) -> DataFrame:
    """``(node)``: leaves that differ, found from the root down."""
    if left.columns != right.columns:
        raise ValueError("the trees are of different columns")
    nodes = _unequal(left.level(LEVELS[0]), right.level(LEVELS[0]))
    for upper, bits in zip(LEVELS, LEVELS[1:]):
        parents = nodes.withColumnRenamed("node", "parent")

        def beneath(tree: DigestTree) -> DataFrame:
            children = tree.level(bits).withColumn("parent", F.shiftrightunsigned("node", bits - upper))
            return children.join(parents, "parent", "left_semi").drop("parent")

        nodes = _unequal(beneath(left), beneath(right))
    return nodes


def trees_diff(actual: DataFrame, expected: DataFrame, left: DigestTree, right: DigestTree, **options) -> DataFrame:
    """``tables_diff`` of values as they are, over rows of leaves that differ; the trees are those of the tables.

    An empty result means that the tables agree, up to digests of 128 bits.
    """
    leaves = unequal_leaves(left, right)

    def rows(df: DataFrame, tree: DigestTree) -> DataFrame:
        marked = df.withColumn("digest leaf", leaf_of(F.col(f"`{tree.key}`")))
        return marked.join(leaves.withColumnRenamed("node", "digest leaf"), "digest leaf", "left_semi").drop("digest leaf")

    return tables_diff(rows(actual, left), rows(expected, right), left.key, list(left.columns), exact=True, **options)

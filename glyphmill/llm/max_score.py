"""Exact top-k search by inner product with MaxScore over integer vectors.

A dimension is a query term and a shard holds its postings, the component of every vector. What a term
can add to a score is bounded by its least and greatest component in the shard. Terms are traversed by
falling bound: those without which no vector can reach the k-th best score so far are essential, the
others are probed only for vectors that are still competitive.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from glyphmill.llm.vector_blocks import pack, unpack, usable
from glyphmill.session import write_table

SHARD_ROWS = 8192
QUERY_ROWS = 1024
# Terms probed between two checks of which vectors are still competitive.
PROBED_TERMS = 8
EXACT = float(1 << 53)
LONGEST = (1 << 63) - 1


def _top(scores: np.ndarray, ids: np.ndarray, k: int) -> np.ndarray:
    """Places of the ``k`` best scores, ties to the smaller id."""
    if len(scores) > k:
        least = np.partition(scores, len(scores) - k)[len(scores) - k]
        place = np.flatnonzero(scores >= least)
    else:
        place = np.arange(len(scores))
    return place[np.lexsort((ids[place], -scores[place]))][:k]


def max_score(query: np.ndarray, shard: np.ndarray, low: np.ndarray, high: np.ndarray, ids: np.ndarray, own: int, k: int):
    """Ids and scores of the best ``k`` vectors of a shard for one query, its own id left out."""
    if float(np.abs(query) @ np.maximum(np.abs(low), np.abs(high))) >= EXACT:
        # Beyond exact doubles the sums are made of Python integers and end at the bounds of a long.
        whole = [sum(int(a) * int(b) for a, b in zip(query, row)) for row in shard]
        scores = np.array([min(max(s, -LONGEST - 1), LONGEST) for s in whole], np.int64)
        other = np.flatnonzero(ids != own)
        order = sorted(other.tolist(), key=lambda i: (-int(scores[i]), int(ids[i])))[:k]
        return ids[order], scores[order]
    most = np.maximum(query * low, query * high)
    reach = most - np.minimum(query * low, query * high)
    terms = np.argsort(-reach, kind="stable")
    # What the terms after the first j can add at most.
    after = np.append(np.cumsum(most[terms][::-1])[::-1], 0.0)
    alive = np.flatnonzero(ids != own)
    first = alive[: 4 * k + 64]
    exact = shard[first] @ query
    bar = np.partition(exact, len(exact) - k)[len(exact) - k] if len(exact) >= k else -np.inf
    floor = np.minimum(query * low, query * high).sum()
    slack = reach[terms][::-1].cumsum()[::-1]
    essential = int(np.searchsorted(-(floor + slack), -bar, "right"))
    done = max(essential, PROBED_TERMS)
    partial = shard[alive][:, terms[:done]] @ query[terms[:done]]
    while True:
        competitive = partial + after[min(done, len(terms))] >= bar
        alive, partial = alive[competitive], partial[competitive]
        if done >= len(terms) or not len(alive):
            break
        more = terms[done : done + PROBED_TERMS]
        partial = partial + shard[np.ix_(alive, more)] @ query[more]
        done += PROBED_TERMS
    best = _top(partial, ids[alive], k)
    return ids[alive[best]], partial[best].astype(np.int64)


def top_k(vectors: DataFrame, is_query: Column, k: int = 5, vec_id: str = "vec_id", vector: str = "embedding", scale: int = 256) -> DataFrame:
    """``(query_id, rank, vec_id, score)``: for each query row the ``k`` rows with the greatest scores.

    Components become ``floor(scale * x)`` and the score is their inner product, ties to the smaller
    id. A row with a NULL id, or whose vector is NULL, empty or holds a component that is NULL or whose
    scaled value is not finite, takes no part. Vectors are compared with those of their dimension. Rows
    that share a query's id are not its candidates; a query that is repeated is answered once; other
    repeated rows are candidates each. All candidates are returned where there are fewer than ``k``;
    no query or no candidate gives no row.

    Blocks of queries meet shards of candidates; each pair returns its best ``k`` and these are merged.
    """
    doubled = F.transform(F.col(vector), lambda x: x.cast("double") * float(scale))
    rows = vectors.filter(F.col(vec_id).isNotNull() & usable(doubled)).select(
        F.col(vec_id).cast("bigint").alias("id"), _floored(F.col(vector), scale).alias("vector"), is_query.alias("asks")
    )
    shards = write_table(pack(rows.select("id", "vector"), SHARD_ROWS), "shards")
    asked = rows.filter("asks").select("id", "vector").dropDuplicates(["id"])
    asked = write_table(pack(asked, QUERY_ROWS), "query-blocks")
    # Blocks of queries are copied to as many keys as there are shards, so that no key has two shards
    # by more than chance.
    n = max(1, shards.count())
    left = asked.select(
        "dim", F.col("ids").alias("query_ids"), F.col("data").alias("queries"), F.explode(F.sequence(F.lit(0), F.lit(n - 1))).alias("slot")
    )
    right = shards.select("dim", "ids", "data", F.pmod(F.xxhash64("shard", "ids"), F.lit(n)).cast("int").alias("slot"))
    met = left.join(right.hint("shuffle_merge"), ["dim", "slot"])

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                ids, shard = unpack(row["ids"], row["data"], row["dim"])
                asks, queries = unpack(row["query_ids"], row["queries"], row["dim"])
                low, high = shard.min(axis=0), shard.max(axis=0)
                found = [max_score(q, shard, low, high, ids, own, k) for own, q in zip(asks.tolist(), queries)]
                size = [len(f[0]) for f in found]
                columns = [
                    np.repeat(asks, size),
                    np.concatenate([f[0] for f in found]).astype(np.int64),
                    np.concatenate([f[1] for f in found]).astype(np.int64),
                ]
                yield pa.RecordBatch.from_arrays(list(map(pa.array, columns)), names=["query_id", "vec_id", "score"])

    best = met.mapInArrow(search, "query_id bigint, vec_id bigint, score bigint")
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return best.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k).select(
        "query_id", "rank", "vec_id", "score"
    )


def _floored(vector: Column, scale: int) -> Column:
    """Floor in doubles: ``floor`` itself gives a long, which great components would overflow."""

    def floored(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for lists in batches:
            values = np.floor(lists.flatten().to_numpy(zero_copy_only=False).astype(np.float64) * scale)
            n = lists.value_lengths().fill_null(0).to_numpy(zero_copy_only=False)
            bounds = pa.array(np.append(0, np.cumsum(n)), pa.int32())
            yield pa.ListArray.from_arrays(bounds, pa.array(values))

    return F.arrow_udf(floored, "array<double>")(vector)

"""Embedding near-duplicates by an epsilon grid order join.

Unit vectors whose cosine is at least t lie within epsilon = sqrt(2 - 2t) of each other, and so do
their projections on the leading principal dimensions. Vectors are sorted by the cells of a grid of
that width and cut into blocks; only blocks of neighbouring cells meet. A pair of blocks is joined
recursively: intervals of the two sequences are halved, and halves whose bounding boxes are more than
epsilon apart are skipped.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from glyphmill.llm.components import Forest, connected_components
from glyphmill.llm.vector_blocks import usable
from glyphmill.session import write_table

# Leading dimensions whose cells are the grid, and those that boxes are measured in.
GRID_DIMS, BOX_DIMS = 3, 12
# Vectors the principal dimensions are fitted on; they only decide how much is skipped.
FIT_ROWS = 4096
# Numbers a block may hold: 8,192 vectors of 64 dimensions.
BLOCK_NUMBERS = 8192 * 64
LEAF_ROWS = 128
BLOCK_COLUMNS = ["block", "dim", "from_cell", "to_cell", "low", "high", "ids", "n", "data"]
# Room for rounding in bounds of distances.
ROUNDING = 1e-9


def principal_dimensions(sample: np.ndarray) -> np.ndarray:
    """Orthonormal leading directions of a sample, as columns."""
    centred = sample - sample.mean(axis=0)
    _, vectors = np.linalg.eigh(centred.T @ centred)
    return vectors[:, ::-1][:, :BOX_DIMS]


def join_blocks(a: np.ndarray, b: np.ndarray, box_a: np.ndarray, box_b: np.ndarray, same: bool, cosine: float, found: list) -> None:
    """Collect places of linked pairs of two sequences; of one sequence with itself, each pair once.

    ``box_a`` and ``box_b`` are the projections of the vectors.
    """
    epsilon = math.sqrt(max(0.0, 2 - 2 * cosine)) + ROUNDING
    stack = [(0, len(a), 0, len(b))]
    while stack:
        a0, a1, b0, b1 = stack.pop()
        if same and b1 <= a0:
            continue
        x, y = box_a[a0:a1], box_b[b0:b1]
        gap = np.maximum(0, np.maximum(x.min(axis=0) - y.max(axis=0), y.min(axis=0) - x.max(axis=0)))
        if gap @ gap > epsilon * epsilon:
            continue
        if max(a1 - a0, b1 - b0) > LEAF_ROWS:
            a_cuts = [(a0, (a0 + a1) // 2), ((a0 + a1) // 2, a1)] if a1 - a0 > LEAF_ROWS else [(a0, a1)]
            b_cuts = [(b0, (b0 + b1) // 2), ((b0 + b1) // 2, b1)] if b1 - b0 > LEAF_ROWS else [(b0, b1)]
            stack += [(*p, *q) for p in a_cuts for q in b_cuts]
            continue
        i, j = np.nonzero(a[a0:a1] @ b[b0:b1].T >= cosine)
        i, j = i + a0, j + b0
        if same:
            i, j = i[i < j], j[i < j]
        found.append((i, j))


def _blocks(directions: dict[int, np.ndarray]):
    """Vectors sorted by cell and projection become blocks with their first cells and boxes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            dims = batch.column("dim").to_numpy()
            starts = np.flatnonzero(np.append(True, dims[1:] != dims[:-1]))
            for first, last in zip(starts.tolist(), np.append(starts[1:], len(dims)).tolist()):
                dim = int(dims[first])
                step = max(1, BLOCK_NUMBERS // dim)
                for i in range(first, last, step):
                    part = batch.slice(i, min(step, last - i))
                    ids, cells = part.column("id").to_numpy(), part.column("c0").to_numpy()
                    unit = part.column("unit").flatten().to_numpy(zero_copy_only=False).reshape(-1, dim)
                    box = unit @ directions[dim]
                    values = [int(ids[0]), dim, int(cells.min()), int(cells.max()), box.min(axis=0).tolist(), box.max(axis=0).tolist()]
                    values += [ids.tobytes(), part.column("n").to_numpy().tobytes(), np.ascontiguousarray(unit).tobytes()]
                    kinds = [pa.int64(), pa.int32(), pa.int32(), pa.int32(), *[pa.list_(pa.float64())] * 2, *[pa.binary()] * 3]
                    arrays = [pa.array([v], k) for v, k in zip(values, kinds)]
                    yield pa.RecordBatch.from_arrays(arrays, names=BLOCK_COLUMNS)

    return run


def _cells(directions: dict[int, np.ndarray], epsilon: float):
    """Cell and leading projections of unit vectors."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            dims = batch.column("unit").value_lengths().to_numpy(zero_copy_only=False)
            for dim in np.unique(dims).tolist():
                part = batch.take(pa.array(np.flatnonzero(dims == dim)))
                unit = part.column("unit").flatten().to_numpy(zero_copy_only=False).reshape(-1, dim)
                box = np.zeros((len(unit), GRID_DIMS + 1))
                shown = (unit @ directions[dim])[:, : GRID_DIMS + 1]
                box[:, : shown.shape[1]] = shown
                columns = [part.column("id"), part.column("n"), part.column("unit"), pa.array(np.full(len(unit), dim, np.int32))]
                columns += [pa.array(np.floor(box[:, i] / epsilon).astype(np.int32)) for i in range(GRID_DIMS)]
                names = ["id", "n", "unit", "dim", *(f"c{i}" for i in range(GRID_DIMS)), "next"]
                yield pa.RecordBatch.from_arrays([*columns, pa.array(box[:, GRID_DIMS])], names=names)

    cells = ", ".join(f"c{i} int" for i in range(GRID_DIMS))
    return run, f"id bigint, n bigint, unit array<double>, dim int, {cells}, next double"


def _links(cosine: float, directions: dict[int, np.ndarray]):
    """For pairs of blocks, how many rows each vector is linked with, and links that keep groups together."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for place in range(batch.num_rows):
                row = batch.slice(place, 1).to_pylist()[0]
                same, dim = row["block"] == row["other"], row["dim"]
                ids = [np.frombuffer(row[c], np.int64) for c in ("ids", "other_ids")]
                rows = [np.frombuffer(row[c], np.int64) for c in ("n", "other_n")]
                unit = [np.frombuffer(row[c], np.float64).reshape(-1, dim) for c in ("data", "other_data")]
                box = [u @ directions[dim] for u in unit]
                found: list = []
                join_blocks(*unit, *box, same, cosine, found)
                size = len(ids[0])
                nodes = np.concatenate(ids)
                count, forest = np.zeros(len(nodes), np.int64), Forest(len(nodes))
                edges = [np.zeros((2, 0), np.int64)]
                for i, j in found:
                    j = j if same else j + size
                    np.add.at(count, i, rows[1][j - (0 if same else size)])
                    np.add.at(count, j, rows[0][i])
                    needed = forest.join(i, j)
                    edges.append(np.stack([nodes[i[needed]], nodes[j[needed]]]))
                linked = np.flatnonzero(count)
                a, b = np.concatenate(edges, axis=1)
                kind = np.append(np.zeros(len(linked), bool), np.ones(len(a), bool))
                columns = [kind, np.append(nodes[linked], a), np.append(count[linked], b)]
                yield pa.RecordBatch.from_arrays(list(map(pa.array, columns)), names=["is_link", "a", "b"])

    return run


def near_vectors(vectors: DataFrame, cosine: float = 0.95, vec_id: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """``(vec_id, n_links, component_id, kept)`` of every row.

    Rows link when their cosine in double precision is at least ``cosine``, which must be positive;
    vectors link with others of their dimension only. A vector that is NULL, empty, zero or holds a
    component that is NULL or not finite links with nothing, nor does a row without an id, whose
    component is NULL and which is not kept. Rows with equal vectors are one class: all of them are
    linked, and only the class takes part in the join, so copies are never paired. An empty table gives
    an empty one.
    """
    spark = vectors.sparkSession
    values = F.transform(F.col(vector), lambda x: x.cast("double"))
    rows = vectors.select(F.col(vec_id).cast("bigint").alias("vec_id"), values.alias("vector"))
    # Scaling by the greatest component first keeps squares finite.
    top = F.array_max(F.transform("vector", lambda x: F.abs(x)))
    good = F.col("vec_id").isNotNull() & usable(F.col("vector")) & F.coalesce(top > 0, F.lit(False))
    rows = write_table(rows.withColumn("vector", F.when(good, F.col("vector"))), "vectors")
    classes = rows.filter("vector is not null").groupBy("vector").agg(F.min("vec_id").alias("id"), F.count(F.lit(1)).alias("n"))
    scaled = F.transform("vector", lambda x: x / F.col("top"))
    length = F.sqrt(F.aggregate("scaled", F.lit(0.0), lambda a, x: a + x * x))
    units = (
        classes.withColumn("top", top)
        .select("id", "n", scaled.alias("scaled"))
        .withColumn("length", length)
        .select("id", "n", F.transform("scaled", lambda x: x / F.col("length")).alias("unit"))
    )
    units = write_table(units, "units")
    epsilon = math.sqrt(2 - 2 * cosine) + ROUNDING
    directions = {}
    for (dim,) in units.select(F.size("unit")).distinct().collect():
        sample = units.filter(F.size("unit") == dim).orderBy(F.xxhash64("id"), "id").limit(FIT_ROWS)
        flat = sample.select("unit").toArrow().column("unit").combine_chunks().flatten().to_numpy(zero_copy_only=False)
        directions[dim] = principal_dimensions(flat.reshape(-1, dim))
    if not directions:
        linked = spark.createDataFrame([], "id bigint, links bigint, root bigint")
    else:
        run, schema = _cells(directions, epsilon)
        order = ["dim", *(f"c{i}" for i in range(GRID_DIMS)), "next"]
        numbers = units.agg(F.sum(F.size("unit"))).first()[0]
        parts = max(1, math.ceil(numbers / BLOCK_NUMBERS))
        ordered = units.mapInArrow(run, schema).repartitionByRange(parts, *order).sortWithinPartitions(*order)
        # Blocks stay large where a session deals out more partitions than asked for.
        ordered = ordered.coalesce(parts)
        boxes = "low array<double>, high array<double>, ids binary, n binary, data binary"
        columns = f"block bigint, dim int, from_cell int, to_cell int, {boxes}"
        blocks = write_table(ordered.mapInArrow(_blocks(directions), columns), "blocks")
        found = write_table(_pairs(blocks, epsilon).mapInArrow(_links(cosine, directions), "is_link boolean, a bigint, b bigint"), "vector-links")
        counts = found.filter("not is_link").groupBy(F.col("a").alias("id")).agg(F.sum("b").alias("links"))
        roots = connected_components(found.filter("is_link"))
        linked = counts.join(roots, counts["id"] == roots["node"], "left").select("id", "links", "root")
    known = classes.join(linked, "id", "left").select(F.col("vector").alias("class"), "id", "n", "links", "root")
    joined = rows.join(known, rows["vector"] == known["class"], "left")
    component = F.coalesce("root", "id", "vec_id")
    return joined.select(
        "vec_id",
        (F.coalesce(F.col("n") - 1, F.lit(0)) + F.coalesce("links", F.lit(0))).cast("bigint").alias("n_links"),
        component.alias("component_id"),
        F.coalesce(F.col("vec_id") == component, F.lit(False)).alias("kept"),
    )


def _pairs(blocks: DataFrame, epsilon: float) -> DataFrame:
    """Pairs of blocks of neighbouring cells whose boxes are within epsilon, each once, with their data."""
    cells = F.explode(F.sequence(F.col("from_cell") - 1, F.col("to_cell") + 1)).alias("cell")
    left = blocks.select("block", "dim", "low", "high", cells)
    cells = F.explode(F.sequence("from_cell", "to_cell")).alias("cell")
    right = blocks.select(F.col("block").alias("other"), "dim", F.col("low").alias("low2"), F.col("high").alias("high2"), cells)
    gaps = F.zip_with(
        F.zip_with("low", "high2", lambda a, b: a - b), F.zip_with("low2", "high", lambda a, b: a - b), lambda a, b: F.greatest(a, b, F.lit(0.0))
    )
    near = F.aggregate(gaps, F.lit(0.0), lambda s, g: s + g * g) <= epsilon * epsilon
    pairs = left.join(right, ["dim", "cell"]).filter(F.col("block") <= F.col("other")).filter(near).select("block", "other")
    data = blocks.select("block", "dim", "ids", "n", "data")
    other = blocks.select(
        F.col("block").alias("other"), F.col("ids").alias("other_ids"), F.col("n").alias("other_n"), F.col("data").alias("other_data")
    )
    return pairs.distinct().join(data, "block").join(other, "other")

"""SimHash near-duplicates, found with keys from the binary Golay code.

A fingerprint of 64 bits is cut into segments of 23, 23 and 18 bits. The perfect Golay code decodes
every 23-bit word to one of 4,096 codewords; a segment gets the index of its own codeword and those of
the words one bit away, which are one or six different indices. Two segments that differ in at most
two bits have a word within one bit of both and so share an index. With at most four differing bits
in all, two of the three segments hold at most two of them together, so the fingerprints share the
pair of indices of at least one pair of segments. Those pairs are the keys; what shares a key is
compared bit by bit.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from glyphmill.llm.columns import chunks_of, map_text, put, text_buffer
from glyphmill.llm.components import Forest, connected_components
from glyphmill.llm.word_hashes import IS_SPACE, LOWER, joined_words, word_shingles, word_spans, xxh64
from glyphmill.session import write_table

SHINGLE_WORDS = 4
MAX_BITS = 4
SEED = 42
# Fixed value: generator polynomial of the binary Golay code of length 23.
GOLAY_GENERATOR = 0b110001110101
SEGMENTS = ((0, 23), (23, 23), (46, 18))
# Fingerprints of one key that are compared in one group; a larger group is cut into pairs of parts.
PART = 2048


@lru_cache(maxsize=1)
def golay_index() -> np.ndarray:
    """Index of the codeword nearest to each of the 2**23 words."""
    message = np.arange(1 << 12, dtype=np.int64)
    words = np.zeros(1 << 12, np.int64)
    for bit in range(12):
        words ^= np.where(message >> bit & 1, GOLAY_GENERATOR << bit, 0)
    index = np.zeros(1 << 23, np.int16)
    single = [1 << i for i in range(23)]
    errors = [0, *single]
    errors += [single[i] | single[j] for i in range(23) for j in range(i)]
    errors += [single[i] | single[j] | single[k] for i in range(23) for j in range(i) for k in range(j)]
    for error in errors:
        index[words ^ error] = message
    return index


def segment_indices(fingerprints: np.ndarray, start: int, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Sorted codeword indices of a segment and of its one-bit neighbours, and which are no repeats."""
    table = golay_index()
    segment = (fingerprints >> np.uint64(start) & np.uint64((1 << width) - 1)).astype(np.int64)
    found = np.stack([table[segment], *(table[segment ^ 1 << bit] for bit in range(width))], axis=1)
    found.sort(axis=1)
    fresh = np.ones(found.shape, bool)
    fresh[:, 1:] = found[:, 1:] != found[:, :-1]
    return found.astype(np.int64), fresh


def golay_keys(fingerprints: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Keys of all fingerprints, and the place of the fingerprint that each key belongs to."""
    parts = []
    for start, width in SEGMENTS:
        found, fresh = segment_indices(fingerprints, start, width)
        row, column = np.nonzero(fresh)
        n = fresh.sum(axis=1)
        parts.append((found[row, column], n, np.cumsum(n) - n))
    keys, places = [], []
    for pair, (i, j) in enumerate(((0, 1), (0, 2), (1, 2))):
        (left, n_left, at_left), (right, n_right, at_right) = parts[i], parts[j]
        both = n_left * n_right
        place = np.repeat(np.arange(len(fingerprints)), both)
        inside = np.arange(both.sum()) - np.repeat(np.cumsum(both) - both, both)
        first = left[at_left[place] + inside // n_right[place]]
        second = right[at_right[place] + inside % n_right[place]]
        keys.append(pair << 24 | first << 12 | second)
        places.append(place)
    return np.concatenate(keys), np.concatenate(places)


# Each byte value with its bits spread over the eight bytes of a long, so that sums count bits.
SPREAD = np.array([sum((b >> i & 1) << 8 * i for i in range(8)) for b in range(256)], np.uint64)


def fingerprints_of(data: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """SimHash of the four-word shingles of each text, repeats included; no word gives zero."""
    n_texts = len(bounds) - 1
    starts, ends, text = word_spans(data, bounds, ~IS_SPACE[data])
    if not len(starts):
        return np.zeros(n_texts, np.uint64)
    joined, at = joined_words(LOWER[data], starts, ends)
    first, last = word_shingles(text, SHINGLE_WORDS)
    text, begin = text[first], at[first]
    size = at[last] + (ends - starts)[last] - begin
    step = 8192
    hashes = np.concatenate(
        [_hashed(joined, begin[i : i + step], size[i : i + step]) for i in range(0, len(begin), step)]
    )
    # Bits are counted in bytes of longs over at most 255 shingles of one text, then per text.
    inside = np.arange(len(text)) - np.searchsorted(text, text)
    runs = np.flatnonzero(inside % 255 == 0)
    packed = np.add.reduceat(SPREAD[hashes.view(np.uint8).reshape(-1, 8)], runs, axis=0)
    bits = packed.view(np.uint8).reshape(len(runs), 64)
    counts = np.zeros((n_texts, 64), np.int64)
    np.add.at(counts, text[runs], bits)
    total = np.bincount(text, minlength=n_texts)
    return np.packbits(2 * counts > total[:, None], axis=1, bitorder="little").view(np.uint64).ravel()


def _hashed(joined: np.ndarray, begin: np.ndarray, size: np.ndarray) -> np.ndarray:
    """Hashes of neighbouring shingles, on the part of the buffer that they lie in."""
    low, high = int(begin[0]), int((begin + size).max())
    return xxh64(joined[low:high], begin - low, size, SEED)


def with_fingerprints(docs: DataFrame, text: str = "text", out: str = "fp") -> DataFrame:
    """Add the fingerprint as a long. A to Z count as lower case; words are runs of anything but ASCII
    white space; NULL and texts without words give zero."""

    def hashed(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for texts in batches:
            data, bounds = text_buffer(texts)
            found = [
                fingerprints_of(data[bounds[i] : bounds[j]], bounds[i : j + 1] - bounds[i])
                for i, j in chunks_of(bounds, 1 << 18)
            ]
            yield pa.array(np.concatenate(found or [np.zeros(0, np.uint64)]).view(np.int64))

    return put(docs, {out: F.arrow_udf(hashed, "bigint").asNondeterministic()(docs[f"`{text}`"])})


def near_links(fingerprints: DataFrame, max_bits: int = MAX_BITS, part: int = PART) -> DataFrame:
    """``(a, b)``: links between distinct fingerprints ``fp`` with at most ``max_bits`` differing bits.

    Enough of them are returned to keep every component together, not all pairs of a dense group. A
    key with more than ``part`` fingerprints is cut into parts, and each pair of parts is a group of
    its own, so nothing is dropped and no task holds a whole hot key.
    """
    if not 0 <= max_bits <= 4:
        raise ValueError("the keys find fingerprints with up to four differing bits")

    def emit(batch: pa.RecordBatch):
        values = batch.column(0).to_numpy().view(np.uint64)
        for first in range(0, len(values), 4096):
            own = values[first : first + 4096]
            keys, places = golay_keys(own)
            columns = [pa.array(keys, pa.int32()), pa.array(own[places].view(np.int64))]
            yield pa.RecordBatch.from_arrays(columns, names=["key", "fp"])

    keyed = map_text(fingerprints.select("fp"), emit, "key int, fp bigint")
    large = keyed.groupBy("key").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > part)
    large = write_table(large.select("key", F.ceil(F.col("n") * 2 / part).cast("int").alias("parts")), "large-keys")
    if large.isEmpty():
        grouped = keyed.select("key", F.lit(0).alias("low"), F.lit(0).alias("high"), "fp")
    else:
        own = F.pmod(F.xxhash64("fp", F.lit(7)), F.col("parts")).cast("int")
        other = F.explode(F.when(F.col("parts").isNull(), F.array(F.lit(0))).otherwise(F.sequence(F.lit(0), F.col("parts") - 1)))
        spread = keyed.join(large, "key", "left").withColumn("own", F.coalesce(own, F.lit(0))).withColumn("other", other)
        grouped = spread.select("key", F.least("own", "other").alias("low"), F.greatest("own", "other").alias("high"), "fp")

    def compare(batches):
        # Groups are sorted, so only the last one of a batch can go on in the next.
        rest = None
        for batch in batches:
            table = pa.Table.from_batches([batch]) if rest is None else pa.concat_tables([rest, pa.Table.from_batches([batch])])
            group, fp = _group_numbers(table)
            cut = int(np.searchsorted(group, group[-1])) if len(group) else 0
            yield from _links(group[:cut], fp[:cut], max_bits)
            rest = table.slice(cut)
        if rest is not None and rest.num_rows:
            yield from _links(*_group_numbers(rest), max_bits)

    order = ["key", "low", "high"]
    dealt = grouped.repartition(*order).sortWithinPartitions(*order)
    return dealt.mapInArrow(compare, "a bigint, b bigint").distinct()


def _group_numbers(table: pa.Table) -> tuple[np.ndarray, np.ndarray]:
    columns = [table.column(i).to_numpy() for i in range(3)]
    change = np.zeros(table.num_rows, bool)
    for column in columns:
        change[1:] |= column[1:] != column[:-1]
    return np.cumsum(change), table.column(3).to_numpy().view(np.uint64)


def _links(group: np.ndarray, fp: np.ndarray, max_bits: int):
    """Links inside runs of equal groups, as a forest over the fingerprints at hand."""
    nodes, number = np.unique(fp, return_inverse=True)
    forest = Forest(len(nodes))
    at, lag = np.arange(len(group)), 1
    while len(at):
        at = at[at + lag < len(group)]
        at = at[group[at] == group[at + lag]]
        near = at[np.bitwise_count(fp[at] ^ fp[at + lag]) <= max_bits]
        left, right = number[near], number[near + lag]
        needed = forest.join(left, right)
        if len(needed):
            a, b = nodes[left[needed]].view(np.int64), nodes[right[needed]].view(np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(a), pa.array(b)], names=["a", "b"])
        lag += 1


def near_duplicates(
    docs: DataFrame,
    text: str = "text",
    doc_id: str = "doc_id",
    max_bits: int = MAX_BITS,
    keep_text: bool = True,
) -> DataFrame:
    """``docs`` with ``fp``, ``root`` and ``component_id``.

    ``fp`` is the fingerprint, ``root`` names the group of linked fingerprints and ``component_id`` is
    the smallest id of the group's documents, NULL if all of them have none. Equal texts have equal
    fingerprints and are one node, so copies are never paired. Rows may repeat ids. Columns named like
    a result are replaced; all others stay, the text if ``keep_text``. An empty table gives an empty
    one. Hashed rows are written once and not hashed again for the last join.
    """
    hashed = put(with_fingerprints(docs, text, "fp"), {"component_id": docs[f"`{doc_id}`"]})
    hashed = write_table(hashed if keep_text else hashed.drop(text), "hashed")
    least = hashed.groupBy("fp").agg(F.min("component_id").alias("least_id"))
    nodes = write_table(least, "fingerprints")
    groups = write_table(connected_components(near_links(nodes, max_bits)), "fingerprint-groups")
    rooted = nodes.join(groups, nodes["fp"] == groups["node"], "left").select(
        "fp", F.coalesce("root", "fp").alias("root"), "least_id"
    )
    least = rooted.groupBy("root").agg(F.min("least_id").alias("component_id"))
    labels = write_table(rooted.select("fp", "root").join(least, "root"), "fingerprint-labels")
    labels = labels.withColumnRenamed("fp", "label")
    joined = hashed.join(labels, hashed["fp"] == labels["label"])
    kept = [hashed[f"`{c}`"] for c in hashed.columns if c.lower() not in ("root", "component_id")]
    return joined.select(*kept, labels["root"], labels["component_id"])


def drop_near_duplicates(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", max_bits: int = MAX_BITS) -> DataFrame:
    """One row of each group: that with the smallest id, with its own columns.

    Rows that share this id, or a group without ids, leave one row.
    """
    whole = F.struct(*[docs[f"`{c}`"] for c in docs.columns]).alias("row")
    bare = docs.select(whole, docs[f"`{text}`"].alias("text"), docs[f"`{doc_id}`"].alias("id"))
    found = near_duplicates(bare, "text", "id", max_bits, keep_text=False)
    kept = found.filter(F.col("id").eqNullSafe(F.col("component_id"))).dropDuplicates(["root"])
    return kept.select(*[F.col("row").getField(c).alias(c) for c in docs.columns])

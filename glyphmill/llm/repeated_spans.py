"""Removal of repeated byte strings, by minimiser sampling and rounds of grouping by hash.

This is not prefix doubling: no rank pairs at growing offsets are sorted. Ranking every position by Spark
would move some fifty times the text, so only positions that are bound to meet are ranked: a window of
``length`` bytes is handed to the position, among its first ``length - PREFIX + 1``, whose ``PREFIX``
bytes have the smallest hash. Equal windows choose the same place, and neighbouring windows mostly choose
the same position. The first round of ranks groups the positions by their ``PREFIX`` bytes; those that are
alone have no repeated window and leave. The second ranks them by the pair of that group and the whole
stretch of bytes that their windows cover: a stretch that came before has no window of its own. What is
left, the first of each of several stretches of one group, is ranked window by window at the full
``length``. A group with very many stretches is spread by stretch and by window over all tasks.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from glyphmill.llm.columns import chunks_of, map_text, text_buffer
from glyphmill.llm.word_hashes import P1, P2, span_hashes
from glyphmill.session import write_table

LENGTH = 100
PREFIX = 24
# Positions worked on together; a longer text is taken in pieces.
PIECE = 1 << 19
# Bytes of text whose runs are held and combined together in a map.
COMBINED = 6 << 20
# A run of windows in one number: first window in the document, then in these bits the number of windows.
COUNT_BITS = 12
# Stands for a NULL id, which comes before all others.
NO_ID = -(1 << 63)
# Groups with so many distinct stretches, in a sample of one text in ``SAMPLE``, are hot and spread.
SAMPLE, HOT_IN_SAMPLE, MOST_HOT = 64, 16, 1 << 20
RUN = "h bigint, stretch bigint, id bigint, tie bigint, place bigint, later boolean, hot boolean"


def _piece_windows(data: np.ndarray, bounds: np.ndarray, length: int, prefix: int, piece: int):
    """Runs of neighbouring windows that are handed to the same position.

    Yields, for pieces of the buffer, the text of each run, the first and the last start of a window (as
    places in the buffer), the hash of the chosen ``prefix`` bytes and that of all bytes of the run. A run
    that reaches the end of a piece is left to the next piece, which begins with it, so runs depend on
    their text alone and not on where pieces and batches end.
    """
    reach = length - prefix + 1
    # No run has more than ``reach`` windows, so every piece gets on.
    piece = max(piece, 2 * reach)
    begin, n_starts = 0, len(data) - length + 1
    while begin < n_starts:
        here, end = begin, min(begin + piece, n_starts)
        part = data[here : end + length - 1]
        n = len(part) - prefix + 1
        hashes = span_hashes(part, np.arange(n), np.arange(n) + prefix)
        # The place in the low bits makes the leftmost of equal hashes the smallest.
        least = (hashes >> np.uint64(21) << np.uint64(21)) | np.arange(n, dtype=np.uint64)
        size, window = 1, least
        while size < reach:
            step = min(size, reach - size)
            window = np.minimum(window[: len(window) - step], window[step:])
            size += step
        chosen = (window[: end - here] & np.uint64((1 << 21) - 1)).astype(np.int64)
        starts = np.arange(here, end)
        begin = end
        text = np.searchsorted(bounds, starts, "right") - 1
        valid = np.flatnonzero(starts + length <= bounds[text + 1])
        if not len(valid):
            continue
        chosen, text = chosen[valid], text[valid]
        new = np.ones(len(valid), bool)
        new[1:] = (chosen[1:] != chosen[:-1]) | (text[1:] != text[:-1])
        first = np.flatnonzero(new)
        last = np.append(first[1:], len(valid)) - 1
        low, high = valid[first], valid[last]
        if end < n_starts and high[-1] == end - here - 1:
            begin = here + int(low[-1])
            first, low, high = first[:-1], low[:-1], high[:-1]
        stretches = span_hashes(part, low, high + length)
        yield text[first], low + here, high + here, hashes[chosen[first]], stretches


def _place(first: np.ndarray, n: np.ndarray) -> np.ndarray:
    """First window of a run in its document and the number of windows, in one number."""
    return first << COUNT_BITS | n


def _mixed(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    with np.errstate(over="ignore"):
        value = (a * P1 ^ b) * P2
        return value ^ value >> np.uint64(32)


def _is_hot(h: np.ndarray, hot) -> np.ndarray:
    """Which groups are among the sorted ``hot`` ones of a broadcast; there are none without one."""
    if hot is None:
        return np.zeros(len(h), bool)
    return hot.value[np.minimum(np.searchsorted(hot.value, h), len(hot.value) - 1)] == h


def _emit_positions(length: int, prefix: int, piece: int, hot=None):
    """Batches of ``(h, stretch, id, tie, place, later, hot)``, one row for each run of windows.

    Of equal stretches in a part of a batch all but the first are known to be later ones. They need no group any
    more and get a number of their own as ``h``, so a passage that many documents share sends one row
    per part to its group. The stretches of a ``hot`` group are groups of their own.
    """

    names = ["h", "stretch", "id", "tie", "place", "later", "hot"]

    def combined(ids, ties, data, bounds):
        parts = []
        for text, first, last, hashes, stretches in _piece_windows(data, bounds, length, prefix, piece):
            parts.append((hashes, stretches, text, _place(first - bounds[text], last - first + 1)))
        if not parts:
            return
        h, stretch, text, place = (np.concatenate(column) for column in zip(*parts))
        del parts
        own, tie = ids[text], ties[text]
        order = np.lexsort((place, tie, own, stretch, h))
        h, stretch, own, tie, place = h[order], stretch[order], own[order], tie[order], place[order]
        new = np.ones(len(h), bool)
        new[1:] = (h[1:] != h[:-1]) | (stretch[1:] != stretch[:-1])
        lead = np.maximum.accumulate(np.where(new, np.arange(len(h)), 0))
        # Equal rows of the table are one document, none of which is later than the other.
        later = (own != own[lead]) | (tie != tie[lead]) | (place != place[lead])
        spread = _is_hot(h, hot)
        h[spread] = _mixed(h[spread], stretch[spread])
        h[later] = _mixed(_mixed(own[later].view(np.uint64), tie[later].view(np.uint64)), place[later].view(np.uint64))
        for i in range(0, len(h), 100_000):
            part = slice(i, i + 100_000)
            columns = [h[part].view(np.int64), stretch[part].view(np.int64), own[part], tie[part], place[part], later[part], spread[part]]
            yield pa.RecordBatch.from_arrays(list(map(pa.array, columns)), names=names)

    def emit(batch: pa.RecordBatch):
        ids, ties = batch.column(0).to_numpy(), batch.column(1).to_numpy()
        data, bounds = text_buffer(batch.column(2))
        for i, j in chunks_of(bounds, COMBINED):
            yield from combined(ids[i:j], ties[i:j], data[bounds[i] : bounds[j]], bounds[i : j + 1] - bounds[i])

    return emit


def _first_windows(data, bounds, text, first, last, h, ids, ties, length: int):
    """The windows of runs of hot groups: the first of each in these runs, and stretches of later ones.

    Yields columns of ``(h, id, tie, place, later)``. A first window is a group of its own, by the group
    of its run and its bytes.
    """
    n = last - first + 1
    row = np.repeat(np.arange(len(n)), n)
    start = first[row] + np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
    low = data[first.min() : last.max() + length]
    window = _mixed(h[row], span_hashes(low, start - first.min(), start - first.min() + length))
    own, tie, at = ids[text[row]], ties[text[row]], start - bounds[text[row]]
    order = np.lexsort((at, tie, own, window))
    new = np.ones(len(order), bool)
    new[1:] = window[order[1:]] != window[order[:-1]]
    lead = order[np.maximum.accumulate(np.where(new, np.arange(len(order)), 0))]
    later = np.zeros(len(order), bool)
    # Equal rows of the table are one document, none of which is later than the other.
    later[order] = (own[order] != own[lead]) | (tie[order] != tie[lead]) | (at[order] != at[lead])
    lead = order[new]
    yield window[lead], own[lead], tie[lead], _place(at[lead], np.ones(len(lead), np.int64)), np.zeros(len(lead), bool)
    head, tail = _joined(np.flatnonzero(later), row)
    key = _mixed(_mixed(own[head].view(np.uint64), tie[head].view(np.uint64)), at[head].view(np.uint64))
    yield key, own[head], tie[head], _place(at[head], tail - head + 1), np.ones(len(head), bool)


def _joined(found: np.ndarray, row: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First and last of each stretch of neighbours in ``found`` that are of one row."""
    new = np.ones(len(found), bool)
    new[1:] = (np.diff(found) > 1) | (row[found[1:]] != row[found[:-1]])
    ends = np.ones(len(found), bool)
    ends[:-1] = new[1:]
    return found[new], found[ends]


def _emit_windows(length: int, prefix: int, piece: int, hot=None):
    """Batches of ``(h, id, tie, place, later, data)`` for the runs that are asked for.

    ``data`` are the bytes of a run, which its group compares window by window. Of a hot group the
    windows themselves are dealt out, without bytes, and those that came before in the piece are known
    to be later ones: neither a group nor a window that many documents have goes to one task whole.
    """
    names = ["h", "id", "tie", "place", "later", "data"]

    def emit(batch: pa.RecordBatch):
        ids, ties = (batch.column(c).to_numpy() for c in ("id", "tie"))
        data, bounds = text_buffer(batch.column("body"))
        asked = batch.column("asked")
        n = asked.value_lengths().fill_null(0).to_numpy(zero_copy_only=False)
        first = asked.flatten().to_numpy() >> COUNT_BITS
        marked = np.zeros(len(data) + 1, bool)
        marked[np.repeat(bounds[:-1], n) + first] = True
        for text, first, last, hashes, _ in _piece_windows(data, bounds, length, prefix, piece):
            own = np.flatnonzero(marked[first])
            spread = _is_hot(hashes[own], hot)
            runs = own[spread]
            if len(runs):
                parts = _first_windows(data, bounds, text[runs], first[runs], last[runs], hashes[runs], ids, ties, length)
                for h, *rest in parts:
                    for i in range(0, len(h), 100_000):
                        columns = [pa.array(c[i : i + 100_000]) for c in (h.view(np.int64), *rest)]
                        columns.append(pa.nulls(len(columns[0]), pa.binary()))
                        yield pa.RecordBatch.from_arrays(columns, names=names)
            own = own[~spread]
            for part in range(0, len(own), 20_000):
                runs = own[part : part + 20_000]
                size = last[runs] - first[runs] + length
                ends = np.append(0, np.cumsum(size))
                flat = data[np.repeat(first[runs] - ends[:-1], size) + np.arange(ends[-1])]
                payload = pa.Array.from_buffers(
                    pa.binary(), len(runs), [None, pa.py_buffer(ends.astype(np.int32)), pa.py_buffer(flat)]
                )
                place = _place(first[runs] - bounds[text[runs]], last[runs] - first[runs] + 1)
                columns = [hashes[runs].view(np.int64), ids[text[runs]], ties[text[runs]], place, np.zeros(len(runs), bool)]
                yield pa.RecordBatch.from_arrays([*map(pa.array, columns), payload], names=names)

    return emit


def _later_windows(length: int):
    """From runs sorted by group, id, tie and place, the stretches covered by windows that came before.

    Rows without bytes are single windows that the group stands for, or known to be later.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        group, known, before = None, np.zeros(0, np.uint64), None
        names = ["id", "tie", "run"]
        for batch in batches:
            for part in range(0, batch.num_rows, 2048):
                rows = batch.slice(part, 2048)
                told = rows.column(4).to_numpy(zero_copy_only=False)
                if told.any():
                    yield pa.RecordBatch.from_arrays([c.filter(pa.array(told)) for c in rows.columns[1:4]], names=names)
                    rows = rows.filter(pa.array(~told))
                if not rows.num_rows:
                    continue
                # A row that repeats in the table is one document: its runs count once.
                keys = [rows.column(i).to_numpy() for i in range(4)]
                fresh = np.ones(rows.num_rows, bool)
                fresh[1:] = np.any([k[1:] != k[:-1] for k in keys], axis=0)
                fresh[0] = before != tuple(k[0] for k in keys)
                before = tuple(k[-1] for k in keys)
                rows = rows.filter(pa.array(fresh))
                if not rows.num_rows:
                    continue
                h, ids, tie, place = (rows.column(i).to_numpy() for i in range(4))
                data, bounds = text_buffer(rows.column(5))
                size = np.diff(bounds)
                n = np.where(size > 0, size - length + 1, 1)
                row = np.repeat(np.arange(len(h)), n)
                offset = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
                start = bounds[row] + offset
                window = span_hashes(data, start, start + np.minimum(size, length)[row]) + h[row].view(np.uint64)
                _, first = np.unique(window, return_index=True)
                later = np.ones(len(window), bool)
                later[first] = False
                old = np.flatnonzero(h[row] == group) if group is not None else np.zeros(0, np.int64)
                later[old] |= np.isin(window[old], known)
                # Only the last group can go on; its distinct windows are kept.
                mine = window[h[row] == h[-1]]
                known = np.unique(np.append(known, mine) if h[-1] == group else mine)
                group = h[-1]
                head, tail = _joined(np.flatnonzero(later), row)
                if not len(head):
                    continue
                run = _place((place[row[head]] >> COUNT_BITS) + offset[head], tail - head + 1)
                yield pa.RecordBatch.from_arrays(list(map(pa.array, (ids[row[head]], tie[row[head]], run))), names=names)

    return run


def _hot_groups(narrow: DataFrame, length: int, prefix: int, piece: int):
    """A broadcast of the groups that have many distinct stretches, or nothing if there are none.

    They are found in a sample of the texts. What is found only decides how rows are dealt out: a group
    that is missed has few stretches, and one that is found by chance gets the same results.
    """
    sample = narrow.filter(F.pmod(F.xxhash64("id", "tie"), F.lit(SAMPLE)) == 0)
    groups = map_text(sample, _emit_positions(length, prefix, piece), RUN).filter("not later").select("h", "stretch").distinct()
    hot = groups.groupBy("h").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") >= HOT_IN_SAMPLE)
    found = hot.orderBy(F.desc("n"), "h").limit(MOST_HOT).select("h").toArrow()["h"].to_numpy().view(np.uint64)
    return narrow.sparkSession.sparkContext.broadcast(np.sort(found)) if len(found) else None


def _removed(texts: pa.Array, lists: list[pa.Array], length: int) -> pa.StructArray:
    """Bytes, removed bytes, removed runs and the rest of each text, given its repeated runs of windows."""
    data, bounds = text_buffer(texts)
    change = np.zeros(len(data) + 1, np.int32)
    for runs in lists:
        n = runs.value_lengths().fill_null(0).to_numpy(zero_copy_only=False)
        run = runs.flatten().to_numpy()
        first = np.repeat(bounds[:-1], n) + (run >> COUNT_BITS)
        np.add.at(change, first, 1)
        np.add.at(change, first + (run & (1 << COUNT_BITS) - 1) - 1 + length, -1)
    gone = np.cumsum(change)[:-1] > 0
    head = gone.copy()
    head[1:] &= ~gone[:-1]
    head[bounds[:-1][bounds[:-1] < len(data)]] = gone[bounds[:-1][bounds[:-1] < len(data)]]
    counts = [np.append(0, np.cumsum(x))[bounds] for x in (gone, head)]
    removed, runs = (np.diff(c) for c in counts)
    kept = bounds - counts[0]
    rest = pa.Array.from_buffers(
        pa.large_binary(), len(texts), [None, pa.py_buffer(kept.astype(np.int64)), pa.py_buffer(data[~gone])]
    )
    parts = [pa.array(np.diff(bounds)), pa.array(removed), pa.array(runs), rest.cast(pa.binary())]
    return pa.StructArray.from_arrays(parts, names=["n_bytes", "n_removed", "n_spans", "kept"])


def remove_repeats(
    docs: DataFrame,
    text: str = "text",
    doc_id: str = "doc_id",
    length: int = LENGTH,
    prefix: int = PREFIX,
    piece: int | None = None,
) -> DataFrame:
    """``docs`` without its text, with ``n_bytes``, ``n_removed``, ``n_spans`` and the rest as ``kept``.

    A byte goes when a string of ``length`` bytes that covers it starts earlier as well, at a smaller id
    or earlier in the same document; strings may overlap and never cross documents. NULL texts are
    empty; shorter ones stay whole. A NULL id comes first. Rows that share an id are ordered by the
    64-bit digest of their text, and equal rows count as one document, so neither loses bytes to the other. Other
    columns stay; those named like a result are replaced. An empty table gives an empty one. ``piece`` is
    how many positions are worked on together; results do not depend on it.
    """
    piece = PIECE if piece is None else piece
    if not 0 < piece <= 1 << 20:
        raise ValueError("a piece has from one to 2**20 positions")
    if not 0 < prefix <= length < prefix + (1 << COUNT_BITS) - 1:
        raise ValueError("the prefix is a part of the length, and not too small a part")
    body = F.coalesce(F.col(f"`{text}`"), F.lit(""))
    key = F.coalesce(F.col(f"`{doc_id}`").cast("bigint"), F.lit(NO_ID).cast("bigint"))
    tie = F.xxhash64(body)
    narrow = docs.select(key.alias("id"), tie.alias("tie"), body.alias("body"))
    hot = _hot_groups(narrow, length, prefix, piece)
    runs = map_text(narrow, _emit_positions(length, prefix, piece, hot), RUN)
    group = Window.partitionBy("h", "later")
    order = Window.partitionBy("h", "later", "stretch").orderBy("id", "tie", "place")
    judged = (
        runs.withColumn("n", F.count(F.lit(1)).over(group))
        .withColumn("least", F.min("stretch").over(group))
        .withColumn("most", F.max("stretch").over(group))
        .filter("n > 1 or later or hot")
        .withColumn("nth", F.rank().over(order))
        .select(
            "id",
            "tie",
            F.when(F.col("later") | (F.col("nth") > 1), F.col("place")).alias("covered"),
            F.when(~F.col("later") & (F.col("nth") == 1) & (F.col("hot") | (F.col("least") < F.col("most"))), F.col("place")).alias("asked"),
        )
        .filter("covered is not null or asked is not null")
    )
    by_doc = judged.groupBy("id", "tie").agg(F.collect_list("covered").alias("covered"), F.collect_list("asked").alias("asked"))
    by_doc = write_table(by_doc, "runs")
    # Both joins below deal the texts out alike, so they are shuffled once.
    whole = F.struct(*[docs[f"`{c}`"] for c in docs.columns if c != text]).alias("row")
    keyed = docs.select(whole, key.alias("id"), tie.alias("tie"), body.alias("body"))
    asking = keyed.join(by_doc.filter(F.size("asked") > 0).select("id", "tie", "asked").hint("shuffle_merge"), ["id", "tie"])
    order = ["h", "id", "tie", "place"]
    later = (
        map_text(asking, _emit_windows(length, prefix, piece, hot), "h bigint, id bigint, tie bigint, place bigint, later boolean, data binary")
        .repartition("h")
        .sortWithinPartitions(*order)
        .mapInArrow(_later_windows(length), "id bigint, tie bigint, run bigint")
        .groupBy("id", "tie")
        .agg(F.collect_list("run").alias("later"))
    )

    def cut(batches: Iterator[tuple[pa.Array, ...]]) -> Iterator[pa.Array]:
        for columns in batches:
            chunks = chunks_of(text_buffer(columns[0])[1])
            parts = [[c.slice(i, j - i) for c in columns] for i, j in chunks] or [columns]
            yield pa.concat_arrays([_removed(texts, lists, length) for texts, *lists in parts])

    removed = F.arrow_udf(cut, "struct<n_bytes:bigint,n_removed:bigint,n_spans:bigint,kept:binary>").asNondeterministic()
    joined = keyed.join(by_doc.select("id", "tie", "covered").hint("shuffle_merge"), ["id", "tie"], "left")
    joined = joined.join(later.hint("shuffle_merge"), ["id", "tie"], "left")
    found = joined.select("row", removed("body", "covered", "later").alias("found"))
    results = ["n_bytes", "n_removed", "n_spans", "kept"]
    kept = [F.col("row").getField(c).alias(c) for c in docs.columns if c != text and c.lower() not in results]
    return found.select(*kept, *[F.col(f"found.{c}").alias(c) for c in results])

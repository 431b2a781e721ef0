"""Encoding texts that arrive in pieces, cut anywhere, to the ids of the whole text.

A pre-token never reaches from a character that is no white space into white space. So the text of a document
may be cut where a run of white space begins, and both sides encode as they do within the whole. State holds
what lies behind the last such place, the open tail of each document, and pieces that came too early.
"""

from __future__ import annotations

from bisect import bisect_right
from collections.abc import Iterator, Sequence

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.stateful_processor import ListState, StatefulProcessor, StatefulProcessorHandle

from glyphmill.operators.codec import encode_corpus
from glyphmill.operators.tokenizer import Tokenizer
from glyphmill.streaming.live import ROCKSDB

# Fixed value: the characters with the Unicode property White_Space.
WHITE_SPACE = frozenset(
    "\t\n\x0b\x0c\r \x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a\u2028\u2029\u202f\u205f\u3000"
)

# Of the documents of a group: next piece, next part, open tail, whether it has ended, and where the runs of pieces
# that came too early begin and end, in order.
OPEN = "seq array<bigint>, part array<bigint>, tail array<string>, closed array<boolean>, held array<array<bigint>>"
EARLY = "first array<bigint>, text array<string>, last array<boolean>"
# Groups the documents are dealt into by their ids; the state's processor is called for each. A checkpoint holds
# for this number.
GROUPS = 4096


def may_cross(text: str, at: int, specials: Sequence[str]) -> bool:
    """Whether a special token may reach from before ``at`` to behind it, now or once more text is there."""
    for token in specials:
        for start in range(max(0, at - len(token) + 1), at):
            if token.startswith(text[start : start + len(token)]):
                return True
    return False


def closed_length(text: str, specials: Sequence[str] = ()) -> int:
    """How much of ``text`` can be encoded before its continuation is known; what remains is the tail.

    Only a special token that holds white space can lie across the begin of a run of it.
    """
    spaced = [t for t in specials if not WHITE_SPACE.isdisjoint(t)]
    for at in range(len(text) - 1, 0, -1):
        if text[at] in WHITE_SPACE and text[at - 1] not in WHITE_SPACE and not may_cross(text, at, spaced):
            return at
    return 0


def runs_of(pieces: dict[int, tuple[str, bool]]) -> Iterator[tuple[int, int, str, bool]]:
    """Pieces that follow each other as one: the first, the one behind the last, the text, and whether it ends the document."""
    first, texts = 0, []
    for s in sorted(pieces):
        piece, last = pieces[s]
        first = first if texts else s
        texts.append(piece)
        if last or s + 1 not in pieces:
            yield first, s + 1, "".join(texts), last
            texts = []


class EarlyRuns:
    """Runs of pieces of a group's documents that came too early, read only when one of them is wanted."""

    def __init__(self, state: ListState):
        self.state = state
        self.kept: dict[tuple, tuple] | None = None
        self.new: dict[tuple, tuple] = {}

    def hold(self, doc, first: int, text: str, last: bool) -> None:
        self.new[doc, first] = text, last

    def take(self, doc, first: int) -> tuple[str, bool]:
        if self.kept is None:
            self.kept = {(d, f): (t, l) for packed in self.state.get() for d, f, t, l in zip(*packed)}
        return self.kept.pop((doc, first))

    def write(self) -> None:
        runs = {**(self.kept or {}), **self.new}
        packed = tuple(map(list, zip(*((*key, *run) for key, run in runs.items()))))
        if self.kept is None and runs:
            self.state.appendList([packed])
        elif runs:
            self.state.put([packed])
        elif self.kept is not None:
            self.state.clear()


class PieceProcessor(StatefulProcessor):
    """Puts the pieces of each document of a group in order and hands on what is closed, as numbered parts.

    A call of the state takes far longer than what is done with its answer. So all documents of a group are read
    and written in a few calls for a batch of rows, packed in arrays, and not each by calls of its own.
    A piece that came before is passed over, so delivery may repeat. Of a document that has ended a mark stays.
    """

    def __init__(self, specials: Sequence[str], kind: str):
        self.specials, self.kind = tuple(specials), kind

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.open = handle.getValueState("open", f"doc_id array<{self.kind}>, {OPEN}")
        self.early = handle.getListState("early", f"doc_id array<{self.kind}>, {EARLY}")

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        for batch in rows:
            arrived: dict[object, dict[int, tuple[str, bool]]] = {}
            for doc, s, piece, last in zip(*(batch[c].tolist() for c in ("doc", "seq", "piece", "last"))):
                arrived.setdefault(doc["doc_id"], {})[s] = (piece or "", bool(last))
            parts = self.take_in(arrived)
            if parts:
                ids, numbers, texts = zip(*parts)
                yield pd.DataFrame({"doc_id": pd.Series(ids, dtype=object), "part": numbers, "text": texts})

    def take_in(self, arrived: dict[object, dict[int, tuple[str, bool]]]) -> list[tuple]:
        """Add pieces of documents to the state; id, number and text of each part that is closed by them."""
        known = {doc: rest for doc, *rest in zip(*self.open.get())} if self.open.exists() else {}
        early, parts = EarlyRuns(self.early), []
        for doc, pieces in arrived.items():
            seq, part, tail, closed, held = known.get(doc, (0, 0, "", False, []))
            # Behind the begin of a run and before its end lies an odd number of bounds.
            pieces = {s: p for s, p in pieces.items() if not closed and s >= seq and bisect_right(held, s) % 2 == 0}
            if not pieces:
                continue
            runs = dict(zip(held[::2], held[1::2]))
            texts = [tail]
            while not closed:
                if seq in pieces:
                    text, closed = pieces.pop(seq)
                    seq += 1
                elif seq in runs:
                    text, closed = early.take(doc, seq)
                    seq = runs.pop(seq)
                else:
                    break
                texts.append(text)
            text = "".join(texts)
            cut = len(text) if closed else closed_length(text, self.specials)
            if closed:
                for first in runs:
                    early.take(doc, first)
                runs = {}
            else:
                for first, end, run, last in runs_of(pieces):
                    early.hold(doc, first, run, last)
                    runs[first] = end
            known[doc] = seq, part + bool(cut), text[cut:], closed, [at for run in sorted(runs.items()) for at in run]
            if cut:
                parts.append((doc, part, text[:cut]))
        early.write()
        if known:
            self.open.update((list(known), *map(list, zip(*known.values()))))
        return parts

    def close(self) -> None:
        pass


def closed_parts(pieces: DataFrame, specials: Sequence[str] = ()) -> DataFrame:
    """``(doc_id, part, text)`` of a stream of pieces ``(doc_id, seq, piece, last)``.

    ``seq`` counts the pieces of a document from 0, in any order of arrival; ``last`` marks its final one. A
    NULL piece is empty. The parts of a document give its text, each cut where the whole is cut as well.
    """
    kind = pieces.schema["doc_id"].dataType.simpleString()
    # An id within a struct keeps its type where a NULL is among the ids of a batch.
    dealt = pieces.select(
        F.pmod(F.xxhash64("doc_id"), F.lit(GROUPS)).alias("group"),
        F.struct("doc_id").alias("doc"),
        F.col("seq").cast("bigint").alias("seq"),
        "piece",
        F.coalesce("last", F.lit(False)).alias("last"),
    )
    return dealt.groupBy("group").transformWithStateInPandas(
        PieceProcessor([t for t in specials if t], kind), f"doc_id {kind}, part bigint, text string", "Append", "None"
    )


def stream_encode_pieces(pieces: DataFrame, tokenizer: Tokenizer, out: str, checkpoint: str) -> StreamingQuery:
    """Encode what is closed and append ``(doc_id, part, ids)`` to parquet files in ``out``.

    State lies on disk and in the checkpoint, and the file sink's log gives each part exactly once over
    restarts.
    """
    spark = pieces.sparkSession
    key = "spark.sql.streaming.stateStore.providerClass"
    before = spark.conf.get(key)
    spark.conf.set(key, ROCKSDB)
    try:
        return (
            encode_corpus(closed_parts(pieces, tokenizer.specials), tokenizer)
            .select("doc_id", "part", "ids")
            .writeStream.format("parquet")
            .option("path", out)
            .option("checkpointLocation", checkpoint)
            .trigger(availableNow=True)
            .start()
        )
    finally:
        spark.conf.set(key, before)


def whole_ids(spark: SparkSession, out: str) -> DataFrame:
    """``(doc_id, ids)`` of all that was encoded so far, the parts of each document in order."""
    parts = F.sort_array(F.collect_list(F.struct("part", "ids")))
    rows = spark.read.parquet(out)
    return rows.groupBy("doc_id").agg(parts.alias("parts")).select("doc_id", F.flatten(F.col("parts.ids")).alias("ids"))

"""Corpora of documents divided by a delimiter, read and written as byte ranges.

A file of any size is planned as ranges of bytes. A document belongs to the range in which the delimiter
before it begins, and the first one of a file to its first range, so every document is read once wherever
ranges end. Files in blocked gzip, whose members say how long they are, are divided between members;
other gzip files are read whole, by one task each, whatever the number of their members.
"""

from __future__ import annotations

import os
import struct
import uuid
import zlib
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, DataSourceWriter, InputPartition, WriterCommitMessage

from glyphmill.functions.text import END_OF_TEXT

SPLIT_BYTES = 64 << 20
# Bytes read at a time, and bytes of documents handed to Spark at a time.
STEP = 1 << 20
# Fixed values of the blocked gzip format: how a member begins up to its length, its greatest length, the
# bytes of text a member takes, and the empty member that ends a file.
MEMBER = b"\x1f\x8b\x08\x04"
LENGTH_FIELD = b"\x06\x00BC\x02\x00"
MEMBER_BYTES, MEMBER_TEXT = 1 << 16, 65_280
LAST_MEMBER = bytes.fromhex("1f8b08040000000000ff0600424302001b0003000000000000000000")


@dataclass(frozen=True)
class ByteRange(InputPartition):
    """Bytes ``start`` to ``stop`` of a file; ``form`` is plain, blocked or gzip."""

    path: str
    start: int
    stop: int
    size: int
    form: str


def _member_length(head: bytes) -> int | None:
    """Length of the blocked gzip member that begins with ``head``, or None if none does."""
    if len(head) < 18 or head[:4] != MEMBER or head[10:16] != LENGTH_FIELD:
        return None
    return struct.unpack("<H", head[16:18])[0] + 1


def _member_text(member: bytes) -> bytes:
    """Text of a whole member; zlib checks its checksum and length."""
    one = zlib.decompressobj(31)
    text = one.decompress(member) + one.flush()
    if not one.eof or one.unused_data:
        raise ValueError("a member of a blocked gzip file does not have the length it states")
    return text


def _first_member(file: pa.NativeFile, start: int, size: int) -> int:
    """Where the first member at or behind ``start`` begins; ``size`` if there is none.

    What looks like a beginning counts if it opens a sound member with another one or the end behind it.
    """
    if start == 0:
        return 0
    file.seek(start)
    window = file.read(3 * MEMBER_BYTES)
    at = window.find(MEMBER)
    while 0 <= at <= MEMBER_BYTES:
        length = _member_length(window[at : at + 18])
        behind = window[at + length : at + length + 18] if length else b""
        if length and (start + at + length == size or _member_length(behind)):
            try:
                _member_text(window[at : at + length])
                return start + at
            except (ValueError, zlib.error):
                pass
        at = window.find(MEMBER, at + 1)
    if start + len(window) < size or at > MEMBER_BYTES:
        raise ValueError("no member begins where a blocked gzip file must have one")
    return size


def _plain_chunks(file: pa.NativeFile, part: ByteRange) -> Iterator[tuple[bytes, bool]]:
    file.seek(part.start)
    at = part.start
    while at < part.size:
        chunk = file.read(min(STEP, (part.stop if at < part.stop else part.size) - at))
        if not chunk:
            return
        yield chunk, at < part.stop
        at += len(chunk)


def _blocked_chunks(file: pa.NativeFile, part: ByteRange) -> Iterator[tuple[bytes, bool]]:
    at = _first_member(file, part.start, part.size)
    held, base = b"", at
    file.seek(at)
    while at < part.size:
        while at + MEMBER_BYTES > base + len(held) and base + len(held) < part.size:
            held, base = held[at - base :] + file.read(STEP), at
        length = _member_length(held[at - base : at - base + 18])
        if length is None:
            raise ValueError("a blocked gzip file holds another kind of member")
        yield _member_text(held[at - base : at - base + length]), at < part.stop
        at += length


def _gzip_chunks(file: pa.NativeFile, part: ByteRange) -> Iterator[tuple[bytes, bool]]:
    one, fresh = zlib.decompressobj(31), True
    while data := file.read(STEP):
        while data:
            if one.eof:
                one, fresh = zlib.decompressobj(31), True
            text = one.decompress(data, STEP)
            fresh = False
            data = one.unused_data if one.eof else one.unconsumed_tail
            yield text, True
    if not one.eof and not fresh:
        yield one.flush(), True
        if not one.eof:
            raise ValueError("a gzip file ends inside a member")


CHUNKS = {"plain": _plain_chunks, "blocked": _blocked_chunks, "gzip": _gzip_chunks}


def owned_documents(chunks: Iterable[tuple[bytes, bool]], delimiter: bytes, first: bool) -> Iterator[bytes]:
    """Documents of a range out of its bytes and those behind it; each chunk says if it is of the range."""
    held, base, owned, searched, inside = bytearray(), 0, 0, 0, first
    for chunk, own in chunks:
        owned += len(chunk) if own else 0
        held += chunk
        while (at := held.find(delimiter, searched)) >= 0:
            if inside:
                yield bytes(held[:at])
            inside = base + at < owned
            if not inside:
                return
            del held[: at + len(delimiter)]
            base, searched = base + at + len(delimiter), 0
        searched = max(0, len(held) - len(delimiter) + 1)
        if not inside:
            del held[:searched]
            base, searched = base + searched, 0
            if not own and base >= owned:
                return
    if inside and held:
        yield bytes(held)


def check_delimiter(delimiter: str) -> bytes:
    """The delimiter as bytes. One that can overlap itself would divide a text in more than one way."""
    data = delimiter.encode()
    if not data or any(data[:n] == data[-n:] for n in range(1, len(data))):
        raise ValueError("a delimiter must not be empty, nor end as it begins")
    return data


def plan_ranges(path: str, split: int) -> list[ByteRange]:
    """Ranges of at most ``split`` bytes of all files; names that begin with a dot or underscore are left out."""
    system, root = fs.FileSystem.from_uri(path)
    found = system.get_file_info(root)
    files = [found] if found.is_file else system.get_file_info(fs.FileSelector(root, recursive=True))
    ranges = []
    for info in sorted(files, key=lambda f: f.path):
        inner = info.path[len(root) :].split("/") if info.path != root else [info.base_name]
        if not info.is_file or not info.size or any(p[:1] in ("_", ".") for p in inner):
            continue
        form, step = "plain", split
        if info.path.endswith(".gz"):
            with system.open_input_file(info.path) as file:
                form = "blocked" if _member_length(file.read(18)) else "gzip"
            step = split if form == "blocked" else info.size
        for start in range(0, info.size, step):
            ranges.append(ByteRange(info.path, start, min(start + step, info.size), info.size, form))
    return ranges


class _Reader(DataSourceReader):
    def __init__(self, path: str, delimiter: str, split: int):
        self.path, self.delimiter, self.split = path, check_delimiter(delimiter), split

    def partitions(self) -> list[ByteRange]:
        # An empty folder still has one range, of nothing.
        return plan_ranges(self.path, self.split) or [ByteRange("", 0, 0, 0, "plain")]

    def read(self, part: ByteRange) -> Iterator[pa.RecordBatch]:
        if not part.size:
            return
        system, _ = fs.FileSystem.from_uri(self.path)
        with system.open_input_file(part.path) as file:
            texts, size = [], 0
            for text in owned_documents(CHUNKS[part.form](file, part), self.delimiter, part.start == 0):
                texts.append(text.decode("utf-8", "ignore"))
                size += len(text)
                if size >= STEP:
                    yield pa.RecordBatch.from_arrays([pa.array(texts, pa.string())], names=["text"])
                    texts, size = [], 0
            if texts:
                yield pa.RecordBatch.from_arrays([pa.array(texts, pa.string())], names=["text"])


@dataclass
class _Written(WriterCommitMessage):
    name: str


class _Writer(DataSourceWriter):
    """Tasks write into a folder of this job that readers leave out; the commit moves finished files."""

    def __init__(self, path: str, delimiter: str):
        self.path, self.delimiter, self.job = path, check_delimiter(delimiter), uuid.uuid4().hex

    def write(self, rows) -> _Written:
        system, root = fs.FileSystem.from_uri(self.path)
        folder = f"{root}/_writing-{self.job}"
        system.create_dir(folder, recursive=True)
        task = TaskContext.get()
        name = f"part-{task.partitionId():05d}-{self.job}-{task.taskAttemptId()}.txt.gz"
        with system.open_output_stream(f"{folder}/{name}", compression=None) as out:
            held = bytearray()
            for (text,) in rows:
                data = (text or "").encode()
                if self.delimiter in data:
                    raise ValueError("a text holds the delimiter")
                held += data + self.delimiter
                while len(held) >= MEMBER_TEXT:
                    out.write(gzip_member(bytes(held[:MEMBER_TEXT])))
                    del held[:MEMBER_TEXT]
            if held:
                out.write(gzip_member(bytes(held)))
            out.write(LAST_MEMBER)
        return _Written(name)

    def commit(self, messages: list[_Written | None]) -> None:
        system, root = fs.FileSystem.from_uri(self.path)
        for message in messages:
            system.move(f"{root}/_writing-{self.job}/{message.name}", f"{root}/{message.name}")
        system.delete_dir(f"{root}/_writing-{self.job}")

    def abort(self, messages: list[_Written | None]) -> None:
        system, root = fs.FileSystem.from_uri(self.path)
        if system.get_file_info(f"{root}/_writing-{self.job}").type != fs.FileType.NotFound:
            system.delete_dir(f"{root}/_writing-{self.job}")


def gzip_member(text: bytes) -> bytes:
    """One member of a blocked gzip file with at most ``MEMBER_TEXT`` bytes of text."""
    for level in (6, 0):
        packer = zlib.compressobj(level, zlib.DEFLATED, -15)
        body = packer.compress(text) + packer.flush()
        if len(body) + 26 <= MEMBER_BYTES:
            break
    head = MEMBER + bytes(5) + b"\xff" + LENGTH_FIELD + struct.pack("<H", len(body) + 25)
    return head + body + struct.pack("<II", zlib.crc32(text), len(text))


class DelimitedText(DataSource):
    """Format ``delimited``: ``(text)``. Options ``path``, ``delimiter`` and ``splitBytes``; writes blocked gzip."""

    @classmethod
    def name(cls) -> str:
        return "delimited"

    def schema(self) -> str:
        return "text string"

    def _delimiter(self) -> str:
        return self.options.get("delimiter", END_OF_TEXT)

    def reader(self, schema) -> DataSourceReader:
        return _Reader(self.options["path"], self._delimiter(), int(self.options.get("splitBytes", SPLIT_BYTES)))

    def writer(self, schema, overwrite: bool) -> DataSourceWriter:
        if overwrite:
            raise ValueError("a corpus is only added to; write to a new folder instead")
        return _Writer(self.options["path"], self._delimiter())


def _full(path: str) -> str:
    """Paths without a scheme are local; one slash after ``file:`` is as good as three."""
    if path.startswith("file:/") and not path.startswith("file://"):
        return "file://" + path[5:]
    return path if "://" in path else os.path.abspath(path)


def read_ranges(
    spark: SparkSession, path: str, delimiter: str = END_OF_TEXT, split: int = SPLIT_BYTES
) -> DataFrame:
    """``(text)``, one row per document of all files under ``path``, read in ranges of ``split`` bytes.

    A text that ends its file needs no delimiter, and nothing behind the last delimiter is no document.
    Byte sequences that are not UTF-8 are left out.
    """
    spark.dataSource.register(DelimitedText)
    options = {"path": _full(path), "delimiter": delimiter, "splitBytes": str(split)}
    return spark.read.format("delimited").options(**options).load()


def write_blocked(docs: DataFrame, path: str, text: str = "text", delimiter: str = END_OF_TEXT) -> None:
    """Write texts to blocked gzip files, each followed by ``delimiter``; files appear when all are written.

    NULL is an empty text. A text that holds the delimiter fails the job.
    """
    docs.sparkSession.dataSource.register(DelimitedText)
    options = {"path": _full(path), "delimiter": delimiter}
    docs.select(docs[f"`{text}`"].alias("text")).write.format("delimited").options(**options).mode("append").save()

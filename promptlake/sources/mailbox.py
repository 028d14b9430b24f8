"""Stored mail as a Spark source, with the place of each message.

    spark.dataSource.register(StoredMail)
    spark.read.format("stored_mail").load("/mail")          # batch
    spark.readStream.format("stored_mail").load("/mail")    # what has come since

A folder holds messages (``*.eml``) and boxes (any other file), in which a line that
begins with ``From `` begins a message.  A row has message_id (the file, and in a box the
byte at which the message begins), message_ord and content.  message_ord grows from
message to message, by natural order of the files' names (``2.eml`` before ``10.eml``) and
place in the box: it is the number of bytes before the message, so no message has to be
counted to know it.

Boxes are cut into ranges of bytes; a task reads the messages that begin in its range, the
last one to its end.  Small files share a task.  A stream goes by the time of files, then
by name, and takes what boxes have grown by; files stay as they are, boxes only grow.
Files are read through Arrow's file systems, by the executors, which hand messages over
in small batches: a range is in memory as a whole at no time.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterable, Iterator
from typing import TYPE_CHECKING

from pyspark.sql.datasource import DataSource, DataSourceReader, DataSourceStreamReader, InputPartition
from pyspark.sql.types import StructType

if TYPE_CHECKING:
    from pyarrow import RecordBatch

SCHEMA = "message_id string, message_ord long, content binary"
#: Bytes of a range, files of a task, bytes read at once, bytes of texts that Python holds to hand them over.
SPLIT_BYTES, TASK_FILES, CHUNK, HELD_BYTES = 64 << 20, 2000, 1 << 20, 4 << 20
_BEGINS = b"\nFrom "
_QUOTED = re.compile(rb"^>(?=>*From )", re.M)


def natural(name: str) -> list:
    """A key by which numbers in names go by value."""
    return [(0, int(x), "") if x.isdigit() else (1, 0, x) for x in re.findall(r"[0-9]+|[^0-9]+", name)]


class Range(InputPartition):
    """What a task reads: (file, first byte, end, message_ord of the file's first byte)."""

    def __init__(self, pieces: list[tuple[str, int, int, int]]):
        super().__init__(None)
        self.pieces = pieces


def _system(path: str):
    from pyarrow import fs

    return fs.FileSystem.from_uri(path) if re.match(r"[a-z0-9+]+:/", path) else (fs.LocalFileSystem(), path)


def listed(path: str) -> list[tuple[int, str, int]]:
    """Time in microseconds, name and size of each file that isn't hidden; empty ones are none."""
    from pyarrow import fs

    system, top = _system(path)
    info = system.get_file_info(top)
    files = system.get_file_info(fs.FileSelector(top, recursive=True)) if info.type == fs.FileType.Directory else [info]
    if info.type == fs.FileType.NotFound:
        raise FileNotFoundError(path)
    seen = (f for f in files if f.type == fs.FileType.File and f.size and not any(x[0] in "._" for x in f.path.removeprefix(top).split("/") if x))
    return [((f.mtime_ns or 0) // 1000, f.path, f.size) for f in seen]


def is_message(name: str) -> bool:
    return name.lower().endswith(".eml")


def planned(files: list[tuple[str, int, int, int]], split: int = SPLIT_BYTES) -> list[Range]:
    """Ranges of about ``split`` bytes over pieces of files, in order."""
    out: list[Range] = []
    held: list[tuple[str, int, int, int]] = []
    size = 0
    for name, start, end, base in files:
        cuts = [end] if is_message(name) else [*range(start + split, end, split), end]
        for cut in cuts:
            held.append((name, start, cut, base))
            size, start = size + cut - held[-1][1], cut
            if size >= split or len(held) >= TASK_FILES:
                out.append(Range(held))
                held, size = [], 0
    return out + ([Range(held)] if held else [])


def messages(file, start: int, end: int) -> Iterator[tuple[int, bytes]]:
    """Place and content of each message of a box that begins from ``start`` on and before ``end``; one at a time is in memory."""
    at = max(start - 1, 0)  # of the buffer's first byte
    file.seek(at)
    begun: int | None = None  # where the message that is being read begins
    buffer, scanned = (b"" if start else b"\n"), 0
    at -= 0 if start else 1
    while True:
        hit = buffer.find(_BEGINS, scanned)
        if hit < 0:
            more = file.read(CHUNK)
            if more:
                scanned = max(0, len(buffer) - len(_BEGINS) + 1)
                if begun is None and scanned:
                    buffer, at, scanned = buffer[scanned:], at + scanned, 0
                buffer += more
                continue
            if begun is not None:
                yield begun, _unwrapped(buffer[:-1] if buffer.endswith(b"\n\n") else buffer)
            return
        place = at + hit + 1
        if begun is not None:
            yield begun, _unwrapped(buffer[:hit])
        if place >= end:
            return
        begun, buffer, at, scanned = place, buffer[hit + 1 :], place, 0


def _unwrapped(raw: bytes) -> bytes:
    """A message without its first line, with quoted lines as they were."""
    return _QUOTED.sub(b"", raw.partition(b"\n")[2])


def read_range(path: str, part: Range) -> Iterator[tuple[str, int, bytes]]:
    system = _system(path)[0]
    for name, start, end, base in part.pieces:
        try:
            with system.open_input_file(name) as f:
                if is_message(name):
                    yield name, base, f.read()
                else:
                    for place, content in messages(f, start, end):
                        yield f"{name}#{place}", base + place, content
        except FileNotFoundError:  # gone since it was listed: left out, as a message that can't be fetched
            continue


def held(rows: Iterable[tuple], weight: Callable[[tuple], int]) -> Iterator[list[tuple]]:
    """``rows`` in lists that are handed over when they weigh ``HELD_BYTES``, however many or large rows are."""
    out, size = [], 0
    for row in rows:
        out.append(row)
        size += weight(row) + 100
        if size >= HELD_BYTES:
            yield out
            out, size = [], 0
    if out:
        yield out


def _batches(rows: Iterable[tuple[str, int, bytes]]) -> Iterator[RecordBatch]:
    import pyarrow as pa

    schema = pa.schema({"message_id": pa.string(), "message_ord": pa.int64(), "content": pa.binary()})
    for some in held(rows, lambda r: len(r[2])):
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*some, strict=True), schema.types, strict=True)], schema=schema)


class _Reader(DataSourceReader):
    def __init__(self, path: str, split: int):
        self.path, self.split = path, split

    def partitions(self) -> list[Range]:
        pieces, base = [], 0
        for _, name, size in sorted(listed(self.path), key=lambda f: natural(f[1])):
            pieces.append((name, 0, size, base))
            base += size
        return planned(pieces, self.split) or [Range([])]

    def read(self, partition: Range) -> Iterator[RecordBatch]:
        return _batches(read_range(self.path, partition))


class _StreamReader(DataSourceStreamReader):
    """An offset: time and name of the last message file, how far each box goes, and the bytes of all that."""

    def __init__(self, path: str, split: int):
        self.path, self.split = path, split

    def initialOffset(self) -> dict:
        return {"time": -1, "name": "", "boxes": {}, "bytes": 0}

    def latestOffset(self) -> dict:
        files = listed(self.path)
        last = max(((t, n) for t, n, _ in files if is_message(n)), default=(-1, ""))
        return {"time": last[0], "name": last[1], "boxes": {n: s for _, n, s in files if not is_message(n)}, "bytes": sum(s for *_, s in files)}

    def partitions(self, start: dict, end: dict) -> list[Range]:
        pieces, base = [], start["bytes"]
        news = sorted((t, natural(n), n, s) for t, n, s in listed(self.path) if is_message(n) and (start["time"], start["name"]) < (t, n) <= (end["time"], end["name"]))
        for *_, name, size in news:
            pieces.append((name, 0, size, base))
            base += size
        for name, size in sorted(end["boxes"].items(), key=lambda x: natural(x[0])):
            first = start["boxes"].get(name, 0)
            if size > first:
                pieces.append((name, first, size, base - first))
                base += size - first
        return planned(pieces, self.split)

    def read(self, partition: Range) -> Iterator[RecordBatch]:
        return _batches(read_range(self.path, partition))


class StoredMail(DataSource):
    """Options: path, and split_bytes of a range."""

    @classmethod
    def name(cls) -> str:
        return "stored_mail"

    def schema(self) -> str:
        return SCHEMA

    def _what(self) -> tuple[str, int]:
        return self.options["path"], int(self.options.get("split_bytes", SPLIT_BYTES))

    def reader(self, schema: StructType) -> DataSourceReader:
        return _Reader(*self._what())

    def streamReader(self, schema: StructType) -> DataSourceStreamReader:
        return _StreamReader(*self._what())

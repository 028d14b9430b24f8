"""WARC archives with a Zstandard dictionary, each record compressed on its own.

An archive starts with a skippable frame that holds a dictionary built from all
records of the archive; every record is a frame compressed with it.  Equal payloads of
``MIN_PAYLOAD`` bytes or more are stored once: one record of the smallest page id is a
response, the others are revisits that name it.  Which is which comes from an
aggregation by payload digest.  Archives are written by the tasks through
Arrow's file systems under the given folder and moved to their final names when a
task's rows are done, so a repeated task replaces its files.
"""

from __future__ import annotations

import hashlib
import io
import re
import struct
import urllib.parse
import uuid
from collections.abc import Iterator

import pandas as pd
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import checkpointed, text_of

MIN_PAYLOAD = 100
DICT_BYTES = 32 << 10
ARCHIVE_BYTES = 16 << 20
LEVEL = 6
MAGIC = 0x184D2A5D
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
_NAMES = uuid.uuid5(uuid.NAMESPACE_URL, "warc-page")


def _record(page_id: str | None, url: str | None, html: str | None, digest: str, n_bytes: int, refers_to: str | None, date: str) -> bytes:
    quoted = lambda x: urllib.parse.quote(x, safe=":/?#[]@!$&'()*+,;=-._~ ")
    rid = lambda x: f"<urn:uuid:{uuid.uuid5(_NAMES, str(x))}>"
    uri = urllib.parse.quote(url or "", safe=":/?#[]@!$&'()*+,;=%-._~")
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {n_bytes}\r\n\r\n".encode()
    block = http + (html or "").encode() if refers_to is None else http
    head = ["WARC/1.1", f"WARC-Type: {'response' if refers_to is None else 'revisit'}", f"WARC-Record-ID: {rid(page_id)}", f"WARC-Date: {date}", f"WARC-Target-URI: {uri}"]
    if refers_to is not None:
        head += [f"WARC-Profile: {PROFILE}", f"WARC-Refers-To: {rid(refers_to)}", f"X-Refers-To-Page: {quoted(refers_to)}"]
    if page_id is not None:
        head.append(f"X-Page: {quoted(page_id)}")
    head += [f"WARC-Payload-Digest: sha256:{digest}", "Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}"]
    return "\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def _dictionary(records: list[bytes]) -> bytes:
    """Trained on the records; too few of them serve as they are."""
    try:
        return zstandard.train_dictionary(DICT_BYTES, records).as_bytes()
    except zstandard.ZstdError:
        return b"".join(records)[:DICT_BYTES] or b"\r\n\r\n"


def _archive(records: list[bytes]) -> Iterator[bytes]:
    raw = _dictionary(records)
    yield struct.pack("<II", MAGIC, len(raw)) + raw
    packer = zstandard.ZstdCompressor(level=LEVEL, dict_data=zstandard.ZstdCompressionDict(raw))
    for r in records:
        yield packer.compress(r)


def _writer(folder: str, date: str):
    def write(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        from pyarrow import fs

        store, top = fs.FileSystem.from_uri(folder)
        task, done = TaskContext.get(), []

        def flush(records: list[bytes]) -> None:
            name = f"part-{task.partitionId():06d}-{len(done):05d}.warc.zst"
            hidden = f"{top}/_{task.taskAttemptId()}-{name}"
            with store.open_output_stream(hidden, compression=None) as out:
                for piece in _archive(records):
                    out.write(piece)
            done.append((hidden, f"{top}/{name}", len(records)))

        store.create_dir(top, recursive=True)
        records, held = [], 0
        for b in batches:
            for row in b.itertuples(index=False):
                records.append(_record(row.page_id, row.url, row.html, row.payload_digest, int(row.payload_bytes), row.refers_to, date))
                held += len(records[-1])
                if held >= ARCHIVE_BYTES:
                    flush(records)
                    records, held = [], 0
        if records:
            flush(records)
        for hidden, name, _ in done:
            store.move(hidden, name)
        yield pd.DataFrame([(name, n) for _, name, n in done], columns=["archive", "n_records"])

    return write


def write_archives(pages: DataFrame, folder: str, id_col: str = "page_id", url_col: str = "url", html_col: str = "html", date: str = "2024-01-01T00:00:00Z") -> int:
    """Write a record for each row of ``pages`` under ``folder``; returns the number of records.

    Null html is an empty payload, a null url an empty one, a null id has no id in
    the archive and is the largest; payloads that only rows without an id have are all
    responses, as nothing could name one.  Ids may be of any type that Spark orders.
    Repeated rows are repeated records, of which one is the response.  A payload larger
    than ``ARCHIVE_BYTES`` has an archive of its own.  An empty table writes nothing;
    other columns don't matter, whatever their names.
    """
    body = text_of(html_col)
    p = pages.select(F.col(id_col).alias("page_id"), F.col(url_col).alias("url"), body.alias("html"), F.sha2(body, 256).alias("payload_digest"), F.octet_length(body).alias("payload_bytes"))
    # of each payload the first record: the smallest id, the smallest url, and how many rows have both
    same = p.filter((F.col("payload_bytes") >= MIN_PAYLOAD) & F.col("page_id").isNotNull()).groupBy("payload_digest", "page_id", "url").agg(F.count("*").alias("c"))
    firsts = checkpointed(same.groupBy(F.col("payload_digest").alias("d")).agg(F.min(F.struct("page_id", "url", "c")).alias("f"), F.sum("c").alias("rows")).filter("rows > 1").select("d", "f"))
    p = p.join(firsts, F.col("payload_digest") == F.col("d"), "left")
    is_first = F.col("f").isNotNull() & F.col("page_id").eqNullSafe(F.col("f.page_id")) & F.col("url").eqNullSafe(F.col("f.url"))
    names = ["page_id", "url", "html", "payload_digest", "payload_bytes", "refers_to"]
    p = p.withColumn("refers_to", F.when(F.col("f").isNotNull() & ~is_first, F.col("f.page_id")))
    several = is_first & (F.col("f.c") > 1)
    if not firsts.filter("f.c > 1").isEmpty():
        # rows that agree in payload, id and url are one row with a number, of whose copies the first is the response
        equal = p.filter(several).groupBy("page_id", "url", "payload_digest", "payload_bytes").agg(F.first("html").alias("html"), F.count("*").alias("n"))
        copies = equal.select("*", F.explode(F.sequence(F.lit(1), F.col("n").cast("int"))).alias("copy")).withColumn("refers_to", F.when(F.col("copy") > 1, F.col("page_id")))
        p = p.filter(~several).select(*names).unionByName(copies.select(*names))
    p = p.select(*names)
    p = p.withColumn("html", F.when(F.col("refers_to").isNull(), F.col("html"))).sortWithinPartitions("page_id", "url", "payload_digest", "refers_to")  # a repeated task writes the same archives
    p = p.withColumns({c: F.col(c).cast("string") for c in ("page_id", "refers_to")})
    return p.mapInPandas(_writer(folder, date), "archive string, n_records long").agg(F.coalesce(F.sum("n_records"), F.lit(0))).first()[0]


def records_of(archive: bytes) -> Iterator[tuple[dict[str, str], bytes]]:
    """Headers (names in lower case) and block of each record of an archive."""
    magic, n = struct.unpack_from("<II", archive)
    if magic != MAGIC:
        raise ValueError("the archive has no leading dictionary frame")
    unpacker = zstandard.ZstdDecompressor(dict_data=zstandard.ZstdCompressionDict(archive[8 : 8 + n]))
    stream = io.BufferedReader(unpacker.stream_reader(memoryview(archive)[8 + n :], read_across_frames=True), 1 << 20)
    while line := stream.readline():
        if not line.startswith(b"WARC/"):
            raise ValueError(f"no record starts with {line[:40]!r}")
        head = {}
        while (line := stream.readline()) not in (b"\r\n", b""):
            k, _, v = line.decode().partition(":")
            head[k.strip().lower()] = v.strip()
        block = stream.read(int(head["content-length"]))
        if stream.read(4) != b"\r\n\r\n":
            raise ValueError("a record doesn't end as it should")
        yield head, block


def _reader(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for b in batches:
        for content in b["content"]:
            rows = []
            for head, block in records_of(content):
                http, _, payload = block.partition(b"\r\n\r\n")
                said = head["warc-payload-digest"].removeprefix("sha256:")
                n_bytes = int(re.search(rb"(?i)\ncontent-length:\s*(\d+)", http)[1])
                if head["warc-type"] == "response" and (hashlib.sha256(payload).hexdigest() != said or len(payload) != n_bytes):
                    raise ValueError(f"the payload of {head['warc-record-id']} is damaged")
                page, ref = (urllib.parse.unquote(x) if x is not None else None for x in (head.get("x-page"), head.get("x-refers-to-page")))
                rows.append((page, head["warc-target-uri"], n_bytes, said, head["warc-type"], ref))
            if rows:
                yield pd.DataFrame(rows, columns=["page_id", "url", "payload_bytes", "payload_digest", "record_type", "refers_to"], dtype=object)


def read_archives(spark: SparkSession, folder: str, id_type: str = "long") -> DataFrame:
    """A row for each record of the archives under ``folder``, with payloads checked against their digests.

    Ids are read as ``id_type``; one that isn't of that type is null.  A folder without
    archives gives an empty result.
    """
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.warc.zst").load(folder).select("content")
    rows = files.mapInPandas(_reader, "page_id string, url string, payload_bytes long, payload_digest string, record_type string, refers_to string")
    return rows.withColumns({c: F.col(c).try_cast(id_type) for c in ("page_id", "refers_to")})

"""Images and stored mail."""

from __future__ import annotations

import email
import email.header
import email.policy
import re
from collections.abc import Callable, Iterator

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from ..functions.text import image_facts
from ..schemas import MAIL_PART
from .mailbox import StoredMail, held


def screenshots(spark: SparkSession, root: str) -> DataFrame:
    """PNG files of a folder and of its sub-folders: path and content."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.png").option("recursiveFileLookup", "true").load(root)
    near = re.escape(root.rstrip("/")) + r"/([^/]+/)?[^/]+$"
    return files.filter(F.col("path").rlike(near)).select("path", "content")


def extract_texts(images: DataFrame, reader: Callable[[bytes], str], region: str = "top_55_percent", tasks: int | None = None) -> DataFrame:
    """A row for each image with what ``reader`` finds in it; a failure is a row with its error."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            rows = []
            for content in b["content"]:
                try:
                    rows.append((reader(bytes(content)) or "", "ok", None))
                except Exception as e:  # any failure of the given reader belongs in the row
                    rows.append(("", "error", str(e)))
            yield b[["path"]].assign(**{c: [r[i] for r in rows] for i, c in enumerate(("ocr_text_raw", "ocr_status", "error"))})

    spread = images.repartition(tasks) if tasks else images
    read = spread.mapInPandas(run, "path string, ocr_text_raw string, ocr_status string, error string")
    return read.select(*image_facts(F.col("path")), F.col("path").alias("source_image"), F.lit(region).alias("ocr_region"), "ocr_text_raw", "ocr_status", "error", F.current_timestamp().alias("processed_at"))


def _header(raw: str | None) -> str:
    return "" if raw is None else str(email.header.make_header(email.header.decode_header(raw)))


def _texts(message: email.message.Message) -> Iterator[str]:
    """Text of each part that shows; a message of one part counts whatever its type (M1)."""
    parts = message.walk() if message.is_multipart() else [message]
    for part in parts:
        if message.is_multipart() and (part.get_content_type() not in ("text/plain", "text/html") or part.get_content_disposition() == "attachment"):
            continue
        raw = part.get_payload(decode=True)
        if raw is not None:
            try:
                yield raw.decode(part.get_content_charset() or "utf-8", errors="replace")
            except LookupError:
                yield raw.decode("utf-8", errors="replace")


def stored_mail(spark: SparkSession, path: str, stream: bool = False, **options: int) -> DataFrame:
    """message_id, message_ord and content of the messages of a folder, or of those that come."""
    spark.dataSource.register(StoredMail)
    reader = spark.readStream if stream else spark.read
    return reader.format("stored_mail").options(**options).load(path)


def mail_parts(messages: DataFrame, gmail_query: str = "") -> DataFrame:
    """Stored messages to a row for each text part (R9, M1, M2); unreadable ones are left out."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
        for b in batches:
            for name, place, content in zip(*b.columns, strict=True):
                try:
                    m = email.message_from_bytes(content.as_py(), policy=email.policy.compat32)
                    head = (_header(m.get("Subject")), _header(m.get("From")), str(m.get("Date") or ""))
                    texts = list(_texts(m))
                except (ValueError, LookupError, UnicodeError):
                    continue
                for i, t in enumerate(texts):
                    yield name.as_py(), place.as_py(), *head, gmail_query, i, t

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for some in held(rows(batches), lambda r: len(r[-1])):
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*some, strict=True), schema.types, strict=True)], schema=schema)

    schema = to_arrow_schema(StructType.fromDDL(MAIL_PART))
    parts = messages.select("message_id", "message_ord", "content").mapInArrow(run, MAIL_PART)
    return parts.withColumn("email_datetime", mail_datetime(F.col("email_datetime")))


def mail_datetime(raw):
    """RFC 2822 dates in UTC, ISO form; what can't be read stays as it is (M3)."""
    plain = F.regexp_replace(F.regexp_replace(F.trim(raw), r"^[A-Za-z]{3},\s*", ""), r"\s*\([^)]*\)\s*$", "")
    t = F.coalesce(*[F.try_to_timestamp(plain, F.lit(p)) for p in ("d MMM yyyy HH:mm:ss Z", "d MMM yyyy HH:mm Z", "d MMM yyyy HH:mm:ss zzz")])
    return F.coalesce(F.date_format(F.to_utc_timestamp(t, F.current_timezone()), "yyyy-MM-dd'T'HH:mm:ss'+00:00'"), raw, F.lit(""))

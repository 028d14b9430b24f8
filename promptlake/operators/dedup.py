"""First-wins deduplication, skipping what is done, throttles."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.urls import found_urls, normalize


def first_wins(df: DataFrame, key: str, order: list[str]) -> DataFrame:
    """For each key the whole row that comes first; the map side combines (by sorting its keys: rows of texts don't fit a hash aggregate) (A1)."""
    row = F.struct(*df.columns)
    return df.groupBy(F.col(key).alias("_k")).agg(F.min_by(row, F.struct(*order)).alias("_r")).select("_r.*")


def skip_done(queue: DataFrame, done: DataFrame, key: str) -> DataFrame:
    """Rows whose key isn't done yet."""
    return queue.join(done.select(key).distinct(), key, "left_anti")


def take_first(df: DataFrame, order: list[str], n: int = 0) -> DataFrame:
    """The first n rows, all for 0 (O2)."""
    return df.orderBy(*order).limit(n) if n else df


def message_urls(parts: DataFrame, **how) -> DataFrame:
    """A row for each message with social URLs: url_count and sorted distinct urls (M4-M8)."""
    found = parts.withColumn("url", F.explode(found_urls(F.col("text"), **how)))
    keys = ["message_id", "message_ord", "subject", "from", "email_datetime", "gmail_query"]
    return found.groupBy(*keys).agg(F.array_sort(F.collect_set("url")).alias("urls")).withColumn("url_count", F.size("urls"))


def url_queue(messages: DataFrame) -> DataFrame:
    """Each URL once, with the first message that has it (M9)."""
    flat = messages.select("*", F.posexplode("urls").alias("pos", "url"))
    first = first_wins(flat.drop("urls"), "url", ["message_ord", "message_id", "pos"])
    return first.select("url", F.col("message_id").alias("source_message_id"), F.col("subject").alias("source_subject"), "email_datetime", "gmail_query", F.lit("pending").alias("status"), F.struct("message_ord", "message_id", "pos").alias("seq"))


def normalized_rows(queue: DataFrame, **how) -> DataFrame:
    """Every row of a queue with its normalised URL, those without one left out."""
    n = normalize(queue.withColumnRenamed("url", "original_url"), "original_url", **how).filter(F.coalesce("normalized_url", F.lit("")) != "")
    return n.withColumn("status", F.lit("pending"))


def normalized_queue(queue: DataFrame, order: list[str], **how) -> DataFrame:
    """Normalised URLs, each once, with the first row that leads to it."""
    return first_wins(normalized_rows(queue, **how), "normalized_url", order)

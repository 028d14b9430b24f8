"""Only what hasn't been seen, run after run.

The state is the stream's checkpoint.  ``dropDuplicates`` keeps every key; where a time
bound is acceptable give ``within`` and an event-time column, and keys older than the
watermark are forgotten.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from ..operators.library import load


def unseen(rows: DataFrame, key: str, time_col: str | None = None, within: str | None = None) -> DataFrame:
    """The first row of each key of a stream."""
    if within:
        return rows.withWatermark(time_col, within).dropDuplicatesWithinWatermark([key])
    return rows.dropDuplicates([key])


def stream_of(spark: SparkSession, path: str, schema: StructType | str, fmt: str = "json", files_per_trigger: int | None = None) -> DataFrame:
    reader = spark.readStream.schema(schema).format(fmt)
    if files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    return reader.load(path)


def run_once(rows: DataFrame, out: str, checkpoint: str, fmt: str = "parquet") -> None:
    """Everything that is there now, appended to ``out``; a later run goes on from here."""
    rows.writeStream.format(fmt).option("path", out).option("checkpointLocation", checkpoint).trigger(availableNow=True).start().awaitTermination()


def load_stream(rows: DataFrame, table: str, checkpoint: str, order: list[str]) -> None:
    """Micro-batches merged by key; one that comes again after it was committed changes nothing."""

    def each(batch: DataFrame, batch_id: int) -> None:
        load(table, batch, order, stream=checkpoint, batch_id=batch_id)

    rows.writeStream.foreachBatch(each).option("checkpointLocation", checkpoint).trigger(availableNow=True).start().awaitTermination()

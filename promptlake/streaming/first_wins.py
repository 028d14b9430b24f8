"""First-wins deduplication over runs: the first row of each key by its order, however rows arrive.

``dropDuplicates`` keeps the row that arrives first.  Here the state of a key is its best
row so far; a better one that comes in a later micro-batch, or in a later run over the
same checkpoint, replaces it and is emitted as a correction.  What is emitted can be
merged by key into a table, which then holds the same rows after any order of arrival.

The state has a row a key, in RocksDB on the executors and in the checkpoint; keys that
nobody asks for again can be forgotten after ``ttl_ms``.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle
from pyspark.sql.types import BooleanType, StructField, StructType

from ..sources import keyed

_KEY, _CORRECTS = "_key", "corrects"
ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


class _Best(StatefulProcessor):
    def __init__(self, schema: StructType, order: list[str], ttl_ms: int | None):
        self.schema, self.order, self.ttl_ms = schema, order, ttl_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.best = handle.getValueState("best", self.schema, self.ttl_ms)

    def _place(self, row: Row | tuple, names: list[str]) -> tuple:
        values = [row[names.index(c)] for c in self.order]
        return tuple((v is not None, v) if v is not None else (False,) for v in values)  # nulls first, as Spark sorts

    def handleInputRows(self, key: tuple, rows: Iterator[Row], timerValues: object) -> Iterator[Row]:  # noqa: N802, N803
        names = self.schema.fieldNames()
        old = self.best.get() if self.best.exists() else None
        first = min((tuple(r[c] for c in names) for r in rows), key=lambda r: self._place(r, names))
        if old is None or self._place(first, names) < self._place(tuple(old), names):
            self.best.update(first)
            yield Row(**dict(zip(names, first, strict=True)), **{_CORRECTS: old is not None})

    def close(self) -> None:
        pass


def first_rows(rows: DataFrame, key: str, order: list[str], ttl_ms: int | None = None) -> DataFrame:
    """The first row of each key of a stream by ``order``, and again whenever an earlier one has come; ``corrects`` says which.

    Rows that agree in all of ``order`` are decided by the one that comes first; name
    enough columns.  Null keys are a key.
    """
    spark = rows.sparkSession
    if spark.conf.get("spark.sql.streaming.stateStore.providerClass") != ROCKSDB:
        raise ValueError(f"set spark.sql.streaming.stateStore.providerClass to {ROCKSDB}")
    schema = StructType([StructField(f.name, f.dataType, True) for f in rows.schema])
    out = StructType([*schema.fields, StructField(_CORRECTS, BooleanType())])
    at_key = rows.withColumn(_KEY, F.col(key)).groupBy(_KEY)
    return at_key.transformWithState(_Best(schema, order, ttl_ms), out, "Update", "ProcessingTime" if ttl_ms else "None")


def keep_first(rows: DataFrame, table: str, checkpoint: str, key: str, order: list[str], buckets: int = keyed.BUCKETS, ttl_ms: int | None = None) -> None:
    """All that is there now, merged into a keyed table that holds the first row of each key; a later run goes on from here.

    The table has the last word: should the state have forgotten a key, the row there
    still wins if it is earlier.
    """
    names = rows.columns
    better = F.struct(*order)

    def merged(target: DataFrame, news: DataFrame, deal: Callable[[DataFrame], DataFrame]) -> DataFrame:
        both = deal(target.select(*names).unionByName(news.select(*names)))
        return both.groupBy(*keyed.PLACE, F.col(key).alias(_KEY)).agg(F.min_by(F.struct(*names), better).alias("_row")).select(*keyed.PLACE, "_row.*")

    def each(batch: DataFrame, batch_id: int) -> None:
        keyed.change(batch.sparkSession, table, batch, key, merged, lambda: rows.schema, buckets, checkpoint, batch_id)

    stream = first_rows(rows, key, order, ttl_ms).writeStream.outputMode("update").foreachBatch(each)
    stream.option("checkpointLocation", checkpoint).trigger(availableNow=True).start().awaitTermination()


def use_rocksdb(spark: SparkSession) -> None:
    """The state store that ``first_rows`` needs, for queries that begin after this."""
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", ROCKSDB)

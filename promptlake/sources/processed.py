"""Logs of what has been processed, as bucketed tables.

A run asks which rows of its queue the log lacks.  The log grows with every run, so it is
kept in hash buckets of its key, as Spark buckets tables: the join then deals out the
queue alone, and reads the log where it lies.  A run's append writes a file a bucket.

The table is an external one over a folder; a later session that opens the folder finds
the rows of earlier ones, as the buckets are in the files' names.
"""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

BUCKETS = 64


class BucketedLog:
    """Rows in hash buckets of a key, appended to."""

    def __init__(self, spark: SparkSession, folder: str, key: str, columns: str, buckets: int = BUCKETS):
        self.spark, self.key, self.buckets = spark, key, buckets
        self.name = f"log_{hashlib.md5(f'{folder} {key} {columns} {buckets}'.encode()).hexdigest()}"
        where = folder.rstrip("/").replace("'", "\\'")
        spark.sql(f"CREATE TABLE IF NOT EXISTS {self.name} ({columns}) USING parquet LOCATION '{where}' CLUSTERED BY (`{key}`) SORTED BY (`{key}`) INTO {buckets} BUCKETS")
        spark.catalog.refreshTable(self.name)

    def rows(self) -> DataFrame:
        return self.spark.table(self.name)

    def insert(self, rows: DataFrame) -> None:
        """Dealt out as buckets are, so that a task writes one."""
        rows.select(*self.rows().columns).repartition(self.buckets, self.key).write.insertInto(self.name)


@contextmanager
def bucketed(rows: DataFrame, folder: str, key: str) -> Iterator[DataFrame]:
    """``rows`` in a folder, in hash buckets of a key, for as long as they are needed: joins by the key deal out the other side alone.

    There are as many buckets as partitions of a shuffle; a folder that a killed run left is replaced.
    """
    spark, name = rows.sparkSession, f"rows_{uuid.uuid4().hex}"
    try:
        n = int(spark.conf.get("spark.sql.shuffle.partitions"))
        rows.write.format("parquet").bucketBy(n, key).option("path", folder).mode("overwrite").saveAsTable(name)
        yield spark.table(name)
    finally:
        spark.sql(f"DROP TABLE IF EXISTS {name}")
        where = spark._jvm.org.apache.hadoop.fs.Path(folder)
        where.getFileSystem(spark._jsc.hadoopConfiguration()).delete(where, True)


class ProcessedLog(BucketedLog):
    """Keys with their status: ok, error, or none."""

    def __init__(self, spark: SparkSession, folder: str, key: str, kind: str = "string", buckets: int = BUCKETS):
        self.kind = kind
        super().__init__(spark, folder, key, f"`{key}` {kind}, status string", buckets)

    def append(self, rows: DataFrame) -> None:
        """Log ``rows`` (the key, and status if they have one); null keys are no keys."""
        status = F.col("status") if "status" in rows.columns else F.lit("ok")
        news = rows.select(F.col(self.key).cast(self.kind).alias(self.key), status.alias("status")).filter(F.col(self.key).isNotNull())
        self.insert(news.distinct())

    def done(self, retry_errors: bool = False) -> DataFrame:
        """Keys that are done, repeated as they were logged; failed ones too, unless they are to be retried."""
        rows = self.rows()
        return (rows.filter(F.coalesce("status", F.lit("")) != "error") if retry_errors else rows).select(self.key)

    def lacks(self, queue: DataFrame, retry_errors: bool = False) -> DataFrame:
        """Rows of ``queue`` whose key isn't done; the log isn't shuffled, nor made distinct first."""
        return queue.join(self.done(retry_errors), self.key, "left_anti")

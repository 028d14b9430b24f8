"""Small helpers that the operators of this subpackage share."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: ASCII white space; everything else belongs to a word.
SPACE = r"[\x20\x09-\x0D]+"
#: Spark removes a query's shuffle files when the query has ended.
_TIDY = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the given Parquet tables."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share, from ``spark.checkpoint.dir``.

    Only where the setting is absent in local mode (tests) a temporary folder is set.
    """
    where = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if not where:
        current = spark.sparkContext.getCheckpointDir()
        if not current and not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
        where = current or tempfile.mkdtemp(prefix="spark-checkpoint-", dir="/tmp")
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(where)
    return where


def scratch(spark: SparkSession, what: str) -> str:
    """A new folder name under the shared folder."""
    return f"{shared_dir(spark).rstrip('/')}/promptlake/{what}-{uuid.uuid4().hex}"


def checkpointed(df: DataFrame) -> DataFrame:
    """``df`` computed once, with its rows in the shared folder: a lost executor loses nothing."""
    shared_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def settled(df: DataFrame) -> DataFrame:
    """``checkpointed``, and the shuffle files of ``df`` go when it is done; else they stay until the driver happens to collect its garbage."""
    conf = df.sparkSession.conf
    before = conf.get(_TIDY, None)
    conf.set(_TIDY, "true")
    try:
        return checkpointed(df.select("*"))  # a frame keeps the setting it was made under
    finally:
        conf.unset(_TIDY) if before is None else conf.set(_TIDY, before)


def released(*frames: DataFrame) -> None:
    """Deletes the files of checkpoints (as ``checkpointed`` returns them) that nothing reads any more."""
    for df in frames:
        sc = df.sparkSession.sparkContext
        path = sc._jvm.org.apache.hadoop.fs.Path(df._jdf.queryExecution().analyzed().rdd().getCheckpointFile().get())
        path.getFileSystem(sc._jsc.hadoopConfiguration()).delete(path, True)


def shuffle_parts(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def text_of(column: str | Column) -> Column:
    return F.coalesce(F.col(column) if isinstance(column, str) else column, F.lit(""))


def words_of(text: Column) -> Column:
    """The words of a text (runs of anything but ASCII white space), in order."""
    return F.array_remove(F.split(text, SPACE), "")

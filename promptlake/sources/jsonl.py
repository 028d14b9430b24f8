"""JSON-lines tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from ..functions.text import strip, whole_json
from .lines import lines_of, numbered, refuse, splits_of


def _fits(value: Column, schema: StructType | str) -> Column:
    """Whether a line is one JSON object, and nothing more, of this schema."""
    kind = StructType.fromDDL(schema) if isinstance(schema, str) else schema
    bad = "_not_of_the_schema"
    read = F.from_json(value, StructType([*kind.fields, StructField(bad, StringType())]), {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": bad})
    return F.coalesce(_is_object(whole_json(value)), F.lit(False)) & read[bad].isNull()


def _is_object(v: Column) -> Column:
    return F.schema_of_variant(v).startswith("OBJECT")


def _said(lines: DataFrame) -> DataFrame:
    return lines.filter(strip(F.col("value")) != "")


def read_strict(spark: SparkSession, path: str, schema: StructType | str, numbers: bool = True) -> DataFrame:
    """Blank lines are skipped; a line that isn't an object of this schema fails.

    It fails here, with file and line number, by a pass that looks for such lines before
    anything is done with the others.  Without ``numbers`` that pass is left out and the job
    that reads the line fails, without its number.
    """
    if numbers:
        lines = lines_of(spark, path)
        refuse(_said(lines).filter(~_fits(F.col("value"), schema)), lines, "not JSON of the schema")
    return spark.read.schema(schema).option("mode", "FAILFAST").json(path)


def read_objects(spark: SparkSession, path: str, schema: StructType | str) -> DataFrame:
    """As read_strict, but valid JSON that isn't an object is dropped, and fields that don't fit are null (R2)."""
    lines = lines_of(spark, path)
    refuse(_said(lines).filter(whole_json(F.col("value")).isNull()), lines, "not JSON")
    objects = spark.read.text(path).filter(strip(F.col("value")) != "").filter(_is_object(whole_json(F.col("value"))))
    return objects.select(F.from_json("value", schema).alias("r")).select("r.*")


def read_lenient(spark: SparkSession, path: str, schema: StructType | str) -> tuple[DataFrame, DataFrame]:
    """Good rows, and a quarantine of (file, line_number, line) for lines that aren't JSON; JSON that isn't an object is dropped."""
    v = whole_json(F.col("value"))
    good = spark.read.text(path).filter(strip(F.col("value")) != "").filter(_is_object(v)).select(F.from_json("value", schema).alias("r")).select("r.*")
    lines = lines_of(spark, path)
    bad = numbered(_said(lines).filter(v.isNull()), splits_of(lines))
    return good, bad.select("file", "line_number", F.col("value").alias("line"))


def processed_keys(log: DataFrame, key: str, retry_errors: bool = False) -> DataFrame:
    """The distinct keys of a log; failed ones count as done unless they are to be retried."""
    done = log.filter(F.col(key).isNotNull())
    if retry_errors:
        done = done.filter(F.coalesce(F.col("status"), F.lit("")) != "error")
    return done.select(key).distinct()


def read_processed(spark: SparkSession, path: str, schema: StructType | str, key: str) -> DataFrame:
    """Keys of a JSON-lines log, bad lines ignored."""
    return processed_keys(spark.read.schema(schema).option("mode", "DROPMALFORMED").json(path), key)


def write(df: DataFrame, path: str, append: bool = False, order: tuple[str, ...] = ()) -> None:
    """Overwrite (W1) or append (W2), nulls written; with ``order`` the part files, by name, are in that order (O1)."""
    df = df.orderBy(*order) if order else df
    df.write.mode("append" if append else "overwrite").option("ignoreNullFields", "false").json(path)


def split_by(df: DataFrame, accepted: Column, ready: str, rejected: str) -> None:
    """One classified table to two files; it is computed once."""
    held = df.persist()
    write(held.filter(accepted), ready)
    write(held.filter(~F.coalesce(accepted, F.lit(False))), rejected)
    held.unpersist()


def write_queues(df: DataFrame, path: str, platforms: tuple[str, ...]) -> None:
    """A folder for each platform; unlisted ones go to unknown."""
    df.withColumn("queue", queue_of(F.col("platform"), platforms)).write.mode("overwrite").partitionBy("queue").option("ignoreNullFields", "false").json(path)


def queue_of(platform: Column, platforms: tuple[str, ...]) -> Column:
    p = F.lower(F.trim(platform))
    return F.when(p.isin(list(platforms)), p).otherwise(F.lit("unknown"))

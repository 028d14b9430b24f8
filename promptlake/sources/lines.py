"""Lines of text files with their numbers, at any number of files and splits.

Spark cuts a file into splits and doesn't say which line of the file a row is.  Rows of a
split come in order, in one task, so a row's place in its split is its number among the
task's rows less the first one's.  One pass over the files counts the lines of each
split; sums over the splits before it say where a split begins in its file.  Only lines
that are asked for are joined with their split, so the numbers of a few lines cost that
pass and no shuffle of the files.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window


def lines_of(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """value, file, and where each line is: split (its first byte in the file) and row (a number that grows by one a line)."""
    # the row number is taken before any filter: Spark moves none below it
    return spark.read.text(path).select("value", F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("split"), F.monotonically_increasing_id().alias("row"))


def splits_of(lines: DataFrame) -> DataFrame:
    """file, split, its first row, its lines, and the lines before it in the file."""
    counted = lines.groupBy("file", "split").agg(F.min("row").alias("first"), F.count("*").alias("n_lines"))
    before = Window.partitionBy("file").orderBy("split").rowsBetween(Window.unboundedPreceding, -1)
    return counted.withColumn("lines_before", F.coalesce(F.sum("n_lines").over(before), F.lit(0)))


def numbered(some: DataFrame, splits: DataFrame) -> DataFrame:
    """``some`` of the lines with line_number (from 1) instead of split and row."""
    at = splits.select("file", "split", "first", "lines_before")
    # a line whose split isn't known was read in other splits than were counted
    number = F.coalesce(F.col("lines_before") + F.col("row") - F.col("first") + 1, F.raise_error(F.lit("the files were read in other splits than were counted")).cast("long"))
    return some.join(at, ["file", "split"], "left").withColumn("line_number", number).drop("split", "row", "first", "lines_before")


def numbered_lines(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """value, file and line_number of every line."""
    lines = lines_of(spark, path)
    return numbered(lines, splits_of(lines)).select("value", "file", "line_number")


def refuse(bad: DataFrame, lines: DataFrame, said: str) -> None:
    """Fail with file, number and text of the first of ``bad`` lines, if there is one."""
    if bad.isEmpty():  # no line is counted then
        return
    found = numbered(bad, splits_of(lines))
    first = found.orderBy("file", "line_number").select("file", "line_number", F.substring("value", 1, 200)).first()
    raise ValueError(f"{first[0]}:{first[1]}: {said}: {first[2]}")

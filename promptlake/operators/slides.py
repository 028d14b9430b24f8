"""Slides to posts."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..functions.text import availability, int_or, strip
from ..rules import MAX_SLIDES, UNAVAILABLE

#: Slides of a post that is put together from runs, and of a run.
HOT_SLIDES, RUN_SLIDES = 10_000, 2_000


def distinct_prefix(slides: DataFrame, post: str = "post_id", index: str = "slide_index", content: str = "content", most: int = MAX_SLIDES) -> DataFrame:
    """Slides of a post up to the first repeated picture, with their signature."""
    s = slides.withColumn("signature", F.sha2(content, 256))
    again = F.row_number().over(Window.partitionBy(post, "signature").orderBy(index)) > 1
    first = F.min(F.when(F.col("_again"), F.col(index))).over(Window.partitionBy(post))
    s = s.withColumn("_again", again).withColumn("_first", first)
    return s.filter((F.col("_first").isNull() | (F.col(index) < F.col("_first"))) & (F.col(index) <= most)).drop("_again", "_first")


def without_markers(rows: DataFrame) -> DataFrame:
    """Rows that are no event markers and have a post."""
    out = rows.filter(F.coalesce(F.trim(F.col("post_id").cast("string")), F.lit("")) != "")
    return out.filter(F.coalesce("event", F.lit("")) == "") if "event" in rows.columns else out


def _slide() -> Column:
    """A slide with what orders it first."""
    blank = lambda c, other="": F.coalesce(F.col(c), F.lit(other)).alias(c)
    return F.struct(
        int_or(F.col("slide_index"), 999999).alias("order"), blank("slide_filename"), blank("source_image"), int_or(F.col("slide_index"), 0).alias("slide_index"), int_or(F.col("slide_total"), 0).alias("slide_total"),
        blank("ocr_status", "unknown"), blank("ocr_text_raw"),
    )


def _combined(slides: str) -> Column:
    """Texts of sorted slides under their numbers."""
    shown = F.filter(slides, lambda x: strip(x["ocr_text_raw"]) != "")
    return F.array_join(F.transform(shown, lambda x: F.format_string("[SLIDE %02d/%02d]\n%s", x["slide_index"], x["slide_total"], strip(x["ocr_text_raw"]))), "\n\n")


def _images(slides: str) -> Column:
    return F.array_distinct(F.filter(F.transform(slides, lambda x: x["source_image"]), lambda x: x != ""))


#: Of the rows of a post or a run of slides: what is known of them, and how that of runs is put together.
_FACTS = {
    "kinds": (lambda: F.collect_set(F.nullif("content_type", F.lit(""))), lambda c: F.array_distinct(F.flatten(F.collect_list(c)))),
    "total": (lambda: F.max(F.when(F.col("ocr_status") == "ok", int_or(F.col("slide_total"), 0))), F.max),
    "n": (lambda: F.count("*"), F.sum),
    "all_ok": (lambda: F.bool_and(F.coalesce("ocr_status", F.lit("unknown")) == "ok"), F.bool_and),
}


def _facts(rows: DataFrame, *keys: str) -> DataFrame:
    return rows.groupBy(*keys).agg(F.array_sort(F.collect_list(_slide())).alias("s"), *[f().alias(k) for k, (f, _) in _FACTS.items()])


def runs_of(rows: DataFrame, run_slides: int) -> DataFrame:
    """Slides of posts in runs of at most so many, numbered in order, however many a post has.

    Rows are range-partitioned and sorted by post and place, so the number of a row in its
    task, after those of the tasks before, grows along a post; runs are equal pieces of it.
    """
    slide = _slide()
    place = [slide[c] for c in ("order", "slide_filename", "source_image")]
    rest = [slide[c] for c in ("slide_index", "slide_total", "ocr_status", "ocr_text_raw")]
    ordered = rows.repartitionByRange("post_id", *place).sortWithinPartitions("post_id", *place, *rest)
    return _facts(ordered.withColumn("run", F.floor(F.monotonically_increasing_id() / run_slides)), "post_id", "run")


def _assembled(rows: DataFrame, run_slides: int) -> DataFrame:
    """Posts from runs: texts are joined and images told apart in each run, and then run by run."""
    partial = runs_of(rows, run_slides).withColumn("text", _combined("s")).withColumn("images", _images("s"))
    g = partial.groupBy("post_id").agg(F.array_sort(F.collect_list(F.struct("run", "s", "text", "images"))).alias("r"), *[f(k).alias(k) for k, (_, f) in _FACTS.items()])
    part = lambda c: F.transform("r", lambda x: x[c])
    return g.select("post_id", F.flatten(part("s")).alias("s"), *_FACTS, F.array_join(F.filter(part("text"), lambda t: t != ""), "\n\n").alias("text"), F.array_distinct(F.flatten(part("images"))).alias("images"))


def group_posts(rows: DataFrame, patterns: tuple[str, ...] = UNAVAILABLE, latest_only: bool = False, hot_slides: int = HOT_SLIDES, run_slides: int = RUN_SLIDES, watch: Callable[[DataFrame], DataFrame] = lambda d: d) -> DataFrame:
    """OCR rows to one row a post, slides in order.

    Posts of more than ``hot_slides`` slides are put together from runs of them, made by
    many tasks; only the last step has such a post in one task, as its row has.  Which
    posts those are is counted first, over the posts' names alone; ``watch`` may observe
    the rows of that pass.
    """
    if latest_only:  # of several readings of an image the last
        last = F.row_number().over(Window.partitionBy("source_image").orderBy(F.desc("processed_at")))
        rows = rows.withColumn("_n", last).filter("_n = 1").drop("_n")
    hot = without_markers(watch(rows)).groupBy(F.col("post_id").cast("string").alias("post_id")).agg(F.count("*").alias("_n")).filter(F.col("_n") > hot_slides).select("post_id")
    rows = without_markers(rows).withColumn("post_id", F.col("post_id").cast("string"))
    whole = lambda d: _facts(d, "post_id").withColumn("text", _combined("s")).withColumn("images", _images("s"))
    g = whole(rows)
    if hot.count():
        g = whole(rows.join(hot, "post_id", "left_anti")).unionByName(_assembled(rows.join(hot, "post_id", "left_semi"), run_slides))
    g = g.withColumnRenamed("text", "ocr_text_combined_raw")
    return g.select(
        "post_id",
        F.when(F.size("kinds") == 0, "unknown").when(F.size("kinds") == 1, F.get("kinds", F.lit(0))).otherwise("mixed").alias("content_type"),
        F.coalesce("total", "n").cast("int").alias("slide_total"),
        F.col("n").cast("int").alias("slide_count_found"),
        F.transform("s", lambda x: F.struct(*[x[c].alias(c) for c in ("slide_index", "slide_filename", "source_image", "ocr_status", "ocr_text_raw")])).alias("slides"),
        F.col("images").alias("source_images"),
        "ocr_text_combined_raw",
        availability(F.col("ocr_text_combined_raw"), patterns).alias("availability_status"),
        F.col("all_ok").alias("all_ocr_status_ok"),
        F.current_timestamp().alias("grouped_at"),
    )

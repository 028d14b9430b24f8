"""Posts to the records a model reads."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import int_or, tidy
from .slides import without_markers

_SLIDE = ("slide_filename", "source_image")


def bare_slides(slides: Column) -> Column:
    """Slides that are there, without their OCR status."""
    there = F.filter(slides, lambda s: s.isNotNull())
    return F.transform(there, lambda s: F.struct(*[s[c].alias(c) for c in ("slide_index", *_SLIDE, "ocr_text_raw")]))


def distinct_images(images: Column) -> Column:
    """In order, without blanks and repeats."""
    return F.array_distinct(F.filter(images, lambda x: x.isNotNull() & (x != "")))


def prepare(posts: DataFrame) -> DataFrame:
    """Available posts for the hand-off."""
    return without_markers(posts).filter("availability_status = 'available'").select(
        "post_id", "content_type", "slide_total", "slide_count_found", "all_ocr_status_ok",
        distinct_images(F.col("source_images")).alias("source_images"), bare_slides(F.col("slides")).alias("slides"),
        "ocr_text_combined_raw", "availability_status", F.lit("ready_for_text_manipulator_agent").alias("prep_status"), F.current_timestamp().alias("prepared_at"),
    )


def sorted_slides(slides: Column) -> Column:
    """Clean slides in order of their number, equal numbers as they come; a slide without number takes its place."""
    made = F.transform(
        F.filter(slides, lambda s: s.isNotNull()),
        lambda s, i: F.struct(int_or(s["slide_index"], i + 1).alias("slide_index"), i.alias("pos"), *[F.coalesce(s[c], F.lit("")).alias(c) for c in _SLIDE], tidy(s["ocr_text_raw"]).alias("ocr_text_raw")),
    )
    return F.transform(F.array_sort(made), lambda s: F.struct(*[s[c].alias(c) for c in ("slide_index", *_SLIDE, "ocr_text_raw")]))


def hand_off(prepared: DataFrame, social_media: str = "instagram", producer: str = "text_manipulator_agent_handoff_v2", status: str = "ready_for_ai_semantic_extraction") -> DataFrame:
    """Posts with slides that aren't known to be unavailable, as model input."""
    p = prepared.withColumn("post_id", F.trim(F.coalesce(F.col("post_id").cast("string"), F.lit("")))).filter("post_id <> ''")
    p = p.filter(F.lower(F.trim(F.coalesce("availability_status", F.lit("")))) != "unavailable")
    p = p.withColumn("slides", sorted_slides(F.col("slides"))).filter(F.size("slides") > 0)
    or_count = lambda c: F.coalesce(F.nullif(F.col(c), F.lit(0)), F.size("slides")).cast("int").alias(c)
    known = lambda c: F.coalesce(F.nullif(F.col(c), F.lit("")), F.lit("unknown")).alias(c)
    return p.select(
        "post_id", F.lit(social_media).alias("prompt_social_media"), known("content_type"), or_count("slide_total"), or_count("slide_count_found"),
        F.coalesce("source_images", F.array().cast("array<string>")).alias("source_images"), "slides", tidy(F.col("ocr_text_combined_raw")).alias("ocr_text_combined_raw"),
        known("availability_status"), F.coalesce("all_ocr_status_ok", F.lit(False)).alias("source_post_all_ocr_status_ok"), F.col("prep_status").alias("source_post_prep_status"),
        F.lit(status).alias("handoff_status"), F.lit(producer).alias("producer"), F.current_timestamp().alias("prepared_at"),
    )


def outcome_counts(posts: DataFrame) -> DataFrame:
    """How many posts each gate stops."""
    missing = F.coalesce(F.trim("post_id"), F.lit("")) == ""
    gone = ~missing & (F.lower(F.trim(F.coalesce("availability_status", F.lit("")))) == "unavailable")
    empty = ~missing & ~gone & (F.size(F.filter("slides", lambda s: s.isNotNull())) <= 0)
    return posts.agg(F.count("*").alias("input_rows"), F.count_if(missing).alias("skipped_missing_post_id"), F.count_if(gone).alias("skipped_unavailable"), F.count_if(empty).alias("skipped_empty_slides"), F.count_if(~missing & ~gone & ~empty).alias("output_rows"))

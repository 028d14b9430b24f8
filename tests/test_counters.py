"""Counters of stages: what they say, and that they cost no further scan."""

import json

import pytest
from pyspark.sql import functions as F

from promptlake.plans import counters

POSTS = [("p1", "available", 2), ("p2", "unavailable", 1), (None, "available", 1), (" ", "unavailable", 1), ("p3", "available", 0), ("p4", None, 1)]


@pytest.fixture
def scans(spark):
    """A table whose rows count how often they are read."""
    seen = spark.sparkContext.accumulator(0)

    def table(df):
        def each(batches):
            for b in batches:
                seen.add(len(b))
                yield b

        return df.mapInPandas(each, df.schema)

    return table, seen


def posts(spark):
    slide = F.struct(F.lit(1).alias("slide_index"), F.lit("f").alias("slide_filename"), F.lit("i").alias("source_image"), F.lit("ok").alias("ocr_status"), F.lit("t").alias("ocr_text_raw"))
    d = spark.createDataFrame(POSTS, "post_id string, availability_status string, n int").withColumn("slides", F.array_repeat(slide, F.col("n")))
    facts = {"content_type": F.lit("post"), "slide_total": F.lit(1), "slide_count_found": F.lit(1), "all_ocr_status_ok": F.lit(True), "source_images": F.array(F.lit("i")), "ocr_text_combined_raw": F.lit("t")}
    return d.drop("n").withColumns(facts)


def test_prepared_and_handed_off(spark, scans):
    table, seen = scans
    prep, hand = counters.Stage("prep"), counters.Stage("handoff")
    rows = table(posts(spark))
    counters.prepared(rows, prep).write.format("noop").mode("overwrite").save()
    assert prep.counts() == {"input_rows": 6, "skipped_missing_post_id_rows": 2, "skipped_unavailable_rows": 2, "prepared_rows": 2}
    assert seen.value == 6  # read once
    counters.handed_off(rows.withColumn("prep_status", F.lit("x")), hand).write.format("noop").mode("overwrite").save()
    assert json.loads(hand.line()) == {"stage": "handoff", "status": "ok", "input_rows": 6, "posts_skipped_missing_post_id": 2, "posts_skipped_unavailable": 1, "posts_skipped_invalid_slides": 1, "written_rows": 2}
    assert seen.value == 12


def test_grouped_with_and_without_hot_posts(spark):
    rows = [("a", i, None) for i in range(30)] + [("b", 0, "started"), (None, 0, None), ("", 1, "x"), ("c", 0, "")]
    d = spark.createDataFrame(rows, "post_id string, slide_index int, event string").withColumns({c: F.lit(None).cast("string") for c in ("content_type", "slide_filename", "slide_total", "source_image", "ocr_status", "ocr_text_raw")})
    for how in ({}, {"hot_slides": 10, "run_slides": 7}):
        stage = counters.Stage("group")
        counters.grouped(d, stage, **how).write.format("noop").mode("overwrite").save()
        assert stage.counts() == {"input_rows": 34, "skipped_non_data_rows": 2, "skipped_missing_post_id_rows": 1, "grouped_posts": 2}


def test_nothing_comes(spark):
    stage = counters.Stage("normalise")
    counters.normalized(spark.createDataFrame([], "url string, seq int"), stage, ["seq"]).write.format("noop").mode("overwrite").save()
    assert stage.counts() == {"input_rows": 0, "blank_rows": 0, "normalized_unique_rows": 0}

"""Posts of very many slides, put together from runs."""

import random

import pytest
from pyspark.sql import functions as F

from promptlake.operators import slides

SCHEMA = "post_id string, content_type string, slide_filename string, slide_index string, slide_total int, source_image string, ocr_status string, ocr_text_raw string, event string"


@pytest.fixture(scope="module")
def rows(spark):
    r = random.Random(4)

    def slide(post, i, index):
        return (post, r.choice(["post", "post", None, ""]), f"f{i % 97:02d}.png", index, r.choice([5, 7, None]), r.choice(["", None, f"/i{i % 300}.png"]), r.choice(["ok", "ok", "error", None]), r.choice(["", None, " \n ", f" text {i}\n"]), "event" if i % 50 == 3 else None)

    few = [slide(f"p{i % 40}", i, str(i % 9)) for i in range(300)]
    hot = [slide("hot", i, str(i)) for i in range(5000)]
    same = [slide("same", i, r.choice([None, "x", "3"])) for i in range(3000)]  # no numbers, equal ones, equal rows
    return spark.createDataFrame(few + hot + same + same[:200], SCHEMA).repartition(6).cache()


def posts(df):
    return {r["post_id"]: r.asDict() for r in df.drop("grouped_at").withColumn("source_images", F.col("source_images")).collect()}


def test_same_posts_in_both_ways(rows):
    plain = posts(slides.group_posts(rows))
    assert len(plain) == 42 and plain["hot"]["slide_count_found"] == 4900
    for run in (7, 100, 2500):
        assert posts(slides.group_posts(rows, hot_slides=500, run_slides=run)) == plain


def test_a_hot_post_spreads(spark, rows):
    one = slides.without_markers(rows).filter("post_id = 'hot'")
    runs = slides.runs_of(one, 100).cache()
    assert runs.count() >= 49 and runs.filter(F.size("s") > 100).isEmpty()
    assert runs.rdd.getNumPartitions() > 1 and runs.select(F.spark_partition_id().alias("p")).distinct().count() > 1
    ends = [(r["run"], r["s"][0]["order"], r["s"][-1]["order"]) for r in runs.orderBy("run").collect()]
    assert all(x[2] <= y[1] for x, y in zip(ends, ends[1:], strict=False))  # runs follow each other


def test_no_hot_post_no_second_way(rows):
    plan = slides.group_posts(rows)._jdf.queryExecution().toString()
    assert "rangepartitioning" not in plan.lower()

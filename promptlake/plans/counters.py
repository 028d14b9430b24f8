"""Counters of stages, taken by the pass that writes or reads anyway.

    with_counts = stage.input(rows, skipped=F.col("event") != "")     # rows that come
    out = stage.output(transformed, "prepared_rows")                  # rows that go
    out.write...                                                      # the one pass
    stage.line()                                                      # one line of JSON

Counts come from Spark's observed metrics: they are sums over tasks, so nothing is scanned
again.  Steps between may not read their rows twice in one job, as a sort by ranges does.
"""

from __future__ import annotations

import json
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from ..operators import dedup, handoff, library, slides
from ..operators.classify import classify, output_rows
from ..sources.jsonl import queue_of


class Stage:
    """A stage's counters, known once what it observes has been computed."""

    def __init__(self, name: str):
        self.name, self.seen, self.given = name, [], {}

    def _observe(self, df: DataFrame, counts: dict[str, Column]) -> DataFrame:
        seen = Observation()
        self.seen.append(seen)
        return df.observe(seen, *[c.alias(k) for k, c in counts.items()])

    def input(self, df: DataFrame, **skipped: Column) -> DataFrame:
        """``df``, its rows counted as input_rows, and those of each condition."""
        return self._observe(df, {"input_rows": F.count("*")} | {k: F.count_if(c) for k, c in skipped.items()})

    def output(self, df: DataFrame, name: str = "written_rows", **parts: Column) -> DataFrame:
        return self._observe(df, {name: F.count("*")} | {k: F.count_if(c) for k, c in parts.items()})

    def counts(self) -> dict[str, int]:
        return {k: v for seen in self.seen for k, v in seen.get.items()} | self.given

    def line(self, status: str = "ok") -> str:
        return json.dumps({"stage": self.name, "status": status} | self.counts(), ensure_ascii=False)


Rows = Callable[[DataFrame, Stage], DataFrame]


def _blank(c: str) -> Column:
    return F.coalesce(F.trim(F.col(c).cast("string")), F.lit("")) == ""


def normalized(queue: DataFrame, stage: Stage, order: list[str]) -> DataFrame:
    """U11 with what came, what had no URL, and what stays."""
    return stage.output(dedup.normalized_queue(stage.input(queue, blank_rows=_blank("url")), order), "normalized_unique_rows")


def filtered(queue: DataFrame, stage: Stage) -> DataFrame:
    """F11 to F13 for a write by status, with both kinds of rows."""
    ready = F.col("status") == "pending"
    return stage.output(output_rows(classify(queue)), "input_rows", scrape_ready_rows=ready, rejected_rows=~ready, missing_url_rows=F.col("filter_reason") == "rejected_missing_normalized_url")


def split(listed: DataFrame, stage: Stage, platforms: tuple[str, ...]) -> DataFrame:
    """W4's rows with their queue, and the rows of each."""
    rows = listed.withColumn("queue", queue_of(F.col("platform"), platforms))
    return stage.output(rows, "input_rows", **{f"platform_{p}": F.col("queue") == p for p in (*platforms, "unknown")})


def grouped(rows: DataFrame, stage: Stage, **how) -> DataFrame:
    """A2 with the rows that were no slides; they are counted by the pass that looks for posts of very many slides."""
    marker = F.coalesce("event", F.lit("")) != ""
    watch = lambda d: stage.input(d, skipped_non_data_rows=marker, skipped_missing_post_id_rows=~marker & _blank("post_id"))
    return stage.output(slides.group_posts(rows, watch=watch, **how), "grouped_posts")


def prepared(posts: DataFrame, stage: Stage) -> DataFrame:
    missing = _blank("post_id")
    gone = ~missing & (F.coalesce("availability_status", F.lit("")) != "available")
    return stage.output(handoff.prepare(stage.input(posts, skipped_missing_post_id_rows=missing, skipped_unavailable_rows=gone)), "prepared_rows")


def handed_off(prepared_rows: DataFrame, stage: Stage) -> DataFrame:
    missing = _blank("post_id")
    gone = ~missing & (F.lower(F.trim(F.coalesce("availability_status", F.lit("")))) == "unavailable")
    empty = ~missing & ~gone & (F.size(F.filter("slides", lambda s: s.isNotNull())) <= 0)
    return stage.output(handoff.hand_off(stage.input(prepared_rows, posts_skipped_missing_post_id=missing, posts_skipped_unavailable=gone, posts_skipped_invalid_slides=empty)))


def loaded(batch: DataFrame, stage: Stage, table: str, order: list[str], **how) -> None:
    """L1 and L2: rows that came, and what happened to keys."""
    counts = library.load(table, stage.input(batch), order, gate=False, **how)
    stage.given = {"inserted": 0, "updated": 0} | {r["action"]: r["n_rows"] for r in counts.collect()}


def lines_of(spark: SparkSession, stages: list[Stage]) -> DataFrame:
    """stage, counter and n of the lines of stages."""
    rows = spark.createDataFrame([(s.line(),) for s in stages], "line string")
    kept = F.map_filter(F.from_json("line", "map<string, string>"), lambda k, _: ~k.isin("stage", "status"))
    return rows.select(F.get_json_object("line", "$.stage").alias("stage"), F.explode(kept).alias("counter", "n")).withColumn("n", F.col("n").cast("long"))

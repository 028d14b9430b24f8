"""The stages as one Spark application."""

from __future__ import annotations

import time
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.classify import classify
from ..operators.dedup import message_urls, normalized_queue, skip_done, url_queue
from ..operators.handoff import hand_off, prepare
from ..operators.library import flatten
from ..operators.replies import answered, validate, with_prompts
from ..operators.slides import group_posts

MODES = ("CLEAN", "INCREMENTAL")


def discover(parts: DataFrame) -> DataFrame:
    """Mail parts to classified URLs: one plan, no step between is written."""
    return classify(normalized_queue(url_queue(message_urls(parts)), ["seq"]).drop("seq"))


def posts_to_handoff(ocr_rows: DataFrame) -> DataFrame:
    """OCR rows to model input."""
    return hand_off(prepare(group_posts(ocr_rows)))


def ask_and_check(handoff: DataFrame, template: str, model: Callable[[str], str], name: str, store: str, **how) -> tuple[DataFrame, DataFrame]:
    """Replies are stored before they are judged for good, so that judging again, or running again, asks nothing again."""
    good, failed = validate(answered(with_prompts(handoff, template), model, name, store, **how))
    return flatten(good), failed


def remaining(queue: DataFrame, log: DataFrame | None, key: str, mode: str) -> DataFrame:
    """What a run has to do: all of it when it starts clean, else what the log lacks."""
    if mode not in MODES:
        raise ValueError(f"mode must be one of {MODES}")
    return queue if mode == "CLEAN" or log is None else skip_done(queue, log, key)


def clean(spark: SparkSession, folders: list[str]) -> list[str]:
    """Delete the tables, files and checkpoints that a run writes, before it starts clean; returns those that were there."""
    gone = []
    for folder in folders:
        where = spark._jvm.org.apache.hadoop.fs.Path(folder)
        if where.getFileSystem(spark._jsc.hadoopConfiguration()).delete(where, True):
            gone.append(folder)
    return gone


def run_stages(spark: SparkSession, stages: list[tuple[str, Callable[[], DataFrame | None]]]) -> DataFrame:
    """Stages in order up to the first that fails, as a summary table."""
    rows, failed = [], None
    for name, stage in stages:
        began = time.time()
        try:
            out = stage()
            n = out.count() if out is not None else None
            rows.append((name, "ok", n, None, round(time.time() - began, 2)))
        except Exception as e:  # the summary names the stage that failed
            failed = name
            rows.append((name, "failed", None, str(e)[:500], round(time.time() - began, 2)))
            break
    return spark.createDataFrame(rows, "stage string, status string, n_rows long, error string, duration_seconds double").withColumn("failed_stage", F.lit(failed))

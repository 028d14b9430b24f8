"""Logs of processed keys in buckets."""

import pytest
from pyspark.sql import functions as F

from promptlake.operators import dedup
from promptlake.sources.jsonl import processed_keys
from promptlake.sources.processed import ProcessedLog


@pytest.fixture
def no_broadcast(spark):
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)


def exchanges_over(plan, leaf):
    """Exchanges between a scan of ``leaf`` and the join above it, in a plan as text: nodes are indented by their depth."""
    lines = [(len(x) - len(x.lstrip(" :+-*()0123456789")), x) for x in plan.splitlines() if x.strip()]
    at = next(i for i, (_, x) in enumerate(lines) if leaf in x)
    found, depth = [], lines[at][0]
    for d, x in reversed(lines[:at]):
        if d < depth:
            depth = d
            if "Join" in x:
                break
            found += [x] if "Exchange" in x else []
    return found


def test_the_log_is_not_shuffled(spark, tmp_path, no_broadcast):
    log = ProcessedLog(spark, str(tmp_path / "log"), "k", "long", buckets=8)
    log.append(spark.range(0, 500).toDF("k"))
    log.append(spark.range(400, 700).toDF("k"))
    queue = spark.range(0, 1000).toDF("k").withColumn("x", F.col("k") * 2)
    left = log.lacks(queue)
    assert sorted(r["k"] for r in left.collect()) == list(range(700, 1000))
    plan = left._jdf.queryExecution().executedPlan().toString()
    plan = plan[plan.index("Initial Plan") :] if "Initial Plan" in plan else plan
    assert "SelectedBucketsCount: 8 out of 8" in plan or "Bucketed: true" in plan
    assert not exchanges_over(plan, log.name) and exchanges_over(plan, "Range")
    assert len({f.rsplit("_", 1)[1] for f in log.rows().inputFiles()}) == 8 and len(log.rows().inputFiles()) <= 16  # a file a bucket and run


def test_runs_and_retries(spark, tmp_path):
    folder = str(tmp_path / "log")
    log = ProcessedLog(spark, folder, "url", buckets=4)
    queue = spark.createDataFrame([("a", 1), ("b", 2), (None, 3), ("c", 4), ("c", 5)], "url string, n int")
    assert log.lacks(queue).count() == 5  # nothing is done yet
    log.append(spark.createDataFrame([("a", "ok"), ("b", "error"), (None, "ok"), ("a", "ok")], "url string, status string"))
    names = lambda d: sorted((str(r["url"]), r["n"]) for r in d.collect())
    assert names(log.lacks(queue)) == [("None", 3), ("c", 4), ("c", 5)]
    assert names(log.lacks(queue, retry_errors=True)) == [("None", 3), ("b", 2), ("c", 4), ("c", 5)]
    log.append(spark.createDataFrame([("b",)], "url string"))
    assert names(log.lacks(queue, retry_errors=True)) == [("None", 3), ("c", 4), ("c", 5)]
    for retry in (False, True):  # as the join with distinct keys
        assert names(log.lacks(queue, retry)) == names(dedup.skip_done(queue, processed_keys(log.rows(), "url", retry), "url"))
    spark.sql(f"DROP TABLE {log.name}")  # another session: the folder is all it has
    again = ProcessedLog(spark, folder, "url", buckets=4)
    assert names(again.lacks(queue)) == [("None", 3), ("c", 4), ("c", 5)]

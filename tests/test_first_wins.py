"""First rows of keys over micro-batches and runs, in any order of arrival."""

import random

import pytest

from promptlake.operators import dedup
from promptlake.sources import keyed
from promptlake.streaming import first_wins, incremental

SCHEMA = "url string, seq int, place int, title string"


@pytest.fixture
def rocksdb(spark):
    name = "spark.sql.streaming.stateStore.providerClass"
    old = spark.conf.get(name)
    first_wins.use_rocksdb(spark)
    yield
    spark.conf.set(name, old)


def rows_of(seed):
    r = random.Random(seed)
    return [(r.choice([None, *[f"u{i}" for i in range(12)]]), r.choice([None, *range(9)]), i, f"t{i}") for i in range(60)]


@pytest.mark.parametrize("seed", [1, 2])
def test_any_order_of_arrival(spark, tmp_path, rocksdb, seed):
    rows = rows_of(seed)
    want = {tuple(x) for x in dedup.first_wins(spark.createDataFrame(rows, SCHEMA), "url", ["seq", "place"]).collect()}
    random.Random(seed + 10).shuffle(rows)
    inbox, table, checkpoint = str(tmp_path / "in"), str(tmp_path / "table"), str(tmp_path / "cp")
    stream = lambda: incremental.stream_of(spark, inbox, SCHEMA, "parquet", files_per_trigger=1)
    for part in (rows[:25], rows[25:40], rows[40:]):  # runs, the first of several micro-batches
        spark.createDataFrame(part, SCHEMA).repartition(2 if len(part) == 25 else 1).write.mode("append").parquet(inbox)
        first_wins.keep_first(stream(), table, checkpoint, "url", ["seq", "place"], buckets=4)
    assert {tuple(x) for x in keyed.read(spark, table).collect()} == want
    there = keyed.versions(spark, table)
    first_wins.keep_first(stream(), table, checkpoint, "url", ["seq", "place"], buckets=4)
    assert keyed.versions(spark, table) == there  # nothing has come


def test_corrections(spark, tmp_path, rocksdb):
    inbox, seen = str(tmp_path / "in"), []

    def run(*rows):
        spark.createDataFrame(list(rows), SCHEMA).coalesce(1).write.mode("append").parquet(inbox)
        out = first_wins.first_rows(incremental.stream_of(spark, inbox, SCHEMA, "parquet"), "url", ["seq"])
        got = []
        out.writeStream.outputMode("update").foreachBatch(lambda b, _: got.extend(b.collect())).option("checkpointLocation", str(tmp_path / "cp")).trigger(availableNow=True).start().awaitTermination()
        seen.append({(r["url"], r["title"], r["corrects"]) for r in got})

    run(("a", 5, 0, "late"), ("a", 7, 0, "later"), ("b", 1, 0, "first"))
    run(("a", 6, 0, "between"), ("b", 2, 0, "second"))
    run(("a", 3, 0, "earlier"), ("c", None, 0, "new"))
    run(("c", 0, 0, "not before null"), ("a", 3, 0, "equal"))
    assert seen == [{("a", "late", False), ("b", "first", False)}, set(), {("a", "earlier", True), ("c", "new", False)}, set()]


def test_needs_its_state_store(spark, tmp_path):
    spark.createDataFrame([("a", 1, 1, "t")], SCHEMA).write.parquet(str(tmp_path / "in"))
    with pytest.raises(ValueError, match="RocksDB"):
        first_wins.first_rows(incremental.stream_of(spark, str(tmp_path / "in"), SCHEMA, "parquet"), "url", ["seq"])

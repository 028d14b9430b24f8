"""Keyed tables in buckets: what a change rewrites, what readers see when a writer stops, conflicts, repeats, vacuum."""

import glob
import os

import pytest
from pyspark.sql import functions as F

from promptlake.operators import library
from promptlake.sources import keyed

COLUMNS = "prompt_unique_id string, n int, note string, seq int"


def rows_of(spark, rows, columns=COLUMNS):
    return spark.createDataFrame(rows, columns)


def files(table):
    return {os.path.relpath(f, table) for f in glob.glob(f"{table}/data/*/*/*.parquet")}


def live(spark, table):
    return {os.path.relpath(f, f"file://{table}") for f in keyed.read(spark, table).inputFiles()}


def state(df):
    return {r["prompt_unique_id"]: (r["n"], r["note"]) for r in df.collect()}


def put(table, batch, **how):
    return {r["action"]: r["n_rows"] for r in library.load(table, batch, ["seq"], gate=False, buckets=16, **how).collect()}


@pytest.fixture
def table(spark, tmp_path):
    t = str(tmp_path / "t")
    assert put(t, rows_of(spark, [(f"k{i}", i, "first", 0) for i in range(200)])) == {"inserted": 200}
    return t


def test_only_touched_buckets_are_rewritten(spark, table):
    before = live(spark, table)
    keys = ["k3", "k77", "new"]
    touched = {r[0] for r in spark.createDataFrame([(k,) for k in keys], "prompt_unique_id string").select(keyed.bucket_of("prompt_unique_id", 16)).collect()}
    batch = rows_of(spark, [("k3", 1003, "a", 0), ("k3", 2003, "b", 1), ("k77", 1077, "c", 0), ("new", 5, "d", 0)])
    assert put(table, batch) == {"inserted": 1, "updated": 2}
    after = live(spark, table)
    bucket = lambda f: int(f.split("bucket=")[1].split("/")[0])
    assert {bucket(f) for f in after - before} == touched == {bucket(f) for f in before - after}
    assert {f for f in before if bucket(f) not in touched} == after & before and after & before
    want = {f"k{i}": (i, "first") for i in range(200)} | {"k3": (2003, "b"), "k77": (1077, "c"), "new": (5, "d")}
    assert state(library.current(spark, table)) == want
    assert state(keyed.read(spark, table, 1)) == {f"k{i}": (i, "first") for i in range(200)}  # the version before stays readable
    few = keyed.read_keys(spark, table, ["k3", "new", "none"])
    assert state(few) == {"k3": (2003, "b"), "new": (5, "d")} and len(few.inputFiles()) < len(after)


def test_a_writer_that_stops_before_the_manifest(spark, table, monkeypatch):
    before, there = state(library.current(spark, table)), files(table)

    def stops(*_):
        raise OSError("lost")

    with monkeypatch.context() as m:
        m.setattr(keyed, "commit", stops)
        with pytest.raises(OSError, match="lost"):
            put(table, rows_of(spark, [("k1", 9, "x", 0)]))
    assert files(table) > there and state(library.current(spark, table)) == before  # its files are no part of any version
    assert put(table, rows_of(spark, [("k1", 9, "x", 0)])) == {"updated": 1}
    gone = keyed.vacuum(spark, table, keep=1)
    assert gone and files(table) == live(spark, table) and keyed.versions(spark, table) == [2]
    assert state(library.current(spark, table)) == before | {"k1": (9, "x")}


def test_two_writers_of_one_version(spark, table):
    old = keyed.manifest(spark, table)
    assert put(table, rows_of(spark, [("k1", 9, "x", 0)])) == {"updated": 1}
    with pytest.raises(keyed.Conflict):
        keyed.commit(spark, table, keyed.Manifest(old.version + 1, old.key, old.buckets, old.schema, old.folders))
    assert not [n for n in os.listdir(f"{table}/manifest") if "draft" in n]
    assert state(library.current(spark, table))["k1"] == (9, "x")


def test_batches_of_streams_once(spark, table):
    batch = rows_of(spark, [("k1", 9, "x", 0)])
    assert put(table, batch, stream="s", batch_id=0) == {"updated": 1}
    one = library.current(spark, table).filter("prompt_unique_id = 'k1'").first()
    assert put(table, batch, stream="s", batch_id=0) == {}  # comes again after it was committed
    assert library.current(spark, table).filter("prompt_unique_id = 'k1'").first() == one and keyed.versions(spark, table) == [1, 2]
    assert put(table, batch, stream="other", batch_id=0) == {"updated": 1} and put(table, batch, stream="s", batch_id=1) == {"updated": 1}


def test_columns_come_and_stay(spark, table):
    assert put(table, rows_of(spark, [("k1", 9, 4.5, 0), (None, 1, 0.5, 0)], "prompt_unique_id string, n int, more double, seq int")) == {"updated": 1, "inserted": 1}
    out = library.current(spark, table)
    assert out.filter("more is not null").count() == 2 and out.filter("prompt_unique_id = 'k1'").select("n", "note", "more").first() == (9, "first", 4.5)
    assert out.count() == 201 and out.filter("prompt_unique_id = 'k2'").select("more").first()[0] is None


def test_nothing_and_a_wrong_key(spark, table, tmp_path):
    none = rows_of(spark, [])
    assert put(table, none) == {} and keyed.versions(spark, table) == [1]
    assert put(str(tmp_path / "u"), none) == {} and keyed.versions(spark, str(tmp_path / "u")) == []
    with pytest.raises(FileNotFoundError):
        keyed.read(spark, str(tmp_path / "u"))
    with pytest.raises(ValueError, match="key"):
        keyed.change(spark, table, none, "n", lambda t, b: b, lambda: none.schema)


def test_same_rows_as_a_merge_of_all(spark, tmp_path):
    """Loads in turn agree with merges of whole tables, in any order of rows."""
    t = str(tmp_path / "t")
    whole = None
    for step in range(3):
        batch = rows_of(spark, [(f"k{i % 40}", i * 10 + step, f"s{step}", i) for i in range(step * 15, step * 15 + 60)]).repartition(3)
        put(t, batch)
        target = whole if whole is not None else spark.createDataFrame([], batch.drop("seq").schema).withColumns({c: F.lit(None).cast("timestamp") for c in ("updated_at", "created_at")})
        whole = spark.createDataFrame(library.merge(target, batch, ["seq"]).drop("action").toPandas())
        assert state(library.current(spark, t)) == state(whole)

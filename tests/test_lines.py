"""Numbers of lines in files that are cut into many splits, and what readers say with them."""

import gzip
import random

import pytest
from pyspark.sql import functions as F

from promptlake.sources import jsonl, lines


@pytest.fixture
def small_splits(spark):
    names = {"spark.sql.files.maxPartitionBytes": "700", "spark.sql.files.openCostInBytes": "0"}
    old = {k: spark.conf.get(k) for k in names}
    for k, v in names.items():
        spark.conf.set(k, v)
    yield
    for k, v in old.items():
        spark.conf.set(k, v)


@pytest.fixture(scope="module")
def files(tmp_path_factory):
    """Files of lines of any length, with blank ones, line ends of both kinds, none at the end, and nothing at all."""
    top, r, want = tmp_path_factory.mktemp("lines"), random.Random(2), {}
    for name, n, end in (("a.txt", 900, "\n"), ("b.txt", 1, "\n"), ("c.txt", 333, "\r\n"), ("d.txt", 0, "\n"), ("e.txt.gz", 200, "\n")):
        rows = [f"{name} {i} " + "é" * r.choice([0, 1, 5, 40, 2000 if i % 100 == 0 else 3]) if i % 11 else "" for i in range(n)]
        data = end.join(rows).encode() + (end.encode() if n and name != "a.txt" else b"")
        (top / name).write_bytes(gzip.compress(data) if name.endswith("gz") else data)
        want |= {(name, i + 1): x for i, x in enumerate(rows) if i < n - 1 or x or name != "a.txt"}
    return str(top), want


def test_numbers(spark, files, small_splits):
    top, want = files
    found = lines.lines_of(spark, top)
    assert found.select("file", "split").distinct().count() > 40 and found.rdd.getNumPartitions() > 20
    got = {(r["file"].rsplit("/", 1)[1], r["line_number"]): r["value"] for r in lines.numbered_lines(spark, top).collect()}
    assert got == want


def test_only_lines_that_are_asked_for_are_joined(spark, files, small_splits):
    top, want = files
    found = lines.lines_of(spark, top)
    some = lines.numbered(found.filter(F.col("value").endswith("7 ")), lines.splits_of(found))
    assert {(r["file"].rsplit("/", 1)[1], r["line_number"]) for r in some.collect()} == {k for k, v in want.items() if v.endswith("7 ")}


def test_strict_says_where(spark, tmp_path, small_splits):
    good = ['{"k": %d, "t": "%s"}' % (i, "x" * (i % 50)) for i in range(400)]
    for name, at, line in (("one", 399, "{"), ("two", 0, "[1]"), ("three", 217, '{"k": "text", "t": ""}'), ("four", 300, '{"k": 1} 2')):
        (tmp_path / name).write_text("\n".join([*good[:at], "", line, *good[at:]]))
        with pytest.raises(ValueError, match=rf"{name}:{at + 2}: not JSON of the schema"):
            jsonl.read_strict(spark, str(tmp_path / name), "k int, t string")
    (tmp_path / "good").write_text("\n\n" + "\n \t\n".join(good))
    assert jsonl.read_strict(spark, str(tmp_path / "good"), "k int, t string").count() == 400
    with pytest.raises(Exception, match="MALFORMED|malformed|Malformed"):
        jsonl.read_strict(spark, str(tmp_path / "one"), "k int, t string", numbers=False).collect()
    with pytest.raises(ValueError, match="one:401: not JSON: {"):
        jsonl.read_objects(spark, str(tmp_path / "one"), "k int, t string")
    assert jsonl.read_objects(spark, str(tmp_path / "two"), "k int, t string").count() == 400  # JSON that is no object is dropped


def test_quarantine_says_where(spark, tmp_path, small_splits):
    rows = ['{"k": %d}' % i if i % 13 else f"bad {i}" if i % 2 else "" for i in range(1000)]
    (tmp_path / "rows").write_text("\n".join(rows))
    good, bad = jsonl.read_lenient(spark, str(tmp_path / "rows"), "k int")
    assert good.count() == sum(1 for i in range(1000) if i % 13)
    assert {(r["line_number"], r["line"]) for r in bad.collect()} == {(i + 1, x) for i, x in enumerate(rows) if x.startswith("bad")}


def test_other_splits_are_no_wrong_numbers(spark, files, small_splits):
    found = lines.lines_of(spark, files[0])
    counted = spark.createDataFrame(lines.splits_of(found).filter("split = 0").collect(), lines.splits_of(found).schema)
    with pytest.raises(Exception, match="other splits"):
        lines.numbered(found, counted).collect()

"""Readers, writers, mail, callables and runs against DuckDB over the given tables."""

import glob
import os

import duckdb
import pytest

from promptlake.plans import io_queries, pipeline
from promptlake.sources import jsonl

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for f in glob.glob(f"{SF}/*.parquet"):
        con.execute(f"CREATE VIEW {os.path.basename(f)[:-8]} AS SELECT * FROM '{f}'")
    return con


@pytest.mark.parametrize("name", list(io_queries.QUERIES))
def test_against_sql(spark, duck, name):
    got = io_queries.QUERIES[name](spark, SF)
    want = duck.execute(io_queries.ORACLE_SQL[name])
    names = sorted(got.columns)
    assert names == sorted(c[0] for c in want.description)
    at = [[c[0] for c in want.description].index(n) for n in names]
    expected = sorted((tuple(r[i] for i in at) for r in want.fetchall()), key=repr)
    assert expected and sorted((tuple(r) for r in got.select(*[f"`{n}`" for n in names]).collect()), key=repr) == expected


def test_ordered_export_and_clean(spark, tmp_path):
    out = str(tmp_path / "out")
    jsonl.write(spark.range(1000).selectExpr("(id * 7919) % 1000 AS k"), out, order=("k",))
    lines = [line for f in sorted(glob.glob(f"{out}/part-*")) for line in open(f)]
    assert lines == [f'{{"k":{i}}}\n' for i in range(1000)]
    assert pipeline.clean(spark, [out, str(tmp_path / "none")]) == [out] and not os.path.exists(out)

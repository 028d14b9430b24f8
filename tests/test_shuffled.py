"""How often texts are dealt out: bytes that steps shuffle, beside those of their texts."""

import base64
import random

import pytest

from pyspark.sql import functions as F

from promptlake.operators import library, replies
from promptlake.sources import keyed

N, LENGTH = 300, 8000


@pytest.fixture
def written(spark):
    """Bytes shuffled since the last call."""
    sc, seen = spark.sparkContext, set()

    def more():
        sc._jsc.sc().listenerBus().waitUntilEmpty()
        stages = sc._jsc.sc().statusStore().stageList(None, False, False, sc._gateway.new_array(sc._jvm.double, 0), None)
        new = {(s.stageId(), s.attemptId()): s.shuffleWriteBytes() for s in (stages.apply(i) for i in range(stages.size()))}
        out = sum(n for k, n in new.items() if k not in seen)
        seen.update(new)
        return out

    more()
    return more


def texts():
    """Texts in which a shuffle's compression finds nothing, and their bytes."""
    r = random.Random(5)
    return [base64.b64encode(r.randbytes(LENGTH * 3 // 4)).decode() for _ in range(N)], N * LENGTH


def test_prompts_are_dealt_out_once(spark, tmp_path, written):
    found, size = texts()
    d = spark.createDataFrame([(str(i), "post", t) for i, t in enumerate(found)], "post_id string, content_type string, user_prompt string")
    run = lambda: replies.answered(d, lambda p: "no JSON", "m", str(tmp_path / "store"), waves=2, buckets=4).collect()
    rows = run()
    assert len(rows) == N and {r["n_rounds"] for r in rows} == {3}
    assert 0.8 * size < written() < 2 * size  # by six waves before
    assert sorted(run()) == sorted(rows) and written() < 0.5 * size  # nothing is to be asked
    assert not (tmp_path / "store/_prompts").exists()


def test_loaded_rows_are_dealt_out_once(spark, tmp_path, written):
    found, size = texts()
    d = spark.createDataFrame([(f"k{i}", t, 0) for i, t in enumerate(found)], "prompt_unique_id string, note string, seq int")
    table = str(tmp_path / "t")
    load = lambda rows: library.load(table, rows, ["seq"], gate=False, buckets=8).count() and written()
    for _ in range(2):
        assert 0.8 * size < load(d) < 1.5 * size  # twice and three times before: of a reload what is replaced is not dealt out
    assert 0.8 * size < load(d.filter("prompt_unique_id <> 'k7'")) < 1.5 * size  # the bucket of k7 is
    assert sorted(r["note"] for r in library.current(spark, table).collect()) == sorted(found)


def test_loads_of_whole_and_mixed_buckets(spark, tmp_path):
    """Rows that a load lacks stay as they are, alone in their bucket or beside replaced ones; so do those without a key, and columns that the load lacks."""
    table, put = str(tmp_path / "t"), lambda rows, columns: library.load(str(tmp_path / "t"), spark.createDataFrame(rows, columns), ["seq"], gate=False, buckets=4).collect()
    put([(f"k{i}", i, f"note {i}", 0) for i in range(40)] + [(None, -1, "none", 0)], "prompt_unique_id string, n int, note string, seq int")
    at = {r[0]: r["b"] for r in library.current(spark, table).withColumn("b", keyed.bucket_of("prompt_unique_id", 4)).select("prompt_unique_id", "b").collect()}
    there = sorted(set(at.values()) - {at[None]})
    whole, lone = there[0], next(k for k, b in at.items() if b == there[1])
    news = [k for k, b in at.items() if k and (b in (whole, at[None]) or b == there[1] and k != lone)]
    counts = put([(k, 1000 + int(k[1:]), s) for k in news for s in (1, 0)] + [(None, 7, 0), ("new", 5, 0)], "prompt_unique_id string, n int, seq int")
    assert {r["action"]: r["n_rows"] for r in counts} == {"inserted": 2, "updated": len(news)}
    got = sorted((tuple(r) for r in library.current(spark, table).select("prompt_unique_id", "n", "note").collect()), key=repr)
    want = [(f"k{i}", i + 1000 * (f"k{i}" in news), f"note {i}") for i in range(40)] + [(None, -1, "none"), (None, 7, None), ("new", 5, None)]
    assert got == sorted(want, key=repr)
    assert library.current(spark, table).filter(F.col("updated_at") > F.col("created_at")).count() == len(news)

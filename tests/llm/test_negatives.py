"""Hard negatives against all pairs, and their scores against products."""

import math
import random

import numpy as np
import pandas as pd
import pytest

from promptlake.llm import negatives

SCHEMA = "vec_id long, embedding array<float>, label int, score string, rank string, n string, rid string, id string"


def make(n, dims=20, seed=2):
    r = random.Random(seed)
    kinds = [[r.gauss(0, 0.3) for _ in range(dims)] for _ in range(6)]
    rows = [(i, [c + r.gauss(0, 0.1) for c in r.choice(kinds)], r.randrange(10)) for i in range(n)]
    same = kinds[0]
    rows += [(5000 + i, same, i % 3) for i in range(300)]  # a very common vector: ties
    rows += [(200, kinds[1], 4)] * 7 + [(9000, kinds[2], 4)] * 3 + [(100, kinds[3], 2)] * 2  # copies of anchors and of others
    rows += [(None, same, 1), (None, same, 2), (300, None, 1), (400, same, None), (500, [0.1, None], 1), (600, [float("nan")] * 3, 1), (700, [float("inf")], 1)]
    rows += [(800, [], 1), (801, [], 2), (9100, [0.5], 3), (9101, [0.5, -0.25, 3.0] * 15, 3), (9200, [-0.5, -0.5], 5)]
    return rows


def expected(rows):
    """Every anchor's positives and negatives, pair by pair, in whole numbers."""
    rows = [(i, [math.floor(256 * float(np.float32(x))) for x in v], (k + 1) % 10 if i is not None and i % 7 == 0 else k) for i, v, k in rows if k is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)]
    dot = lambda a, b: sum(x * y for x, y in zip(a, b))  # noqa: B905, E731
    order = lambda x: (-x[0], x[1] is None, x[1] or 0)
    out = []
    for at, (i, v, k) in enumerate(rows):
        if i is None or i % 100:
            continue
        scored = [(dot(v, w), j, m) for place, (j, w, m) in enumerate(rows) if place != at]
        others = sorted((x for x in scored if x[2] != k), key=order)
        for p, j, _ in sorted((x for x in scored if x[2] == k), key=order)[:5]:
            out += [(i, j, rank + 1, x[1], p, x[0]) for rank, x in enumerate([x for x in others if 80 * p <= 100 * x[0] <= 100 * p][:5])]
    return sorted(out, key=repr)


@pytest.mark.parametrize("cell", [(2048, 32_768), (2, 100)])
def test_against_all_pairs(spark, monkeypatch, cell):
    monkeypatch.setattr(negatives, "BLOCK_ANCHORS", cell[0])
    monkeypatch.setattr(negatives, "PART_ROWS", cell[1])
    rows = make(600)
    e = spark.createDataFrame([(*x, *["clash"] * 5) for x in rows], SCHEMA).repartition(5)
    got = sorted(map(tuple, negatives.hard_negatives(negatives.relabelled(e)).collect()), key=repr)
    want = expected(rows)
    assert len(want) > 100 and got == want


def test_scores_are_exact():
    r = np.random.default_rng(4)
    for low, high, dims in ((-300, 300, 64), (-1, 2, 7), (-(2**40), 2**40, 9), (0, 1, 8), (-(2**20), 2**20, 33)):
        a, c = r.integers(low, high, (37, dims)), r.integers(low, high, (1500, dims))
        x, y = (negatives.quantised(pd.Series(list(v / 256))) for v in (a, c))
        want = np.array([[sum(int(p) * int(q) for p, q in zip(u, v, strict=True)) for u in a] for v in c[:40]], dtype=object)
        for r0, a0, s in negatives._scored(x, y):
            assert s.shape[1] == 37 and a0 == 0
            if r0 == 0:
                assert (s[:40].astype(object) == np.clip(want, -(2**63), 2**63 - 1)).all()


def test_huge_components_and_empty(spark):
    e = spark.createDataFrame([(0, [1e30, 1.0], 1), (1, [1e30, 2.0], 1), (2, [1e29], 2), (3, [1.0], 3)], "vec_id long, embedding array<double>, label int")
    top = 2**63 - 1
    assert [tuple(x) for x in negatives.hard_negatives(e).collect()] == [(0, 1, 1, 2, top, top), (0, 1, 2, 3, top, top)]  # both scores are over 64 bits
    none = spark.createDataFrame([], SCHEMA)
    assert negatives.hard_negatives(negatives.relabelled(none)).collect() == []

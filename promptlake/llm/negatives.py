"""Hard negatives by exact integer scores (Four-Russians look-ups), in cells of anchors and rows.

Components become floor(256 x).  For each group of eight dimensions an anchor has a table
of its 256 subset sums.  A row's components, in two's complement, are packed into bit
planes: a byte says which of eight dimensions have a bit set, so a look-up adds up to
eight components at once, and a score is the planes' sums, shifted and added.  Planes are
as many as the components of a cell need, and numbers are Python's where 64 bits could
overflow, so every score is exact.

Anchors (a stated query set) meet all rows in cells of bounded size: anchors are dealt
into blocks and sent to every part of the rows, rows to every block of anchors.  A cell
returns the best few of each anchor, windows with a group limit keep the best few of all
cells.  First each anchor's positives are found among the rows of its label, then, with
their scores as bounds, the negatives among all others, so each pair is scored once.
Equal rows are one row with a number before anything meets.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import checkpointed, shuffle_parts

#: Anchors of a block, rows of a part: the bounds of a cell.
BLOCK_ANCHORS, PART_ROWS = 2048, 32_768
#: Positives of an anchor, negatives of a positive.
POSITIVES, NEGATIVES = 5, 5
#: A negative has at least this much of its positive's score, in hundredths.
LEAST = 80
#: Of a cell, scored at once.
_ROWS, _ANCHORS = 1024, 256
_BITS = np.array([[m >> j & 1 for j in range(8)] for m in range(256)], dtype=np.int64)


def quantised(vectors: pd.Series) -> np.ndarray:
    """floor(256 x) of each component, shorter vectors filled up with zeros; 64-bit numbers, or Python's if one is too large."""
    wide = -(-max(8, max((len(v) for v in vectors), default=8)) // 8) * 8
    x = np.zeros((len(vectors), wide))
    for i, v in enumerate(vectors):
        x[i, : len(v)] = v
    with np.errstate(over="ignore"):
        y = np.floor(x * 256)
    if np.abs(y).max(initial=0) < 2**62:
        return y.astype(np.int64)
    return np.array([[int(np.floor(c)) * 256 if abs(c) > 2**53 else int(np.floor(c * 256)) for c in row] for row in x], dtype=object)


def planes(rows: np.ndarray) -> np.ndarray:
    """Bit planes (plane, row, group of eight dimensions) of numbers in two's complement, the sign's plane last."""
    most = max(int(np.max(rows, initial=0)), -int(np.min(rows, initial=0)) - 1)
    n = most.bit_length() + 1
    return np.stack([np.packbits(((rows >> p) & 1).astype(np.uint8), axis=1, bitorder="little") for p in range(n)])


def tables(anchors: np.ndarray) -> np.ndarray:
    """Subset sums (group, subset, anchor) of the anchors' components."""
    groups = anchors.reshape(len(anchors), -1, 8)
    return np.stack([(_BITS.astype(anchors.dtype) @ groups[:, g].T) for g in range(groups.shape[1])])


def scores(table: np.ndarray, packed: np.ndarray) -> np.ndarray:
    """Inner products (row, anchor): look-ups of all groups, from the sign's plane down, doubled and added."""
    total = None
    for plane in packed[::-1]:
        here = table[0].take(plane[:, 0], axis=0)
        for g in range(1, plane.shape[1]):
            here += table[g].take(plane[:, g], axis=0)
        total = -here if total is None else 2 * total + here
    return total


def _scored(anchors: np.ndarray, rows: np.ndarray) -> Iterator[tuple[int, int, np.ndarray]]:
    """Blocks of scores (row, anchor) with the place of their first row and anchor, in the smallest type that holds them all."""
    wide = max(anchors.shape[1], rows.shape[1])
    fill = lambda x: np.pad(x, ((0, 0), (0, wide - x.shape[1])))
    anchors, rows = fill(anchors), fill(rows)
    bound = 4 * wide * max(1, int(np.abs(anchors).max(initial=0))) * max(1, int(np.abs(rows).max(initial=0)))
    kind = np.int32 if bound < 2**31 else np.int64 if bound < 2**62 else object
    packed = planes(rows)
    for a in range(0, len(anchors), _ANCHORS):
        table = tables(anchors[a : a + _ANCHORS].astype(kind))
        for r in range(0, len(rows), _ROWS):
            s = scores(table, packed[:, r : r + _ROWS])
            yield r, a, s if kind is not object else np.clip(s, -(2**63), 2**63 - 1).astype(np.int64)


def _first(s: np.ndarray, ids: np.ndarray, k: int) -> np.ndarray:
    """Places of the k highest scores, ties by smaller id."""
    if len(s) > k:
        near = np.flatnonzero(s >= np.partition(s, len(s) - k)[len(s) - k])
        return near[np.lexsort((ids[near], -s[near]))[:k]]
    return np.lexsort((ids, -s))


def _positives(anchors: pd.DataFrame, rows: pd.DataFrame) -> pd.DataFrame:
    """The best rows of a part for each anchor of a block, of the anchor's label."""
    out = []
    own = dict(iter(rows.groupby("label")))
    for label, a in anchors.groupby("label"):
        if label not in own:
            continue
        r = own[label]
        ids, rid, n, none, aid = (x.to_numpy() for x in (r["id"], r["rid"], r["n"], r["no_id"], a["rid"]))
        for r0, a0, s in _scored(quantised(a["vector"]), quantised(r["vector"])):
            span = slice(r0, r0 + len(s))
            for j, x in enumerate(aid[a0 : a0 + s.shape[1]]):
                may = np.flatnonzero((rid[span] != x) | (n[span] > 1))  # another row than the anchor, or one equal to it
                at = may[_first(s[may, j], ids[span][may], POSITIVES)]
                out += [(x, ids[r0 + i], none[r0 + i], s[i, j], n[r0 + i] - (rid[r0 + i] == x)) for i in at]
    return pd.DataFrame(out, columns=["rid", "id", "no_id", "score", "copies"])


def _negatives(anchors: pd.DataFrame, rows: pd.DataFrame) -> pd.DataFrame:
    """The best rows of a part for each positive of each anchor of a block, of other labels, within the bounds."""
    out = []
    ids, labels, n, none = (rows[c].to_numpy() for c in ("id", "label", "n", "no_id"))
    aid, own, goals = anchors["rid"].to_numpy(), anchors["label"].to_numpy(), [[int(p) for p in g] for g in anchors["goals"]]
    for r0, a0, s in _scored(quantised(anchors["vector"]), quantised(rows["vector"])):
        span = slice(r0, r0 + len(s))
        for j in range(s.shape[1]):
            ranges = [(-(-LEAST * p // 100), p) for p in goals[a0 + j]]
            near = np.flatnonzero((labels[span] != own[a0 + j]) & (s[:, j] >= min(low for low, _ in ranges)) & (s[:, j] <= max(p for _, p in ranges)))
            for low, p in ranges if len(near) else ():
                may = near[(s[near, j] >= low) & (s[near, j] <= p)]
                out += [(aid[a0 + j], p, ids[r0 + i], none[r0 + i], s[i, j], n[r0 + i]) for i in may[_first(s[may, j], ids[span][may], NEGATIVES)]]
    return pd.DataFrame(out, columns=["rid", "goal", "id", "no_id", "score", "copies"])


def _best(df: DataFrame, keys: list[str], k: int) -> DataFrame:
    """The k first of each key with copies spread to rows, and their rank."""
    w = Window.partitionBy(*keys).orderBy(F.desc("score"), "id", "no_id")
    first = df.withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= k)  # the window's group limit keeps k a task before the shuffle
    spread = first.withColumn("copy", F.explode(F.sequence(F.lit(1), F.least(F.col("copies").cast("int"), F.lit(k)))))
    return spread.withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= k).drop("copies", "copy")


def _cells(anchors: DataFrame, rows: DataFrame, blocks: int, parts: int, what, schema: str) -> DataFrame:
    """Each block of anchors beside each part of the rows."""
    key = lambda c, n, salt: F.pmod(F.xxhash64(c, F.lit(salt)), F.lit(n)).cast("int")
    a = anchors.withColumn("i", key("rid", blocks, 1)).withColumn("j", F.explode(F.sequence(F.lit(0), F.lit(parts - 1))))
    r = rows.withColumn("j", key("rid", parts, 2)).withColumn("i", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))))
    a = a.toDF(*a.columns)  # both come from one table: names of their own
    return a.groupBy("i", "j").cogroup(r.groupBy("i", "j")).applyInPandas(what, schema)


def relabelled(embeddings: DataFrame, id_col: str = "vec_id", label_col: str = "label", every: int = 7, labels: int = 10) -> DataFrame:
    """Rows whose id is divisible by ``every`` have the next label."""
    return embeddings.withColumn(label_col, F.when(F.col(id_col) % every == 0, (F.col(label_col) + 1) % labels).otherwise(F.col(label_col)))


def hard_negatives(embeddings: DataFrame, anchors: Column | None = None, id_col: str = "vec_id", label_col: str = "label", vector_col: str = "embedding") -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score.

    ``anchors`` says which rows are anchors (without it, ids divisible by 100).  Rows
    without a label or vector, or with a component that is null or not finite, take no
    part.  Rows with a null id do, but are no anchors; null ids come last in ties.
    Repeated rows are rows of their own, as anchors, positives and negatives; a copy of
    an anchor is one of its positives.  Of vectors of different lengths the shorter has
    zeros where the longer goes on.  Scores are exact; one that doesn't fit 64 bits
    counts as the nearest that does.
    An empty table gives an empty result; other columns don't matter, whatever their names.
    """
    spark, kind = embeddings.sparkSession, dict(embeddings.dtypes)[vector_col]
    vector = F.col(vector_col) if kind in ("array<float>", "array<double>") else F.col(vector_col).cast("array<double>")
    chosen = anchors if anchors is not None else F.col(id_col) % 100 == 0
    rows = embeddings.select(F.col(id_col).cast("long").alias("id"), F.col(label_col).cast("long").alias("label"), vector.alias("vector"), F.coalesce(chosen, F.lit(False)).alias("is_anchor"))
    sound = F.forall("vector", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    rows = rows.filter(F.col("label").isNotNull() & F.col("vector").isNotNull() & sound).groupBy("id", "label", "vector", "is_anchor").agg(F.count("*").alias("n"))
    rows = rows.withColumn("no_id", F.col("id").isNull()).withColumn("id", F.coalesce("id", F.lit(2**63 - 1)))
    rows = checkpointed(rows.withColumn("rid", F.monotonically_increasing_id()))
    chosen = rows.filter("is_anchor")
    n_rows, n_anchors = rows.agg(F.count("*"), F.count_if("is_anchor")).first()
    blocks, parts = -(-max(n_anchors, 1) // BLOCK_ANCHORS), max(shuffle_parts(spark), -(-n_rows // PART_ROWS))
    few = "id long, no_id boolean, score long, copies long"
    positives = checkpointed(_best(_cells(chosen, rows, blocks, parts, _positives, f"rid long, {few}"), ["rid"], POSITIVES))
    goals = chosen.join(positives.groupBy("rid").agg(F.collect_set("score").alias("goals")), "rid")
    found = _best(_cells(goals, rows, blocks, parts, _negatives, f"rid long, goal long, {few}"), ["rid", "goal"], NEGATIVES)
    id_of = F.when(~F.col("no_id"), F.col("id"))
    pairs = positives.select("rid", id_of.alias("positive_id"), F.col("score").alias("positive_score")).join(found.select("rid", F.col("goal").alias("positive_score"), "rank", id_of.alias("negative_id"), F.col("score").alias("negative_score")), ["rid", "positive_score"])
    named = pairs.join(chosen.select("rid", F.col("id").alias("anchor_id"), F.explode(F.sequence(F.lit(1), F.col("n").cast("int")))), "rid")
    return named.select("anchor_id", "positive_id", F.col("rank").cast("int").alias("rank"), "negative_id", "positive_score", "negative_score")

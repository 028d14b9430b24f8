"""Mixing sources to target weights by capped water-filling.

Targets: sources share ``budget`` of all words by weight, none above ``max_epochs``
times its own words; what a capped source can't take is reshared by weight until
none is above.  The fixed point has a closed form over sources in order of
cap / weight: with the first k capped, the level of the others is
(budget - their caps) / (weights left), and source k is capped when its cap / weight
doesn't exceed its level.

Sampling: with r = target / words of a source, each document is repeated floor(r)
times whole; the rest goes to documents in a seeded hash order until their running
sum comes nearest to it.  The running sum is built from sums of hash buckets, so
that even a source with most of the rows is never ordered in one task: only the one
bucket in which a source's limit falls is ordered document by document.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import checkpointed, text_of

WEIGHTS = (5, 2, 1)
BUDGET = 1.5
MAX_EPOCHS = 2
SEED = 7
#: Hex digits of the seeded hash that name a bucket: 4096 a source.
DIGITS = 3


def n_words(text: Column) -> Column:
    return F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")).cast("long")


def targets(sources: DataFrame, weights: tuple[int, ...] = WEIGHTS, budget: float = BUDGET, max_epochs: int = MAX_EPOCHS) -> DataFrame:
    """``sources`` (source, source_size: a row per source) with weight and target.

    Weights repeat over the sources in code point order, null last.  A source
    without words gets target 0.
    """
    named = Window.orderBy(F.col("source").asc_nulls_last())
    cycle = F.element_at(F.array(*[F.lit(w).cast("long") for w in weights]), (F.pmod(F.row_number().over(named) - 1, F.lit(len(weights))) + 1).cast("int"))
    cap = F.col("source_size") * max_epochs
    ordered = Window.orderBy((cap / F.col("weight")).asc(), F.col("source").asc_nulls_last())
    before = ordered.rowsBetween(Window.unboundedPreceding, -1)
    after = ordered.rowsBetween(0, Window.unboundedFollowing)
    whole = Window.partitionBy(F.lit(1))
    t = sources.withColumn("weight", cycle)
    t = (
        t.withColumn("left", F.lit(float(budget)) * F.sum("source_size").over(whole) - F.coalesce(F.sum(cap).over(before), F.lit(0)))
        .withColumn("w_left", F.sum("weight").over(after))
        .withColumn("level", F.col("left") / F.col("w_left"))
        .withColumn("free", F.col("level") < cap / F.col("weight"))
    )
    level = F.first(F.when(F.col("free"), F.col("level")), ignorenulls=True).over(ordered.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))
    t = t.withColumn("first_level", level)
    target = F.when(F.col("free"), F.col("weight") * F.col("first_level")).otherwise(cap.cast("double"))
    return t.select("source", "source_size", "weight", target.alias("target"))


def plan_mix(sized: DataFrame, seed: int = SEED, **how) -> DataFrame:
    """``sized`` (doc_id, source, size, any others) with source_size, target, reps and taken."""
    key = F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit(""))))
    t = sized.withColumn("k", key).withColumn("b", F.substring("k", 1, DIGITS))
    buckets = checkpointed(t.groupBy("source", "b").agg(F.sum("size").alias("b_size"), F.max("size").alias("b_max")))
    goals = targets(buckets.groupBy("source").agg(F.sum("b_size").alias("source_size")), **how)
    goals = checkpointed(
        goals.withColumn("whole", F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(F.lit(0)).cast("long"))
        .withColumn("extra", F.greatest(F.col("target") - F.col("whole") * F.col("source_size"), F.lit(0.0)))
    )
    upto = Window.partitionBy("source").orderBy("b").rowsBetween(Window.unboundedPreceding, -1)
    marks = buckets.withColumn("before", F.coalesce(F.sum("b_size").over(upto), F.lit(0))).alias("m").join(goals.alias("g"), F.col("m.source").eqNullSafe(F.col("g.source")))
    # a bucket wholly below the limit is taken, one wholly above it isn't, and the one between is ordered
    state = F.when(F.col("before") >= F.col("extra"), 0).when(F.col("before") + F.col("b_size") <= F.col("extra"), 1).otherwise(2)
    marks = marks.select(F.col("m.source").alias("m_source"), F.col("m.b").alias("m_b"), "source_size", "target", "whole", "extra", "before", state.alias("state"))
    t = t.join(marks, t["source"].eqNullSafe(F.col("m_source")) & (t["b"] == F.col("m_b")))
    inner = Window.partitionBy("m_source", "m_b", "is_edge").orderBy("k", "doc_id", "size").rowsBetween(Window.unboundedPreceding, -1)
    edge = t.filter("state = 2").withColumn("is_edge", F.lit(1)).withColumn("run", F.col("before") + F.coalesce(F.sum("size").over(inner), F.lit(0))).drop("is_edge")
    # nearest: a document is in while its middle is below the limit
    edge = edge.withColumn("more", (2 * F.col("run") + F.col("size") <= 2 * F.col("extra")).cast("long")).drop("run")
    rest = t.filter("state <> 2").withColumn("more", F.col("state").cast("long"))
    return edge.unionByName(rest).withColumn("reps", F.col("whole") + F.col("more")).withColumn("taken", F.col("reps") * F.col("size")).drop("k", "b", "m_source", "m_b", "whole", "extra", "before", "state", "more")


def mix(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", **how) -> DataFrame:
    """Sizes, targets and repetitions for each row of ``docs``.

    Null texts have size 0; the null source is a source, the last; repeated rows
    count and are drawn as rows of their own; an empty table gives an empty result.
    """
    own = docs.select(F.col(id_col).alias("doc_id"), F.col(source_col).alias("source"), F.coalesce(n_words(text_of(text_col)), F.lit(0)).alias("size"))
    return plan_mix(checkpointed(own), **how)


def apply_mix(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", **how) -> DataFrame:
    """The mix itself: each row of ``docs`` as often as the plan repeats it, with its own columns.

    Rows that agree in id, source and size are drawn as one, as often as all of them
    together, and share those repetitions in the order of their texts.  Nulls and empty
    tables are as in ``mix``; columns may have any names.  Texts are shuffled once.
    """
    own = [f"c{i}" for i in range(len(docs.columns))]
    at = dict(zip(docs.columns, own))
    size = F.coalesce(n_words(text_of(at[text_col])), F.lit(0))
    # as a struct, a key meets its equal with nulls inside, and join and window take the same partitions
    key = lambda doc, source, n: F.struct(F.col(doc).alias("doc_id"), F.col(source).alias("source"), n.alias("size"))
    numbered = docs.toDF(*own).withColumn("key", key(at[id_col], at[source_col], size))
    drawn = plan_mix(checkpointed(numbered.select("key.*")), **how).groupBy(key("doc_id", "source", F.col("size")).alias("drawn")).agg(F.sum("reps").alias("reps"), F.count("*").alias("rows"))
    both = numbered.join(drawn, F.col("key") == F.col("drawn"))
    both = both.withColumn("nth", F.row_number().over(Window.partitionBy("key").orderBy(at[text_col])))
    times = (F.floor(F.col("reps") / F.col("rows")) + (F.col("nth") <= F.col("reps") % F.col("rows")).cast("int")).cast("int")
    return both.withColumn("time", F.explode(F.array_repeat(F.lit(1), times))).select(*own).toDF(*docs.columns)

"""Quality rules with thresholds that follow each language and source.

Each document gets a few integer measures, all of which vary within every group: rates
count one more than they found, so that a text without a single symbol says the more the
longer it is.  Their distribution per (lang, source) is kept as a log-linear histogram
sketch: counts of bounded-error buckets.  Such sketches merge by adding counts, so the
map side pre-aggregates them, the sketch of a language is the sum of those of its
sources, and no order of merging changes a quantile.

Thresholds are fences around the quartiles, with no floor or fixed cutoff among them.
The quartiles of a source are drawn towards those of its language as if ``PRIOR``
documents of the whole language had been added: a small source is judged mostly by its
language, a large one by itself, and none by a switch.  Fences are joined back and filter.

Everything is DataFrame functions: no Python runs on the executors.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import checkpointed, scratch, text_of, words_of

#: Measures as whole numbers: numerator and denominator (SQL over the base measures), side of the fence.
MEASURES = {
    "sym": ("100000 * (n_symbols + 1)", "(n_words + 2)", "upper"),
    "dup": ("100000 * (n_dup_lines + 1)", "(n_lines + 2)", "upper"),
    "wlen": ("100000 * word_chars", "greatest(n_words, 1)", "both"),
    "short": ("100000 * (n_short + 1)", "(n_words + 2)", "both"),
    "punct": ("100000 * (n_punct + 1)", "(n_words + 2)", "both"),
    # the square of distinct words by the root of all words, which hardly depends on length
    "variety": ("100 * n_distinct * n_distinct", "greatest(n_words, 1)", "lower"),
}
#: The upper fence is so many interquartile ranges above the upper quartile, the lower one so many quartile ratios below the lower.
ABOVE, BELOW = 4, 3
#: The quartiles of the language count as much as so many documents of the source.
PRIOR = 50
#: Buckets are exact below 2**BITS, then there are half as many in each power of two.
BITS = 9
#: Up to so many (lang, source) groups the fences (a few numbers each) are broadcast; beyond, they are joined by a shuffle.
BROADCAST_GROUPS = 100_000
BASE = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]


def with_base(docs: DataFrame, text: Column, to: str = "q") -> DataFrame:
    """``docs`` with a struct of the base measures of ``text`` (null counts as empty).

    The words in repeated three-word windows are found by sorting hashes of a
    document's windows with their positions: equal windows become neighbours, whose
    words are compared, and the covered words follow from the gaps between the flagged
    positions, in n log n steps.
    """
    w, s = "__words", "__sorted"
    at = lambda a, i: F.get(F.col(a), i)
    lines = F.filter(F.split(F.col("__text"), "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))
    windows = F.when(
        F.size(w) >= 3,
        F.transform(F.sequence(F.lit(0), F.size(w) - 3), lambda i: F.struct(F.xxhash64(at(w, i), at(w, i + 1), at(w, i + 2)).alias("h"), i.alias("i"))),
    ).otherwise(F.array().cast("array<struct<h:bigint,i:int>>"))

    def same(x: Column, y: Column) -> Column:
        words = (at(w, x["i"]) == at(w, y["i"])) & (at(w, x["i"] + 1) == at(w, y["i"] + 1)) & (at(w, x["i"] + 2) == at(w, y["i"] + 2))
        return F.coalesce((x["h"] == y["h"]) & words, F.lit(False))

    twice = F.filter(s, lambda x, k: same(x, at(s, k + 1)) | ((k > 0) & same(x, at(s, F.greatest(k - 1, F.lit(0))))))
    covered = F.aggregate(
        F.sort_array(F.transform(twice, lambda x: x["i"])),
        F.struct(F.lit(0).alias("n"), F.lit(-3).alias("last")),
        lambda acc, i: F.struct((acc["n"] + F.least(F.lit(3), i - acc["last"])).alias("n"), i.alias("last")),
        lambda acc: acc["n"],
    )
    out = (
        docs.withColumn("__text", text)
        .withColumn(w, words_of(F.col("__text")))
        .withColumn("__lines", lines)
        .withColumn(s, F.sort_array(windows))
        # a generator is computed once; the optimizer would copy plain columns into every use of them
        .select("*", F.explode(F.array(
            F.struct(
                F.size(w).cast("long").alias("n_words"),
                F.length(F.array_join(w, "")).cast("long").alias("word_chars"),
                F.regexp_count("__text", F.lit(r"[#*$%&|<>]")).cast("long").alias("n_symbols"),
                (F.size("__lines") - F.size(F.array_distinct("__lines"))).cast("long").alias("n_dup_lines"),
                covered.cast("long").alias("n_repeat_words"),
                F.size("__lines").cast("long").alias("n_lines"),
                F.size(F.filter(w, lambda x: F.length(x) <= 3)).cast("long").alias("n_short"),
                F.regexp_count("__text", F.lit(r"[.,;:!?]")).cast("long").alias("n_punct"),
                F.size(F.array_distinct(w)).cast("long").alias("n_distinct"),
            ),
        )).alias(to))
    )
    return out.drop("__text", w, "__lines", s)


def base_failed(q: str = "q") -> Column:
    return (F.col(f"{q}.n_words") < 50) | (100 * F.col(f"{q}.n_repeat_words") > 50 * F.col(f"{q}.n_words"))


def _values(q: str) -> Column:
    """A struct of all measures of the struct ``q``."""
    names = ("n_symbols", "n_words", "n_dup_lines", "n_lines", "n_repeat_words", "word_chars", "n_short", "n_punct", "n_distinct")
    own = lambda sql: " ".join(f"{q}.{t}" if t in names else t for t in sql.replace("(", "( ").replace(",", " ,").replace(")", " )").split())
    return F.struct(*[F.expr(f"({own(n)}) div {own(d)}").alias(k) for k, (n, d, _) in MEASURES.items()])


def _bucket(v: Column) -> Column:
    by = F.length(F.bin(v)) - BITS
    return F.when(v < 1 << BITS, v).otherwise(F.call_function("shiftleft", F.call_function("shiftright", v, by), by))


def _quartiles(sketch: DataFrame, keys: list[str], to: str) -> DataFrame:
    """The quartiles of each measure from the summed sketches of each ``keys``: columns ``to`` and ``to``_n."""
    upto, whole = Window.partitionBy(*keys, "m").orderBy("b"), Window.partitionBy(*keys, "m")
    at = lambda quarter: F.min(F.when(F.col("cum") * 4 >= F.col("n") * quarter, F.col("b")))
    each = (
        sketch.groupBy(*keys, "m", "b").agg(F.sum("c").alias("c"))
        .withColumn("cum", F.sum("c").over(upto)).withColumn("n", F.sum("c").over(whole))
        .groupBy(*keys, "m").agg(F.max("n").alias("n"), F.struct(at(1).alias("q1"), at(3).alias("q3")).alias("q"))
    )
    return each.groupBy(*keys).agg(F.max("n").alias(f"{to}_n"), F.struct(*[F.max(F.when(F.col("m") == k, F.col("q"))).alias(k) for k in MEASURES]).alias(to))


def _fence(k: str) -> Column:
    """low and high of a measure from the quartiles of its source and its language; without any spread it can't judge."""
    n = F.col("own_n").cast("double")
    q1, q3 = ((n * F.col(f"own.{k}.{q}") + PRIOR * F.col(f"pooled.{k}.{q}")) / (n + PRIOR) for q in ("q1", "q3"))
    ratio = F.when(q3 > 0, q1 / q3).otherwise(0.0)
    low = q1
    for _ in range(BELOW):
        low = low * ratio
    spread = q3 > q1
    return F.struct(F.when(spread, low).otherwise(0.0).alias("low"), F.when(spread, q3 + ABOVE * (q3 - q1)).otherwise(float("inf")).alias("high")).alias(k)


def fences(scored: DataFrame, lang: str, source: str, q: str = "q") -> DataFrame:
    """A row for each (lang, source): ``own_lang``, ``own_source`` and ``fence`` with low and high of each measure.

    ``scored`` has the struct ``q``.  Documents that fail the base rule don't count.
    """
    pairs = F.array(*[F.struct(F.lit(k).alias("m"), F.col(f"v.{k}").alias("v")) for k in MEASURES])
    points = scored.filter(~base_failed(q)).select(F.col(lang).alias("own_lang"), F.col(source).alias("own_source"), _values(q).alias("v"))
    points = points.select("own_lang", "own_source", F.explode(pairs).alias("p")).select("own_lang", "own_source", F.col("p.m").alias("m"), _bucket(F.col("p.v")).alias("b"))
    sketch = checkpointed(points.groupBy("own_lang", "own_source", "m", "b").agg(F.count("*").alias("c")))
    own = _quartiles(sketch, ["own_lang", "own_source"], "own")
    all_ = _quartiles(sketch.withColumnRenamed("own_lang", "l"), ["l"], "pooled")
    return own.join(all_, own["own_lang"].eqNullSafe(all_["l"]), "left").select("own_lang", "own_source", F.struct(*[_fence(k) for k in MEASURES]).alias("fence"))


def _inside() -> Column:
    """The method's verdict: every measure within its fence."""
    ok = F.lit(True)
    for k, (_, _, side) in MEASURES.items():
        v, f = F.col(f"__v.{k}").cast("double"), F.col(f"fence.{k}")
        if side != "lower":
            ok = ok & (v <= f["high"])
        if side != "upper":
            ok = ok & (v >= f["low"])
    return ok


def with_verdict(scored: DataFrame, limits: DataFrame, lang: str, source: str, q: str = "q") -> DataFrame:
    """``scored`` with the columns base_failed and kept (it must have none of these, nor own_lang, own_source and fence)."""
    limits = checkpointed(limits)
    if limits.count() <= BROADCAST_GROUPS:
        limits = F.broadcast(limits)
    joined = scored.join(limits, scored[lang].eqNullSafe(limits["own_lang"]) & scored[source].eqNullSafe(limits["own_source"]), "left").withColumn("__v", _values(q))
    return joined.withColumn("base_failed", base_failed(q)).withColumn("kept", F.coalesce(~base_failed(q) & _inside(), F.lit(False))).drop("own_lang", "own_source", "fence", "__v")


def quality_rules(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", source_col: str = "source") -> DataFrame:
    """Measures and verdict for each row of ``docs``.

    Null texts have no words and fail; null languages and sources form groups of
    their own; repeated rows each get a row; an empty table gives an empty result;
    other columns don't matter, whatever their names.  The measures are computed once
    and kept in the shared folder (a few numbers a document) for the sketch and for
    the verdict.
    """
    own = docs.select(F.col(id_col).alias("doc_id"), F.col(lang_col).alias("lang"), F.col(source_col).alias("source"), text_of(text_col).alias("t"))
    scored = checkpointed(with_base(own, F.col("t")).drop("t"))
    out = with_verdict(scored, fences(scored, "lang", "source"), "lang", "source")
    return out.select("doc_id", *[F.col(f"q.{c}").alias(c) for c in BASE], "base_failed", "kept")


def keep_good(docs: DataFrame, text_col: str = "text", lang_col: str = "lang", source_col: str = "source") -> DataFrame:
    """The rows of ``docs`` that the rules keep, with their own columns.

    Texts are measured once: rows and measures are written to the shared folder, the
    sketches read the measures there, and what the joined fences keep is read from it.
    Rows that repeat are kept or dropped together; nulls and empty tables are as in
    ``quality_rules``; columns may have any names.
    """
    own = docs.toDF(*[f"c{i}" for i in range(len(docs.columns))])
    at = {c: f"c{i}" for i, c in enumerate(docs.columns)}
    folder = scratch(docs.sparkSession, "measured")
    with_base(own, text_of(at[text_col])).write.option("compression", "zstd").parquet(folder)
    scored = docs.sparkSession.read.parquet(folder)
    limits = fences(scored, at[lang_col], at[source_col])
    return with_verdict(scored, limits, at[lang_col], at[source_col]).filter("kept").select(*own.columns).toDF(*docs.columns)

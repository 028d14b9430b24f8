"""Removal of repeated multi-line passages, by a rolling hash over line hashes; DataFrame functions only.

A line is hashed; a rolling hash over the hashes of a line and the one before it
(shift and exclusive or) ends a chunk where it is 0 modulo ``divisor``.  So boundaries
depend on the lines around them alone and an inserted line moves none that is further
away.

``dedup_lines`` removes whole chunks of one such cut: chunks of two lines or more are
counted by hash over all documents.  Of those that occur again the bytes are compared
with the first occurrence (smallest id, then place); only chunks with equal bytes are
removed, the first stays.  A passage between other lines mostly has other boundaries.

``dedup_passages`` takes the cuts of all residues of the divisor together: then each
two adjacent lines are at a boundary, whatever is around them, and their rolling hash
names them.  Two lines that occur again (first by hash, then by SHA-256) go, but for
what they share with their own first occurrence; together that is each run of two
lines or more that occurs before.  Whatever goes is still kept at an earlier place.

Hashes alone are shuffled for the counts.  ``dedup_lines`` then shuffles the bytes of
chunks that have a repeated hash (of all multi-line chunks if there are too many such
hashes to broadcast), ``dedup_passages`` digests of such lines (or of all); and once
the documents, to cut.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import checkpointed, text_of

DIVISOR = 3
#: Up to so many repeated hashes the chunks that have them are found without shuffling chunks.
BROADCAST_ROWS = 500_000


def _rolled(hashes: str, i: Column) -> Column:
    """The rolling hash at the ``i``th line (from 2)."""
    return F.shiftleft(F.get(F.col(hashes), i - 2), 1).bitwiseXOR(F.get(F.col(hashes), i - 1))


def _cuts(lines: str, hashes: str, divisor: int) -> Column:
    """The numbers of lines after which chunks end."""
    return F.filter(F.sequence(F.lit(1), F.size(lines)), lambda i: (i == F.size(lines)) | ((i > 1) & (F.pmod(_rolled(hashes, i), F.lit(divisor)) == 0)))


def with_chunks(docs: DataFrame, text: Column, divisor: int = DIVISOR) -> DataFrame:
    """``docs`` with ``chunks``: an array of k, n (lines), text."""
    d = docs.withColumn("__lines", F.split(text, "\n", -1)).withColumn("__hashes", F.transform("__lines", lambda x: F.xxhash64(x)))
    d = d.withColumn("__cuts", _cuts("__lines", "__hashes", divisor))
    start = lambda k: F.when(k > 0, F.get(F.col("__cuts"), F.greatest(k - 1, F.lit(0)))).otherwise(F.lit(0))
    chunk = lambda end, k: F.struct(k.alias("k"), (end - start(k)).alias("n"), F.array_join(F.slice("__lines", start(k) + 1, end - start(k)), "\n").alias("text"))
    return d.withColumn("chunks", F.transform("__cuts", chunk)).drop("__lines", "__hashes", "__cuts")


def dedup_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", divisor: int = DIVISOR) -> DataFrame:
    """doc_id, n_lines, n_chunks, n_removed_chunks, n_removed_lines and kept text of each row of ``docs``.

    Null texts are one empty line; rows with equal id and text are one document (they
    keep and lose the same); an empty table gives an empty result.
    """
    own = docs.select(F.col(id_col).alias("doc_id"), text_of(text_col).alias("text")).withColumn("name", F.xxhash64("text"))
    chunked = with_chunks(own, F.col("text"), divisor)
    multi = chunked.select("doc_id", "name", F.explode(F.filter("chunks", lambda c: c["n"] > 1)).alias("c"))
    place = F.struct("doc_id", "name", F.col("c.k").alias("k"))
    counted = multi.select(F.xxhash64("c.text").alias("h"), place.alias("place")).groupBy("h").agg(F.min("place").alias("first"), F.max("place").alias("last"))
    again = checkpointed(counted.filter("not (first <=> last)").select("h", "first"))
    # small enough to send to every task (some 60 bytes a row), or joined by a shuffle
    if again.count() <= BROADCAST_ROWS:
        again = F.broadcast(again)
    # occurrences of repeated hashes, with their bytes
    seen = multi.select(F.xxhash64("c.text").alias("h"), place.alias("place"), F.col("c.text").alias("bytes")).join(again, "h")
    seen = checkpointed(seen.select("h", "place", "bytes", F.col("place").eqNullSafe(F.col("first")).alias("is_first")))
    firsts = seen.filter("is_first").groupBy("h").agg(F.first("bytes").alias("first_bytes"))
    gone = seen.filter(~F.col("is_first")).join(firsts, "h").filter(F.col("bytes") == F.col("first_bytes"))
    gone = gone.groupBy(F.col("place.doc_id").alias("g_id"), F.col("place.name").alias("g_name")).agg(F.collect_set("place.k").alias("gone"))
    out = chunked.join(gone, F.col("doc_id").eqNullSafe(F.col("g_id")) & (F.col("name") == F.col("g_name")), "left").withColumn("gone", F.coalesce("gone", F.array().cast("array<int>")))
    kept = F.filter("chunks", lambda c: ~F.array_contains("gone", c["k"]))
    out = out.withColumn("kept", F.when(F.size("gone") > 0, kept).otherwise(F.col("chunks")))
    lines = lambda c: F.aggregate(c, F.lit(0), lambda acc, x: acc + x["n"])
    return out.select(
        "doc_id",
        lines("chunks").cast("long").alias("n_lines"),
        F.size("chunks").cast("long").alias("n_chunks"),
        F.size("gone").cast("long").alias("n_removed_chunks"),
        (lines("chunks") - lines("kept")).cast("long").alias("n_removed_lines"),
        F.when(F.size("gone") > 0, F.array_join(F.transform("kept", lambda c: c["text"]), "\n")).otherwise(F.col("text")).alias("kept"),
    )


def _with_lines(docs: DataFrame) -> DataFrame:
    return docs.withColumn("lines", F.split("text", "\n", -1)).withColumn("hashes", F.transform("lines", lambda x: F.xxhash64(x)))


def dedup_passages(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", divisor: int = DIVISOR) -> DataFrame:
    """doc_id, n_lines, n_chunks, n_removed_chunks, n_removed_lines and kept text of each row of ``docs``.

    A chunk counts as removed if all its lines are.  Null texts are one empty line; rows
    with equal id and text are one document (they keep and lose the same); an empty table
    gives an empty result.
    """
    own = docs.select(F.col(id_col).alias("doc_id"), text_of(text_col).alias("text")).withColumn("name", F.xxhash64("text"))
    lined = _with_lines(own).filter(F.size("lines") > 1)
    pairs = lambda *more: F.explode(F.transform(F.sequence(F.lit(2), F.size("lines")), lambda i: F.struct((i - 2).alias("k"), _rolled("hashes", i).alias("h"), *(f(i) for f in more))))
    text = lambda i: F.concat(F.get(F.col("lines"), i - 2), F.lit("\n"), F.get(F.col("lines"), i - 1)).alias("text")
    place = F.struct("doc_id", "name", F.col("c.k").alias("k"))
    counted = lined.select("doc_id", "name", pairs().alias("c")).select("c.h", place.alias("place")).groupBy("h").agg(F.min("place").alias("first"), F.max("place").alias("last"))
    again = checkpointed(counted.filter("not (first <=> last)").select("h", "first"))
    few = again.count() <= BROADCAST_ROWS
    digest = F.unhex(F.sha2("bytes", 256)).alias("digest")
    occurs = lined.select("doc_id", "name", pairs(text).alias("c")).select("c.h", place.alias("place"), F.col("c.text").alias("bytes"))
    if few:  # small enough to send to every task, where only what it meets is digested
        seen = occurs.join(F.broadcast(again), "h").select("h", "place", "first", digest)
    else:
        seen = occurs.select("h", "place", digest).join(again, "h")
    seen = checkpointed(seen.withColumn("is_first", F.col("place").eqNullSafe(F.col("first"))))
    # tables of their own: Spark can then split the occurrences of a very common passage over several tasks
    firsts = checkpointed(seen.filter("is_first").groupBy("h").agg(F.first("digest").alias("first_digest")))
    gone = seen.filter(~F.col("is_first")).join(F.broadcast(firsts) if few else firsts, "h").filter(F.col("digest") == F.col("first_digest"))
    k = F.col("place.k")
    shares = F.col("first.doc_id").eqNullSafe(F.col("place.doc_id")) & (F.col("first.name") == F.col("place.name")) & (F.col("first.k") == k - 1)
    gone = gone.groupBy(F.col("place.doc_id").alias("g_id"), F.col("place.name").alias("g_name")).agg(F.collect_set(F.when(~shares, k)).alias("upper"), F.collect_set(k + 1).alias("lower"))
    gone = gone.select("g_id", "g_name", F.array_union("upper", "lower").alias("gone"))
    out = own.join(gone, F.col("doc_id").eqNullSafe(F.col("g_id")) & (F.col("name") == F.col("g_name")), "left")
    out = _with_lines(out).withColumn("cuts", _cuts("lines", "hashes", divisor))
    # arrays of numbers, so that time is linear in the lines of a text
    out = out.withColumn("kept_at", F.array_except(F.sequence(F.lit(0), F.size("lines") - 1), F.coalesce("gone", F.array().cast("array<int>"))))
    length = lambda end, j: end - F.when(j > 0, F.get(F.col("cuts"), F.greatest(j - 1, F.lit(0)))).otherwise(F.lit(0))
    out = out.withColumn("chunk_of", F.flatten(F.transform("cuts", lambda end, j: F.array_repeat(j, length(end, j)))))
    left = F.size(F.array_distinct(F.transform("kept_at", lambda i: F.get(F.col("chunk_of"), i))))
    return out.select(
        "doc_id",
        F.size("lines").cast("long").alias("n_lines"),
        F.size("cuts").cast("long").alias("n_chunks"),
        (F.size("cuts") - left).cast("long").alias("n_removed_chunks"),
        (F.size("lines") - F.size("kept_at")).cast("long").alias("n_removed_lines"),
        F.when(F.col("gone").isNotNull(), F.array_join(F.transform("kept_at", lambda i: F.get(F.col("lines"), i)), "\n")).otherwise(F.col("text")).alias("kept"),
    )

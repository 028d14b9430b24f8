"""Prompts as rows, checked and merged into a keyed table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ..functions.text import int_or
from ..rules import MANDATORY
from ..sources import keyed

KEY = "prompt_unique_id"


def flatten(posts: DataFrame, social_media: str = "instagram") -> DataFrame:
    """A row for each prompt of each post."""
    p = posts.select("post_id", "carrousel_title", F.posexplode("prompts").alias("prompt_pos", "p"))
    return p.select(
        F.concat("post_id", F.lit("__p"), F.col("p.prompt_carrousel_page_num")).alias(KEY),
        F.col("p.prompt_text_raw").alias("prompt_text_original"), "p.prompt_text_clean", "p.prompt_type", "p.target_engine", "p.output_modality", "p.prompt_title", "p.prompt_date",
        F.lit(social_media).alias("prompt_social_media"), F.col("post_id").alias("prompt_carrousel_id"), "p.prompt_carrousel_page_num", F.col("carrousel_title").alias("carousel_title"),
        "p.comments", "p.extraction_confidence", F.length("p.prompt_text_clean").alias("prompt_size_chars"), F.lit("active").alias("record_status"), F.lit("all_models").alias("model"), "prompt_pos",
    )


def violations(rows: DataFrame) -> DataFrame:
    """``rows`` with the mandatory fields each lacks; an empty list is there, an empty text isn't (V8)."""
    kinds = dict(rows.dtypes)
    lacks = lambda c: F.col(c).isNull() | (F.col(c) == "" if kinds[c] == "string" else F.lit(False))
    size = [F.when(F.col("prompt_size_chars").isNotNull() & int_or(F.col("prompt_size_chars"), -1).isNull(), "prompt_size_chars")]
    return rows.withColumn("violations", F.array_compact(F.array(*[F.when(lacks(c), F.lit(c)) for c in MANDATORY], *size)))


def checked(rows: DataFrame) -> DataFrame:
    """Rows ready to load; one bad row refuses the whole batch before anything is written (V8)."""
    judged = violations(rows)
    bad = judged.agg(F.count_if(F.size("violations") > 0).alias("n")).first()["n"]
    if bad:
        raise ValueError(f"{bad} rows lack mandatory fields")
    return rows.withColumn("prompt_size_chars", F.col("prompt_size_chars").cast("int")).withColumn("model", F.coalesce(F.nullif("model", F.lit("")), F.lit("all_models")))


def merge(target: DataFrame, batch: DataFrame, order: list[str], now: str | None = None) -> DataFrame:
    """``target`` with the rows of ``batch`` by key, and what happened to each row (L1).

    Of equal keys in the batch the last one by ``order`` wins.  Fields of a matched
    row are replaced, created_at stays, updated_at moves; columns that the batch
    lacks keep their values.
    """
    fields = _fields(batch, order)
    new = batch.groupBy(KEY).agg(F.max_by(F.struct(*fields), F.struct(*order)).alias("n"))
    both = target.select(KEY, F.struct(*target.columns).alias("t")).join(new, KEY, "full_outer")
    return both.select(KEY, *_outcome(target, fields, now))


def _fields(batch: DataFrame, order: list[str]) -> list[str]:
    return [c for c in batch.columns if c not in (*order, "created_at", "updated_at", "action")]


def _outcome(target: DataFrame, fields: list[str], now: str | None = None) -> list[Column]:
    """All but the key of a merged row, from t, the row that was there, and n, the new one."""
    at = F.lit(now).cast("timestamp") if now else F.current_timestamp()
    given, was_there = F.col("n").isNotNull(), F.col("t.created_at").isNotNull()
    value = lambda c: F.when(given, F.col(f"n.{c}")).otherwise(F.col(f"t.{c}")).alias(c) if c in target.columns else F.col(f"n.{c}").alias(c)
    kept = [F.col(f"t.{c}") for c in target.columns if c not in (*fields, "created_at", "updated_at", "action")]
    return [
        *[value(c) for c in fields if c != KEY], *kept,
        F.when(given, at).otherwise(F.col("t.updated_at")).alias("updated_at"), F.coalesce("t.created_at", at).alias("created_at"),
        F.when(given & was_there, "updated").when(given, "inserted").otherwise("kept").alias("action"),
    ]


def load(target_path: str, batch: DataFrame, order: list[str], gate: bool = True, buckets: int = keyed.BUCKETS, stream: str | None = None, batch_id: int | None = None) -> DataFrame:
    """Merge into a table of hash buckets, of which only those of the batch's keys are rewritten (L1).  Returns the counts (L2).

    A batch with a row that lacks mandatory fields is refused before anything is
    written (V8).  Counts are taken while rows are written.  A batch of a stream that was
    committed before changes nothing (X3); one whose version another writer has committed
    meanwhile raises ``keyed.Conflict`` and may be loaded again.
    """
    spark = batch.sparkSession
    if gate:
        batch = checked(batch)
    seen = Observation()
    actions = [F.count_if(F.col("action") == a).alias(a) for a in ("inserted", "updated")]

    fields = _fields(batch, order)

    def merged(target: DataFrame, rows: DataFrame, deal: Callable[[DataFrame], DataFrame]) -> DataFrame:
        # as merge does it, with both dealt out at once; rows of the table without a key stay as they are
        alone = F.when(F.col(KEY).isNull(), F.monotonically_increasing_id()).alias("alone")
        old = target.select(KEY, alone, F.struct(*target.columns).alias("t"))
        both = deal(old.unionByName(rows.select(KEY, F.struct(*fields).alias("n"), F.struct(*order).alias("o")), allowMissingColumns=True))
        at_key = both.groupBy(*keyed.PLACE, KEY, "alone").agg(F.first("t", ignorenulls=True).alias("t"), F.max_by("n", "o").alias("n"))
        # observed before what happened to a row is left out
        return at_key.select(*keyed.PLACE, KEY, *_outcome(target, fields)).observe(seen, *actions).drop("action")

    def empty() -> StructType:
        return batch.drop(*order).withColumns({"updated_at": F.lit(None).cast("timestamp"), "created_at": F.lit(None).cast("timestamp")}).schema

    done = keyed.change(spark, target_path, batch, KEY, merged, empty, buckets, stream, batch_id, tuple(fields))
    found = [(a, n) for a, n in seen.get.items() if n] if done else []
    return spark.createDataFrame(found, "action string, n_rows long")


def report(rows: DataFrame, n_failures: int = 20) -> dict:
    """What a load of ``rows`` would meet: status ok or partial, counts, and the first failures by key (L2)."""
    judged = violations(rows)
    n, bad = judged.agg(F.count("*"), F.count_if(F.size("violations") > 0)).first()
    first = judged.filter(F.size("violations") > 0).orderBy(KEY).limit(n_failures).select(KEY, "violations").collect()
    return {"status": "partial" if bad else "ok", "n_rows": n, "n_failed": bad, "failures": [(r[KEY], list(r["violations"])) for r in first]}


def current(spark: SparkSession, path: str) -> DataFrame:
    """The newest version of a table that load writes."""
    return keyed.read(spark, path)


def counts(merged: DataFrame) -> DataFrame:
    """Inserted and updated rows (L2)."""
    return merged.filter("action <> 'kept'").groupBy("action").agg(F.count("*").alias("n_rows"))


def collisions(batch: DataFrame) -> DataFrame:
    """Ids that more than one row of a batch has."""
    return batch.groupBy(KEY).agg(F.count("*").alias("n_rows")).filter("n_rows > 1")

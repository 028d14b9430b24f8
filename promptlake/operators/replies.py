"""Model calls and their replies."""

from __future__ import annotations

import time
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import json_in_list, json_object_in, only_value, strip, unfenced, user_prompt
from ..rules import COMMENT_TAGS, CONFIDENCES, ENGINES, MODALITIES, PROMPT_TYPES
from ..schemas import PROMPT
from ..sources.processed import BucketedLog, bucketed

#: What of a hand-off record a model sees.
SHOWN = ("post_id", "prompt_social_media", "content_type", "slide_total", "slide_count_found", "slides", "ocr_text_combined_raw", "availability_status")
TOP_KEYS = ("post_id", "prompt_social_media", "content_type", "carrousel_title", "prompt_count_detected", "prompts")
_TEXTS, _LISTS = ("prompt_text_raw", "prompt_text_clean"), ("target_engine", "output_modality", "comments")


def with_prompts(handoff: DataFrame, template: str) -> DataFrame:
    """The user prompt of each record, with what a model is to see of it; fields that the records lack are null (V1)."""
    shown = [F.col(c) if c in handoff.columns else F.lit(None).cast("string").alias(c) for c in SHOWN]
    return handoff.withColumn("user_prompt", user_prompt(template, F.struct(*shown)))


def _asked(model: Callable[[str], str], retries: int, wait: float) -> Callable[[str], tuple[str | None, str | None, int]]:
    """A call with a bounded number of tries: the reply, or else the last error, and the tries.  An empty reply is an error."""

    def ask(prompt: str) -> tuple[str | None, str | None, int]:
        error = None
        for attempt in range(retries + 1):
            try:
                if reply := model(prompt):
                    return reply, None, attempt + 1
                error = "empty reply"
            except Exception as e:  # any failure of the given client belongs in the row
                error = str(e)
            if attempt < retries and wait:
                time.sleep(wait)
        return None, error, retries + 1

    return ask


def call_model(records: DataFrame, model: Callable[[str], str], tasks: int | None = None, retries: int = 2, wait: float = 0.0, keys: tuple[str, ...] = ("post_id", "content_type")) -> DataFrame:
    """``records`` with raw_reply or call_error and the tries it took; no failure stops the job (V9)."""
    ask = _asked(model, retries, wait)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            got = [ask(p) for p in b["user_prompt"]]
            yield b[list(keys)].assign(raw_reply=[g[0] for g in got], call_error=[g[1] for g in got], tries=[g[2] for g in got])

    spread = records.repartition(tasks) if tasks else records
    kinds = dict(records.dtypes)
    return spread.select(*keys, "user_prompt").mapInPandas(run, ", ".join(f"{k} {kinds[k]}" for k in keys) + ", raw_reply string, call_error string, tries int")


_STORED = "digest string, round int, raw_reply string, call_error string, tries int, valid boolean, asked_at timestamp"


def answered(
    records: DataFrame, model: Callable[[str], str], name: str, store: str, rounds: int = 3, retries: int = 2, wait: float = 0.0, waves: int = 1, tasks: int | None = None, retry_failed: bool = False, buckets: int = 64,
) -> DataFrame:
    """``records`` (post_id, content_type, user_prompt) with the last reply to their prompt, from a store of replies (V9).

    A prompt is asked until a reply is valid, in up to ``rounds`` rounds of up to ``retries``
    + 1 tries each.  Replies are stored under a digest of the model's name and the prompt,
    judged; what the store has settled isn't asked again, by this run or a later one, and
    equal prompts are asked once.  A round is written in ``waves``: a run that is killed
    loses the wave it was at, and goes on from there when it is started again.  With
    ``retry_failed`` prompts that used up their rounds in earlier runs get new ones.

    Whether anything is to be asked is seen from the digests.  What is to be asked is dealt
    out once, into buckets beside the store while the run lasts, from which all waves read;
    so one run at a time uses a store.
    """
    log = BucketedLog(records.sparkSession, store, "digest", _STORED, buckets)
    digest = F.sha2(F.concat(F.lit(name), F.lit("\0"), "user_prompt"), 256)
    own = records.select("post_id", "content_type", digest.alias("digest"))
    first = (log.rows().agg(F.max("round")).first()[0] or 0) if retry_failed else 0
    lacking = lambda rows, turn: rows.join(log.rows().filter(F.col("valid") | (F.col("round") >= turn)).select("digest").hint("shuffle_hash"), "digest", "left_anti")
    if not lacking(own.select("digest"), first + rounds).isEmpty():
        prompts = records.select(digest.alias("digest"), "user_prompt").dropDuplicates(["digest"])
        with bucketed(lacking(prompts, first + rounds), f"{store.rstrip('/')}/_prompts", "digest") as asked:
            for turn in range(first + 1, first + rounds + 1):
                need = lacking(asked, turn)
                for wave in range(waves):
                    part = need.filter(F.pmod(F.xxhash64("digest", F.lit(turn)), F.lit(waves)) == wave)
                    log.insert(_judged_calls(call_model(part, model, tasks, retries, wait, ("digest",)), turn))
    last = log.rows().groupBy("digest").agg(F.max_by(F.struct("raw_reply", "call_error", "valid"), "round").alias("r"), F.count("*").alias("n_rounds"), F.sum("tries").alias("n_tries"))
    return own.join(last, "digest", "left").select("post_id", "content_type", "r.raw_reply", "r.call_error", "r.valid", "n_rounds", "n_tries")


def _judged_calls(calls: DataFrame, turn: int) -> DataFrame:
    j = judged(calls.withColumnRenamed("digest", "post_id").withColumn("content_type", F.lit("")), keep=("call_error", "tries"))
    valid = F.col("call_error").isNull() & (F.size("errors") == 0)
    return j.select(F.col("post_id").alias("digest"), F.lit(turn).alias("round"), "raw_reply", "call_error", "tries", valid.alias("valid"), F.current_timestamp().alias("asked_at"))


def _kind(v: Column, path: str) -> Column:
    """The type a variant has at a path; null where the key is missing."""
    return F.schema_of_variant(F.try_variant_get(v, path, "variant"))


def _once(df: DataFrame, **columns: Column) -> DataFrame:
    """``df`` with columns that are computed once: the optimizer inlines no generator into what uses them."""
    return df.select("*", F.inline(F.array(F.struct(*[c.alias(k) for k, c in columns.items()]))))


_DEFAULTS = {"extraction_confidence": ("medium", "STRING"), "extraction_confidence_score": (50, "BIGINT")}
_KEYS = ("prompt_carrousel_page_num", "prompt_title", "prompt_date", *_TEXTS, "prompt_type", *_LISTS, *_DEFAULTS)
_NUMBERS = ("BIGINT", "DOUBLE", "FLOAT")


def _looked_at(p: Column) -> Column:
    """One look at an element of prompts: the type of each field, the two texts, and all fields as they should be."""
    return F.struct(
        F.coalesce(F.schema_of_variant(p).startswith("OBJECT"), F.lit(False)).alias("is_object"), F.struct(*[_kind(p, f"$.{k}").alias(k) for k in _KEYS]).alias("kind"),
        *[F.try_variant_get(p, f"$.{k}", "string").alias(k) for k in _TEXTS], F.try_variant_get(p, "$", PROMPT).alias("typed"),
    )


def _says(x: Column, k: str) -> Column:
    """Whether a text field says anything: zeros, false, and empty lists and objects don't, other values that are no texts do."""
    kind, text = x["kind"][k], x[k]
    number = kind.isin(*_NUMBERS) | kind.startswith("DECIMAL")
    return F.coalesce(
        F.when(kind == "STRING", strip(text) != "").when(kind == "BOOLEAN", text == "true").when(number, text.try_cast("double") != 0)
        .when(kind.startswith("ARRAY"), text.isNull() | (text != "[]")).when(kind.startswith("OBJECT"), kind != "OBJECT<>").otherwise(kind != "VOID"), F.lit(False),
    )


def _prompt_errors(x: Column) -> Column:
    """What is wrong with a prompt object (V5).  Truth values are whole numbers, as models write them."""
    kind, typed = (lambda k: x["kind"][k]), x["typed"]
    or_null = lambda k: kind(k).isin("STRING", "VOID")
    whole = lambda k: kind(k).isin("BIGINT", "BOOLEAN") & typed[k].isNotNull()
    texts = lambda k: kind(k).isin("ARRAY<STRING>", "ARRAY<VOID>") & ~F.exists(typed[k], lambda t: t.isNull())
    level, score = "extraction_confidence", "extraction_confidence_score"
    checks = [
        *[(or_null(k), f"{k} must be a string or null") for k in ("prompt_title", "prompt_date")],
        (whole("prompt_carrousel_page_num"), "prompt_carrousel_page_num must be a whole number"),
        *[((kind(k) == "STRING") & (strip(x[k]) != ""), f"{k} must be a string with text") for k in _TEXTS],
        (kind("prompt_type") == "STRING", "prompt_type must be a string"),
        *[(texts(k), f"{k} must be a list of strings") for k in _LISTS],
        (kind(level).isNull() | (kind(level) == "STRING") & typed[level].isin(list(CONFIDENCES)), "extraction_confidence must be high, medium or low"),
        (kind(score).isNull() | whole(score) & typed[score].between(0, 100), "extraction_confidence_score must be a whole number from 0 to 100"),
    ]
    return F.array_compact(F.array(*[F.when(~F.coalesce(ok, F.lit(False)), F.lit(said)) for ok, said in checks]))


def _filled(x: Column) -> Column:
    """The fields of a prompt, with the defaults of those that are missing."""
    typed = x["typed"]
    return F.struct(*[(F.coalesce(typed[k], F.lit(_DEFAULTS[k][0])) if k in _DEFAULTS else typed[k]).alias(k) for k in _KEYS])


def judged(replies: DataFrame, social_media: str = "instagram", keep: tuple[str, ...] = ()) -> DataFrame:
    """Replies (post_id, content_type, raw_reply) with their errors (none: valid) and what a valid one says.

    One parse and one look at each prompt, for callers that want both kinds.  Prompts that
    are no objects or say nothing in one of their texts are left out; any other bad prompt
    fails its post.  Identity comes from the row, not from the reply.
    """
    v = F.col("_v")
    r = _once(replies.select("post_id", "content_type", "raw_reply", *keep), _text=strip(F.coalesce("raw_reply", F.lit(""))))
    r = _once(r, _json=unfenced(F.col("_text"), stripped=True))
    r = _once(r, _list=json_in_list(json_object_in(F.col("_json"))))
    r = _once(r, _v=only_value(F.col("_list")))
    r = _once(
        r,
        _is=F.coalesce(F.schema_of_variant(v).startswith("OBJECT"), F.lit(False)),
        _kinds=F.struct(*[_kind(v, f"$.{k}").alias(k) for k in TOP_KEYS]),
        _title=F.try_variant_get(v, "$.carrousel_title", "string"),
        _seen=F.transform(F.try_variant_get(v, "$.prompts", "array<variant>"), _looked_at),
    )
    r = _once(r, _said=F.filter("_seen", lambda x: x["is_object"] & _says(x, _TEXTS[0]) & _says(x, _TEXTS[1])))
    kind = lambda k: F.col(f"_kinds.{k}")
    wrong = lambda k, ok, said: F.when(F.col("_is") & kind(k).isNotNull() & ~ok, F.lit(said))
    top = [
        F.when(~F.col("_is"), F.lit("not a JSON object")),
        *[F.when(F.col("_is") & kind(k).isNull(), F.lit(f"missing key {k}")) for k in TOP_KEYS],
        wrong("carrousel_title", kind("carrousel_title").isin("STRING", "VOID"), "carrousel_title must be a string or null"),
        wrong("prompt_count_detected", kind("prompt_count_detected").isin("BIGINT", "BOOLEAN"), "prompt_count_detected must be a whole number"),
        wrong("prompts", kind("prompts").startswith("ARRAY"), "prompts must be a list"),
    ]
    r = _once(r, errors=F.concat(F.array_compact(F.array(*top)), F.coalesce(F.flatten(F.transform("_said", _prompt_errors)), F.array().cast("array<string>"))))
    return r.select(
        "post_id", F.lit(social_media).alias("prompt_social_media"), "content_type", F.col("_title").alias("carrousel_title"),
        F.size("_said").alias("prompt_count_detected"), F.transform("_said", _filled).alias("prompts"), "errors", "raw_reply", *keep,
    )


def validate(replies: DataFrame, social_media: str = "instagram") -> tuple[DataFrame, DataFrame]:
    """Valid posts, and failed ones with their errors.  Whoever uses both writes ``judged`` first, so that replies are parsed once."""
    r = judged(replies, social_media)
    failed = r.filter(F.size("errors") > 0).select("post_id", "content_type", "errors", F.substring("raw_reply", 1, 4000).alias("raw_reply"))
    return r.filter(F.size("errors") == 0).drop("errors", "raw_reply"), failed


def strict_errors(posts: DataFrame) -> DataFrame:
    """``posts`` with what breaks the rules that models are only told of (V7): lists of values, pages from 1."""
    outside = lambda a, allowed: F.size(F.array_except(a, F.array(*[F.lit(x) for x in allowed]))) > 0
    bad = lambda p: F.array_compact(F.array(
        F.when(~p["prompt_type"].isin(list(PROMPT_TYPES)), "prompt_type"), F.when(outside(p["output_modality"], MODALITIES), "output_modality"),
        F.when(outside(p["target_engine"], ENGINES), "target_engine"), F.when(outside(p["comments"], COMMENT_TAGS), "comments"), F.when(p["prompt_carrousel_page_num"] < 1, "prompt_carrousel_page_num"),
    ))
    return posts.withColumn("strict_errors", F.array_distinct(F.flatten(F.transform("prompts", bad))))


def stamped(posts: DataFrame, model: str) -> DataFrame:
    """Who made a reply, and when."""
    return posts.withColumn("semantic_producer", F.lit(f"semantic_extraction_agent::{model}")).withColumn("semantic_extracted_at", F.current_timestamp())

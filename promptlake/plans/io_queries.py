"""Registered queries of readers, writers, mail, callables and runs, each over whole given tables, beside SQL.

What is written goes to a new folder under the shared one and is read back.
"""

from __future__ import annotations

import hashlib

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..functions.urls import normalize
from ..operators import classify as cl
from ..operators import dedup, library, replies, slides
from ..operators.handoff import hand_off, prepare
from ..schemas import CLASSIFIED
from ..sources import jsonl, keyed, media
from ..sources.lines import lines_of, splits_of
from ..sources.processed import ProcessedLog
from ..streaming.first_wins import keep_first, use_rocksdb
from ..streaming.incremental import load_stream, stream_of
from . import counters
from .pipeline import MODES, remaining, run_stages
from .queries import ORACLE_SQL as _OWN_SQL
from .queries import _BATCH, _FOUND_SQL, _FRESH, _LINK, _POSTS_SQL, _TEXT, _VARIANTS_SQL, _canonical_sql, PATTERNS, _classified_sql, _forms, _links, _queue_columns, _slides, _table, scratch

_TURN = "conv_id long, turn int, role string, text string"


def r1_jsonl_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Turns as JSON lines: users' written, all others appended, all read strictly."""
    c, folder = _table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text"), scratch(spark, "turns")
    jsonl.write(c.filter("role = 'user'"), folder)
    jsonl.write(c.filter("role IS DISTINCT FROM 'user'"), folder, append=True)
    return jsonl.read_strict(spark, folder, _TURN).select("conv_id", "turn", "role", F.md5("text").alias("text_md5"))


_BAD = "concat('{conv ', conv_id, ' turn ', turn)"


def r3_lenient_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A line for each turn: users' as objects, others' broken; an array besides, which both readers drop."""
    c = _table(spark, sf_dir, "conversations").selectExpr("conv_id", "turn", "role = 'user' AS good", f"CASE WHEN role = 'user' THEN to_json(struct(conv_id, turn, role, text)) ELSE {_BAD} END AS line", "concat('[', conv_id, ', ', turn, ']') AS other")
    mixed, sound = scratch(spark, "mixed"), scratch(spark, "sound")
    c.select(F.explode(F.array("line", "other"))).write.text(mixed)
    c.filter("good").select(F.explode(F.array("line", "other"))).write.text(sound)
    good, bad = jsonl.read_lenient(spark, mixed, _TURN)
    row = lambda kind: (F.lit(kind).alias("kind"), F.concat_ws(" ", "conv_id", "turn", "role", F.md5("text")).alias("line"))
    return good.select(*row("lenient")).unionByName(bad.select(F.lit("quarantine").alias("kind"), "line")).unionByName(jsonl.read_objects(spark, sound, _TURN).select(*row("objects")))


def r3_line_numbers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Turns in order as lines of several files, users' as objects, others' broken: where the quarantine says that each broken one is.

    Files are in order too, so the lines of those before and the number in its file say which of all lines it is.
    """
    c, folder = _table(spark, sf_dir, "conversations"), scratch(spark, "numbered")
    lines = c.selectExpr("conv_id", "turn", f"CASE WHEN role = 'user' THEN to_json(struct(conv_id, turn, role, text)) ELSE {_BAD} END AS line")
    lines.orderBy("conv_id", "turn").select("line").write.text(folder)
    _, bad = jsonl.read_lenient(spark, folder, _TURN)
    sizes = splits_of(lines_of(spark, folder)).groupBy("file").agg(F.sum("n_lines").alias("n"))
    before = sizes.select("file", F.coalesce(F.sum("n").over(Window.orderBy("file").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("before"))  # a row a file
    return bad.join(before, "file").select((F.col("before") + F.col("line_number")).alias("place"), "line")


def _queue(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page's link as a normalised queue row, and one without any URL for each page."""
    n = normalize(_links(spark, sf_dir), "link").withColumnRenamed("link", "original_url")
    blank = n.withColumns({"normalized_url": F.lit(" "), "normalization_notes": F.lit(None).cast("array<string>")})
    facts = {"source_message_id": F.col("page_id").cast("string"), "source_subject": F.lit("s"), "email_datetime": F.lit(""), "gmail_query": F.lit("q")}
    return n.unionByName(blank).withColumns(facts)


def w3_ready_rejected(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Classified rows in their ten columns, split to two files and read back."""
    folder, out = scratch(spark, "split"), cl.output_rows(cl.classify(_queue(spark, sf_dir)))
    jsonl.split_by(out, F.col("status") == "pending", f"{folder}/ready", f"{folder}/rejected")
    both = [jsonl.read_strict(spark, f"{folder}/{f}", CLASSIFIED).withColumn("file", F.lit(f)) for f in ("ready", "rejected")]
    return both[0].unionByName(both[1]).withColumn("normalization_notes", F.array_join("normalization_notes", ","))


def w6_filter_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counters of the filter."""
    return cl.filter_counts(cl.classify(_queue(spark, sf_dir)))


def w6_stage_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counters of all stages, each taken while the stage writes (W6, A9): links in four forms and blank ones, posts of all conversations, documents loaded twice."""
    top, stages = scratch(spark, "counted"), [counters.Stage(n) for n in ("normalise", "filter", "split", "group", "prep", "handoff", "load")]
    normalise, judge, split, group, prep, hand, load = stages
    forms = _forms(spark, sf_dir)
    facts = {"source_message_id": F.col("page_id").cast("string"), "source_subject": F.lit("s"), "email_datetime": F.lit(""), "gmail_query": F.lit("q")}
    queue = forms.unionByName(forms.filter("variant = 0").withColumns({"url": F.lit(" "), "variant": F.lit(9)})).withColumns(facts)
    step = lambda name, df, *by: df.write.partitionBy(*by).parquet(f"{top}/{name}") or spark.read.parquet(f"{top}/{name}")
    urls = step("normalised", counters.normalized(queue, normalise, ["page_id", "variant"]))
    links = normalize(_links(spark, sf_dir), "link").withColumnRenamed("link", "original_url").withColumns(facts)
    ready = step("filtered", counters.filtered(urls.select(*links.drop("page_id").columns).unionByName(links.drop("page_id")), judge), "status").filter("status = 'pending'")
    step("split", counters.split(ready, split, ("instagram", "tiktok", "x", "youtube")), "queue")
    posts = step("grouped", counters.grouped(_slides(spark, sf_dir), group, patterns=PATTERNS))
    step("handoff", counters.handed_off(step("prepared", counters.prepared(posts, prep)), hand))
    d = _table(spark, sf_dir, "documents").select(F.concat("doc_id", F.lit("__p1")).alias(library.KEY), F.length("text").alias("n"), F.lit(0).alias("seq"))
    library.load(f"{top}/table", d.filter(F.col("n") % 3 == 0), ["seq"], gate=False, buckets=8)
    counters.loaded(d, load, f"{top}/table", ["seq"])
    return counters.lines_of(spark, stages)


def w4_platform_queues(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A queue for each platform, read back."""
    folder = scratch(spark, "queues")
    listed = cl.classify(normalize(_links(spark, sf_dir), "link")).select("page_id", "platform", "normalized_url")
    jsonl.write_queues(listed, folder, ("instagram", "tiktok", "x", "youtube"))
    return jsonl.read_strict(spark, folder, "page_id long, normalized_url string, queue string").select("queue", "page_id", "normalized_url")


def _b64(c: str) -> str:
    return f"base64(encode({c}, 'UTF-8'))"


def _mail(parts: str) -> str:
    """A line of a box, with a first line and a blank one at its end: a message of the page with the given MIME parts."""
    return f"""concat('From page Mon Jan  2 03:04:05 2023\\nSubject: =?utf-8?b?', {_b64("concat('Página ', page_id)")}, '?=\\nFrom: a@b\\nDate: Mon, 02 Jan 2023 03:04:05 +0200\\nMIME-Version: 1.0\\nContent-Type: multipart/mixed; boundary=B\\n\\n',
    {parts}, '--B\\nContent-Type: text/plain\\nContent-Disposition: attachment\\n\\nnot read\\n--B--\\n')"""


def _part(kind: str, c: str) -> str:
    return f"""'--B\\nContent-Type: text/{kind}; charset=utf-8\\nContent-Transfer-Encoding: base64\\n\\n', {_b64(f"coalesce({c}, '')")}, '\\n'"""


def _boxes(spark: SparkSession, sf_dir: str, parts: str) -> DataFrame:
    """Every page as a message, in boxes written by page, read as stored mail."""
    folder = scratch(spark, "mail")
    _table(spark, sf_dir, "pages").orderBy("page_id").selectExpr(_mail(parts)).write.text(folder)
    return media.stored_mail(spark, folder)


def m1_mail_parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each page as a stored message with its address, its html and an attachment, and its place among all."""
    parts = media.mail_parts(_boxes(spark, sf_dir, f"{_part('plain', 'url')}, {_part('html', 'html')}"))
    place = F.dense_rank().over(Window.orderBy("message_ord")).alias("place")  # for the comparison: in one task
    return parts.select("message_ord", "subject", "from", "email_datetime", "part_ord", F.md5("text").alias("text_md5")).select(place, "subject", "from", "email_datetime", "part_ord", "text_md5")


def m9_mail_discovery(spark: SparkSession, sf_dir: str) -> DataFrame:
    """URLs found in stored mail, each with the first message in order of the boxes that has it."""
    queue = dedup.url_queue(dedup.message_urls(media.mail_parts(_boxes(spark, sf_dir, _part("plain", _TEXT)))))
    return queue.select("url", "source_subject", "email_datetime", "status")


def _reader(content: bytes) -> str:
    if len(content) % 5 == 0:
        raise ValueError("unreadable")
    return content.decode()


def s7_image_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A reader over every turn as an image; where it fails the row says so."""
    images = _table(spark, sf_dir, "conversations").selectExpr("concat('/shots/c', conv_id, '_slide_', lpad(turn + 1, 2, '0'), '_of_99.png') AS path", "encode(coalesce(text, ''), 'UTF-8') AS content")
    return media.extract_texts(images, _reader).select("source_image", "slide_index", "ocr_region", F.md5("ocr_text_raw").alias("text_md5"), "ocr_status", F.coalesce("error", F.lit("")).alias("error"))


_HEAD, _TAIL = "Read this:\n", "\nand answer."


def v1_user_prompts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The whole prompt of each post (V1)."""
    records = hand_off(prepare(slides.group_posts(_slides(spark, sf_dir), PATTERNS)))
    p = replies.with_prompts(records, _HEAD + "{{HANDOFF_ROW_JSON}}" + _TAIL)
    return p.select("post_id", F.length("user_prompt").alias("n_chars"), F.md5("user_prompt").alias("prompt_md5"))


def v7_strict_errors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents as prompts with their language, source and quality where lists of values are asked for (V7)."""
    d = _table(spark, sf_dir, "documents").join(_table(spark, sf_dir, "labels"), "doc_id", "left").withColumn("quality", F.coalesce("quality", F.lit(1)))
    prompt = F.struct(
        F.col("quality").cast("int").alias("prompt_carrousel_page_num"), F.when(F.col("lang") == "en", "Learning_Aid").otherwise("Sums").alias("prompt_type"), F.array(F.when(F.col("source").isNull(), "chat").otherwise(F.col("source"))).alias("output_modality"),
        F.array(F.when(F.length("text") > 500, "long").otherwise("claude")).alias("target_engine"), F.array(F.lit("CTA_REMOVED")).alias("comments"),
    )
    return replies.strict_errors(d.select("doc_id", F.array(prompt, prompt).alias("prompts"))).select("doc_id", F.array_join("strict_errors", ",").alias("strict_errors"))


def _model(prompt: str) -> str:
    if len(prompt) > 2000:
        raise ValueError("too long")
    return hashlib.md5(prompt.encode()).hexdigest()


def v9_model_calls(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A call for each document, with a failure as a row, and who answered."""
    d = _table(spark, sf_dir, "documents").select(F.col("doc_id").cast("string").alias("post_id"), F.lit("post").alias("content_type"), F.coalesce("text", F.lit("")).alias("user_prompt"))
    out = replies.stamped(replies.call_model(d, _model), "digest")
    return out.select("post_id", F.coalesce("raw_reply", F.lit("")).alias("raw_reply"), F.coalesce("call_error", F.lit("")).alias("call_error"), "semantic_producer", F.col("semantic_extracted_at").isNotNull().alias("timed"))


_VALID = '{"post_id": "", "prompt_social_media": "", "content_type": "", "carrousel_title": null, "prompt_count_detected": 0, "prompts": []}'


def _moody_model(prompt: str) -> str:
    """Fails at long prompts, and says nothing of use to every third of the others."""
    if len(prompt) > 2000:
        raise ValueError("too long")
    return _VALID if len(prompt) % 3 else "no JSON"


def v9_reply_store(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document asked about, in up to three rounds of three tries, and all again by a second run that asks nothing (V9)."""
    d = _table(spark, sf_dir, "documents").select(F.col("doc_id").cast("string").alias("post_id"), F.lit("post").alias("content_type"), F.concat(F.lit("Say: "), F.coalesce("text", F.lit(""))).alias("user_prompt"))
    store = scratch(spark, "replies")
    replies.answered(d, _moody_model, "moody", store, waves=2, buckets=8)
    again = replies.answered(d, _model, "moody", store, waves=2, buckets=8)  # would answer with digests, were it asked
    return again.select("post_id", "n_rounds", "n_tries", "valid", F.coalesce("raw_reply", F.lit("")).alias("raw_reply"), F.coalesce("call_error", F.lit("")).alias("call_error"))


def x1_modes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What a clean run and an incremental one have to do; the log is what was bought."""
    e = _table(spark, sf_dir, "events")
    log = e.filter("event_type = 'purchase'").select("user_id")
    clean, rest = (remaining(e.select("event_id", "user_id"), log, "user_id", m).select(F.lit(m).alias("mode"), "event_id", "user_id") for m in MODES)
    return clean.unionByName(rest)


def u11_queue_over_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The queue of all addresses' forms when later rows come first: three runs of a stream, by form, from the last."""
    folder, rows = scratch(spark, "runs"), _queue_columns(dedup.normalized_rows(_forms(spark, sf_dir)))
    setting = "spark.sql.streaming.stateStore.providerClass"
    old = spark.conf.get(setting)
    use_rocksdb(spark)
    try:
        for run in ("variant = 3", "variant = 2", "variant < 2"):
            rows.filter(run).write.mode("append").parquet(f"{folder}/in")
            keep_first(stream_of(spark, f"{folder}/in", rows.schema, "parquet"), f"{folder}/table", f"{folder}/checkpoint", "normalized_url", ["page_id", "variant"], buckets=8)
    finally:
        spark.conf.set(setting, old)
    return keyed.read(spark, f"{folder}/table")


def x3_reload(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents loaded by a stream, and all of them again by another."""
    folder, schema = scratch(spark, "reload"), _table(spark, sf_dir, "documents").schema
    for run in ("first", "second"):
        d = stream_of(spark, f"{sf_dir}/documents.parque[t]", schema, "parquet")
        rows = d.selectExpr("concat(doc_id, '__p1') AS prompt_unique_id", "coalesce(nullif(text, ''), '-') AS prompt_text_original", "coalesce(nullif(text, ''), '-') AS prompt_text_clean", "'Learning_Aid' AS prompt_type", "array('all_models') AS target_engine",
                            "array('chat') AS output_modality", "length(coalesce(text, '')) AS prompt_size_chars", f"'{run}' AS record_status", "'' AS model", "1 AS seq")
        load_stream(rows, f"{folder}/table", f"{folder}/{run}", ["seq"])
    t = library.current(spark, f"{folder}/table")
    return t.select("prompt_unique_id", F.md5("prompt_text_original").alias("text_md5"), "prompt_size_chars", "record_status", "model", (F.col("updated_at") > F.col("created_at")).alias("moved"))


def j1_two_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two runs over one log in buckets: the second has all events, and does those that the first lacked or failed at."""
    e = _table(spark, sf_dir, "events").select("event_id", "event_type")
    log, out = ProcessedLog(spark, scratch(spark, "log"), "event_id", "long", buckets=16), []
    status = F.when(F.col("event_id") % 50 == 0, "error").otherwise("ok").alias("status")
    for run, queue in enumerate((e.filter("event_id % 3 <> 0"), e)):
        folder = scratch(spark, "run")
        log.lacks(queue, retry_errors=True).withColumn("run", F.lit(run)).write.parquet(folder)
        done = spark.read.parquet(folder)
        log.append(done.select("event_id", status))
        out.append(done)
    return out[0].unionByName(out[1]).select("run", "event_id", "event_type")


def l1_two_loads(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two loads into one table of buckets: by the length of its text a document comes with the first, the second (twice), or both (L1)."""
    folder, d = scratch(spark, "keyed"), _table(spark, sf_dir, "documents")
    text = "coalesce(nullif(text, ''), '-')"
    rows = d.selectExpr("concat(doc_id, '__p1') AS prompt_unique_id", f"{text} AS prompt_text_original", f"{text} AS prompt_text_clean", "'Learning_Aid' AS prompt_type", "array('all_models') AS target_engine", "array('chat') AS output_modality",
                        "length(coalesce(text, '')) AS prompt_size_chars", "'' AS model", "text")
    library.load(folder, rows.filter(f"NOT ({_FRESH})").drop("text").withColumns({"record_status": F.lit("old"), "note": F.lit("kept"), "seq": F.lit(0)}), ["seq"], buckets=16)
    twice = rows.filter(_BATCH).drop("text").withColumn("seq", F.explode(F.array(F.lit(1), F.lit(2)))).withColumn("record_status", F.concat(F.lit("new"), "seq"))
    library.load(folder, twice, ["seq"])
    moved = (F.col("updated_at") > F.col("created_at")).alias("moved")
    return library.current(spark, folder).select("prompt_unique_id", F.md5("prompt_text_original").alias("text_md5"), "prompt_size_chars", "record_status", F.coalesce("note", F.lit("")).alias("note"), "model", moved)


def x4_run_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stages over all links up to one that fails."""
    judged = cl.classify(normalize(_links(spark, sf_dir), "link"))
    stages = [("links", lambda: _links(spark, sf_dir)), ("accepted", lambda: judged.filter("status = 'pending'")), ("refused", lambda: judged.select("no_such_column")), ("never", lambda: judged)]
    return run_stages(spark, stages).select("stage", "status", "n_rows", "failed_stage")


QUERIES = {f.__name__: f for f in (
    r1_jsonl_round_trip, r3_lenient_lines, r3_line_numbers, w3_ready_rejected, w4_platform_queues, w6_stage_counts, w6_filter_counts, m1_mail_parts, m9_mail_discovery, s7_image_texts, v1_user_prompts, v7_strict_errors, v9_model_calls, v9_reply_store, x1_modes, j1_two_runs, l1_two_loads, u11_queue_over_runs, x3_reload, x4_run_summary,
)}

#: Posts as further tables of a statement that has some.
_AND_POSTS = ", " + _POSTS_SQL.removeprefix("WITH ")
_STATUS = "CASE WHEN filter_reason LIKE 'accepted%' THEN 'pending' ELSE 'rejected' END"
_QUEUE_SQL = f"""{_classified_sql()}, queue AS (
    SELECT page_id, link, normalized_url, platform, filter_reason, notes FROM judged JOIN (SELECT page_id, link, notes FROM canon) USING (page_id)
    UNION ALL SELECT page_id, {_LINK}, ' ', 'unknown', 'rejected_missing_normalized_url', '' FROM pages)"""

ORACLE_SQL = {
    "r1_jsonl_round_trip": "SELECT conv_id, turn, role, md5(text) AS text_md5 FROM conversations",
    "r3_lenient_lines": f"""WITH good AS (SELECT concat_ws(' ', conv_id, turn, role, md5(text)) AS line FROM conversations WHERE role = 'user')
        SELECT 'lenient' AS kind, line FROM good UNION ALL SELECT 'objects', line FROM good UNION ALL SELECT 'quarantine', {_BAD} FROM conversations WHERE role IS DISTINCT FROM 'user'""",
    "r3_line_numbers": f"SELECT place, line FROM (SELECT row_number() OVER (ORDER BY conv_id, turn) AS place, role, {_BAD} AS line FROM conversations) WHERE role IS DISTINCT FROM 'user'",
    "w3_ready_rejected": f"""{_QUEUE_SQL} SELECT link AS original_url, normalized_url, platform, page_id::VARCHAR AS source_message_id, 's' AS source_subject, '' AS email_datetime, 'q' AS gmail_query, {_STATUS} AS status, filter_reason,
        notes AS normalization_notes, CASE WHEN {_STATUS} = 'pending' THEN 'ready' ELSE 'rejected' END AS file FROM queue""",
    "w4_platform_queues": f"{_classified_sql()} SELECT CASE WHEN platform IN ('instagram', 'tiktok', 'x', 'youtube') THEN platform ELSE 'unknown' END AS queue, page_id, normalized_url FROM judged",
    "w6_filter_counts": f"""{_QUEUE_SQL} SELECT count(*) AS input_rows, count(*) FILTER ({_STATUS} = 'pending') AS accepted_rows, count(*) FILTER ({_STATUS} <> 'pending') AS rejected_rows,
        count(*) FILTER (filter_reason = 'rejected_missing_normalized_url') AS missing_url_rows FROM queue""",
    "w6_stage_counts": f"""{_classified_sql()},
        n AS (SELECT (SELECT count(*) FROM pages) AS pages, (WITH {_VARIANTS_SQL}, {_canonical_sql("forms", "page_id, variant")} SELECT count(DISTINCT normalized_url) FROM canon) AS urls, count(*) FILTER (filter_reason LIKE 'accepted%') AS ready FROM judged),
        p AS (SELECT platform, count(*) AS k FROM judged WHERE filter_reason LIKE 'accepted%' GROUP BY platform)"""
        + _AND_POSTS + """
        SELECT 'normalise' AS stage, unnest(['input_rows', 'blank_rows', 'normalized_unique_rows']) AS counter, unnest([5 * pages, pages, urls]) AS n FROM n
        UNION ALL SELECT 'filter', unnest(['input_rows', 'scrape_ready_rows', 'rejected_rows', 'missing_url_rows']), unnest([urls + pages, ready, urls + pages - ready, 0]) FROM n
        UNION ALL SELECT 'split', 'input_rows', ready FROM n
        UNION ALL SELECT 'split', 'platform_' || q, coalesce((SELECT sum(k) FROM p WHERE CASE WHEN platform IN ('instagram', 'tiktok', 'x', 'youtube') THEN platform ELSE 'unknown' END = q), 0)::BIGINT FROM (SELECT unnest(['instagram', 'tiktok', 'x', 'youtube', 'unknown']) AS q)
        UNION ALL SELECT 'group', unnest(['input_rows', 'skipped_non_data_rows', 'skipped_missing_post_id_rows', 'grouped_posts']), unnest([(SELECT count(*) FROM conversations), (SELECT count(*) FROM conversations WHERE (conv_id + turn) % 97 = 0), 0, count(*)]) FROM shown
        UNION ALL SELECT 'prep', unnest(['input_rows', 'skipped_missing_post_id_rows', 'skipped_unavailable_rows', 'prepared_rows']), unnest([count(*), 0, count(*) FILTER (availability_status <> 'available'), count(*) FILTER (availability_status = 'available')]) FROM shown
        UNION ALL SELECT 'handoff', unnest(['input_rows', 'posts_skipped_missing_post_id', 'posts_skipped_unavailable', 'posts_skipped_invalid_slides', 'written_rows']), unnest([count(*), 0, 0, 0, count(*)]) FROM shown WHERE availability_status = 'available'
        UNION ALL SELECT 'load', unnest(['input_rows', 'inserted', 'updated']), unnest([count(*), count(*) FILTER (length(text) % 3 IS DISTINCT FROM 0), count(*) FILTER (length(text) % 3 = 0)]) FROM documents""",
    "m1_mail_parts": """SELECT place, 'Página ' || page_id AS subject, 'a@b' AS "from", '2023-01-02T01:04:05+00:00' AS email_datetime, part_ord, md5(text) AS text_md5
        FROM (SELECT row_number() OVER (ORDER BY page_id)::INTEGER AS place, page_id, unnest([coalesce(url, ''), coalesce(html, '')]) AS text, unnest([0, 1]) AS part_ord FROM pages)""",
    "m9_mail_discovery": f"{_FOUND_SQL} SELECT url, 'Página ' || min(page_id) AS source_subject, '2023-01-02T01:04:05+00:00' AS email_datetime, 'pending' AS status FROM social GROUP BY url",
    "s7_image_texts": """SELECT '/shots/c' || conv_id || '_slide_' || lpad((turn + 1)::VARCHAR, 2, '0') || '_of_99.png' AS source_image, (turn + 1)::INTEGER AS slide_index, 'top_55_percent' AS ocr_region,
        md5(CASE WHEN bad THEN '' ELSE coalesce(text, '') END) AS text_md5, CASE WHEN bad THEN 'error' ELSE 'ok' END AS ocr_status, CASE WHEN bad THEN 'unreadable' ELSE '' END AS error FROM (SELECT *, strlen(coalesce(text, '')) % 5 = 0 AS bad FROM conversations)""",
    "v1_user_prompts": f"""{_POSTS_SQL}, listed AS (SELECT post_id, list({{'slide_index': (turn + 1)::INTEGER, 'slide_filename': 'slide_' || printf('%02d', turn + 1) || '.png', 'source_image': '/' || conv_id || '/' || turn || '.png', 'ocr_text_raw': t}} ORDER BY turn) AS slides
            FROM rows WHERE (conv_id + turn) % 97 <> 0 GROUP BY post_id),
        prompts AS (SELECT post_id, '{_HEAD}' || to_json({{'post_id': post_id, 'prompt_social_media': 'instagram', 'content_type': content_type, 'slide_total': slide_total, 'slide_count_found': slide_count_found, 'slides': slides,
            'ocr_text_combined_raw': combined, 'availability_status': availability_status}})::VARCHAR || '{_TAIL}' AS p FROM shown JOIN listed USING (post_id) WHERE availability_status = 'available')
        SELECT post_id, length(p)::INTEGER AS n_chars, md5(p) AS prompt_md5 FROM prompts""",
    "v7_strict_errors": """SELECT doc_id, concat_ws(',', CASE WHEN lang = 'en' THEN NULL ELSE 'prompt_type' END, CASE WHEN source NOT IN ('chat', 'text', 'image', 'video', 'sound', 'music', 'presentation', 'code', 'spreadsheet', 'formula', 'chart', 'report', 'app_code') THEN 'output_modality' END,
        CASE WHEN length(text) > 500 THEN 'target_engine' END, CASE WHEN quality < 1 THEN 'prompt_carrousel_page_num' END) AS strict_errors FROM documents LEFT JOIN labels USING (doc_id)""",
    "v9_model_calls": """SELECT doc_id::VARCHAR AS post_id, CASE WHEN length(coalesce(text, '')) > 2000 THEN '' ELSE md5(coalesce(text, '')) END AS raw_reply, CASE WHEN length(coalesce(text, '')) > 2000 THEN 'too long' ELSE '' END AS call_error,
        'semantic_extraction_agent::digest' AS semantic_producer, true AS timed FROM documents""",
    "v9_reply_store": f"""SELECT post_id, CASE WHEN n > 2000 OR n % 3 = 0 THEN 3 ELSE 1 END::BIGINT AS n_rounds, CASE WHEN n > 2000 THEN 9 WHEN n % 3 = 0 THEN 3 ELSE 1 END::BIGINT AS n_tries, n <= 2000 AND n % 3 <> 0 AS valid,
        CASE WHEN n > 2000 THEN '' WHEN n % 3 = 0 THEN 'no JSON' ELSE '{_VALID}' END AS raw_reply, CASE WHEN n > 2000 THEN 'too long' ELSE '' END AS call_error FROM (SELECT doc_id::VARCHAR AS post_id, 5 + length(coalesce(text, '')) AS n FROM documents)""",
    "x1_modes": "SELECT 'CLEAN' AS mode, event_id, user_id FROM events UNION ALL SELECT 'INCREMENTAL', event_id, user_id FROM events WHERE user_id NOT IN (SELECT user_id FROM events WHERE event_type = 'purchase')",
    "j1_two_runs": "SELECT 0 AS run, event_id, event_type FROM events WHERE event_id % 3 <> 0 UNION ALL SELECT 1, event_id, event_type FROM events WHERE event_id % 3 = 0 OR event_id % 50 = 0",
    "l1_two_loads": f"""SELECT doc_id || '__p1' AS prompt_unique_id, md5(coalesce(nullif(text, ''), '-')) AS text_md5, length(coalesce(text, ''))::INTEGER AS prompt_size_chars, CASE WHEN {_BATCH} THEN 'new2' ELSE 'old' END AS record_status,
        CASE WHEN {_FRESH} THEN '' ELSE 'kept' END AS note, 'all_models' AS model, {_BATCH} AND NOT ({_FRESH}) AS moved FROM documents""",
    "u11_queue_over_runs": _OWN_SQL["u11_normalized_queue"],
    "x3_reload": "SELECT doc_id || '__p1' AS prompt_unique_id, md5(coalesce(nullif(text, ''), '-')) AS text_md5, length(coalesce(text, ''))::INTEGER AS prompt_size_chars, 'second' AS record_status, 'all_models' AS model, true AS moved FROM documents",
    "x4_run_summary": f"""{_classified_sql()} SELECT 'links' AS stage, 'ok' AS status, count(*) AS n_rows, 'refused' AS failed_stage FROM judged
        UNION ALL SELECT 'accepted', 'ok', count(*), 'refused' FROM judged WHERE filter_reason LIKE 'accepted%' UNION ALL SELECT 'refused', 'failed', NULL, 'refused'""",
}

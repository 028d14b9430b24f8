"""The registered queries: each operator over whole given tables, beside SQL that says the same.

``pages`` are the links of a mailbox, ``conversations`` the slides of posts (a turn is
a slide, its role the content type), ``documents`` and ``labels`` the replies of a model.
"""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..functions.text import content_type_of, image_facts, post_id_of, slide_name
from ..functions.urls import normalize
from ..operators import classify as cl
from ..operators import dedup, handoff, library, replies, slides
from ..rules import PLATFORM_HOSTS
from ..sources.jsonl import processed_keys, queue_of
from ..streaming.incremental import run_once, stream_of, unseen

PATTERNS = ("log in", "aux des", "the be")
_P = "page_id"


def scratch(spark: SparkSession, what: str) -> str:
    """A new folder name under the one that driver and executors share; in local mode without one, a temporary folder."""
    top = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if not top and not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
    top = top or tempfile.mkdtemp(prefix="spark-scratch-", dir="/tmp")
    return f"{top.rstrip('/')}/promptlake/{what}-{uuid.uuid4().hex}"


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


#: A page's whole address as one segment of a path.
_SLUG = "translate(url, ':/?#[]@!$&()*+,;=%. ', '--------------------')"
#: Links of every platform around the page's address, by page id; the last kind is the address itself.
_LINKS = [
    f"concat('http://www.instagram.com//p//', {_SLUG}, '?igsh=a&utm_source=b#x')",
    f"concat('https://www.tiktok.com/@u', page_id, '/video/', {_SLUG}, '/?lang=en')",
    f"concat('http://X.com:80/', {_SLUG}, '/status/', page_id, '/?s=20')",
    f"concat('https://www.facebook.com/watch/?v=', {_SLUG})",
    f"concat('https://m.youtube.com/watch?v=', {_SLUG}, '&t=30s&list=L', page_id)",
    f"concat('https://www.linkedin.com/company/', {_SLUG}, '?trk=z')",
    f"concat('https://www.pinterest.com/pin/', {_SLUG}, '/')",
    f"concat('https://youtu.be/', {_SLUG}, '?si=1')",
    f"concat('https://x.com/', {_SLUG}, '.png')",
    f"concat('https://www.linkedin.com/feed/update/', {_SLUG}, '?lipi=1')",
    f"concat('https://www.youtube.com/shorts/', {_SLUG}, '?feature=share')",
    f"concat('https://www.facebook.com/some.one/posts/', {_SLUG})",
    f"concat('https://www.instagram.com/', {_SLUG}, '/')",
    "url",
]
_LINK = "CASE page_id % 14 " + " ".join(f"WHEN {i} THEN {x}" for i, x in enumerate(_LINKS[:-1])) + f" ELSE {_LINKS[-1]} END"


def _links(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _table(spark, sf_dir, "pages").selectExpr("page_id", f"{_LINK} AS link")


def u10_canonical_urls(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = normalize(_links(spark, sf_dir), "link")
    return out.select(_P, "normalized_url", F.array_join("normalization_notes", ",").alias("notes"))


_REGEX = r"^(?:([A-Za-z][A-Za-z0-9+.\-]*):)?(?://([^/?#]*))?([^?#]*)(?:\?([^#]*))?(?:#(.*))?"
_SOCIAL = ", ".join(f"'{h}'" for hosts in PLATFORM_HOSTS.values() for h in hosts)


def _canonical_sql(source: str, keys: str) -> str:
    """Canonical form of the column link of ``source``, for links without escapes."""
    dropped = "'utm_source', 'igsh', 'si', 'feature', 'trk', 'lipi', 's', 't'"
    return f"""
    parts AS (SELECT {keys}, link, coalesce(nullif(lower(regexp_extract(link, '{_REGEX}', 1)), ''), 'https') AS scheme, lower(regexp_extract(link, '{_REGEX}', 2)) AS raw_host,
                     regexp_extract(link, '{_REGEX}', 3) AS raw_path, regexp_extract(link, '{_REGEX}', 4) AS q, regexp_extract(link, '{_REGEX}', 5) AS frag FROM {source}),
    hosts AS (SELECT *, (scheme = 'https' AND raw_host LIKE '%:443') OR (scheme = 'http' AND raw_host LIKE '%:80') AS port,
                     regexp_replace(regexp_replace(raw_path, ';[^/]*$', ''), '/+', '/', 'g') AS p1 FROM parts),
    named AS (SELECT *, CASE WHEN port THEN regexp_replace(raw_host, ':[0-9]+$', '') ELSE raw_host END AS host FROM hosts),
    split AS (SELECT *, CASE WHEN p1 IN ('', '/') THEN '/' WHEN host IN ('instagram.com', 'www.instagram.com', 'm.instagram.com') THEN rtrim(p1, '/') || '/' ELSE rtrim(p1, '/') END AS path,
                     list_filter(string_split(q, '&'), lambda x: x <> '') AS pairs, host IN ('youtube.com', 'www.youtube.com', 'm.youtube.com') AS keeps,
                     host IN ({_SOCIAL}) AND scheme <> 'https' AS secure FROM named),
    kept AS (SELECT *, list_filter(pairs, lambda x: keeps AND split_part(x, '=', 1) IN ('v', 'list') AND lower(split_part(x, '=', 1)) NOT IN ({dropped})) AS good FROM split),
    canon AS (SELECT {keys}, link,
        (CASE WHEN secure THEN 'https' ELSE scheme END) || '://' || host || path || CASE WHEN len(good) > 0 THEN '?' || array_to_string(good, '&') ELSE '' END AS normalized_url,
        array_to_string(list_concat(CASE WHEN port THEN ['drop_default_port'] ELSE [] END,
            list_transform(list_filter(pairs, lambda x: NOT list_contains(good, x)), lambda x: 'drop_param:' || split_part(x, '=', 1)),
            CASE WHEN len(good) > 0 AND array_to_string(good, '&') <> q THEN ['query_normalized'] ELSE [] END,
            CASE WHEN frag <> '' THEN ['drop_fragment'] ELSE [] END, CASE WHEN secure THEN ['force_https'] ELSE [] END), ',') AS notes FROM kept)"""


_LINKS_SQL = f"links AS (SELECT page_id, {_LINK} AS link FROM pages)"
_CANON_SQL = f"WITH {_LINKS_SQL}, {_canonical_sql('links', 'page_id')}"


#: Social links over the pages' own paths, and forms in which mail carries them: entities, a wrapper, two wrappers (a value is decoded twice), blanks around.
_BASE = f"CASE WHEN page_id % 2 = 0 THEN concat('https://www.youtube.com/watch?v=', {_SLUG}, '&list=L', page_id, '&si=q') ELSE concat('http://x.com', regexp_extract(url, '^[a-z]+://[^/?#]*([^?#]*)', 1), '/status/', page_id, '?s=20') END"
_FORMS = ["replace(link, '&', '&amp;')", "concat('https://www.google.com/url?sa=t&url=', url_encode(link))", "concat('https://mail.example/x?link=', url_encode(concat('https://www.facebook.com/l.php?u=', url_encode(url_encode(link)))))", "concat('  ', link, ' ')"]


def u2_wrapped_urls(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page's link in each form, brought back to its canonical form."""
    base = _table(spark, sf_dir, "pages").selectExpr("page_id", f"{_BASE} AS link")
    forms = base.selectExpr("page_id", f"stack(4, {', '.join(f'{i}, {x}' for i, x in enumerate(_FORMS))}) AS (variant, url)")
    return normalize(forms).select(_P, "variant", "normalized_url", F.array_join("normalization_notes", ",").alias("notes"))


#: Queries with escapes, plus signs, blank and repeated values, names that differ in case, and names that say nothing.
_QUERIES = ["concat('v=a+b&list=', url_encode(url), '&v=&feature=x&list=c%20d%2b&V=1&utm_source=%C3%A9')", "concat('list=', url_encode(concat(url, ' é')), '&&list=+&v')", "'=x&v=%zz&v=~*'", "concat('a=', url_encode(url), '&b=1&a=2')"]


def u7_query_strings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page's address in parameters of a host that keeps some and one that keeps none."""
    pages = _table(spark, sf_dir, "pages").selectExpr("page_id", f"stack({len(_QUERIES)}, {', '.join(f'{i}, {x}' for i, x in enumerate(_QUERIES))}) AS (form, q)")
    queue = pages.selectExpr("page_id", "form", "concat('https://www.youtube.com/watch?', q) AS kept", "concat('https://x.com/u?', q) AS none")
    out = normalize(queue, "kept").select(_P, "form", F.col("normalized_url").alias("kept"), F.array_join("normalization_notes", ",").alias("notes"))
    none = normalize(queue, "none").select(_P, "form", F.col("normalized_url").alias("none"))
    return out.join(none, [_P, "form"])


def f11_classified_urls(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cl.classify(normalize(_links(spark, sf_dir), "link")).select(_P, "normalized_url", "platform", "status", "filter_reason")


def _classified_sql() -> str:
    platform = "CASE " + " ".join(f"WHEN host IN ({', '.join(repr(h) for h in hosts)}) THEN '{p}'" for p, hosts in PLATFORM_HOSTS.items()) + " ELSE 'unknown' END"
    return f"""{_CANON_SQL},
    seen AS (SELECT *, regexp_extract(normalized_url, '{_REGEX}', 2) AS host, regexp_extract(normalized_url, '{_REGEX}', 3) AS path, regexp_extract(normalized_url, '{_REGEX}', 4) AS q FROM canon),
    segs AS (SELECT *, {platform} AS platform, list_filter(string_split(path, '/'), lambda x: x <> '') AS s FROM seen),
    judged AS (SELECT page_id, normalized_url, platform, CASE
        WHEN platform = 'unknown' THEN 'rejected_unknown_platform'
        WHEN regexp_matches(lower(path), '[.](gif|jpg|jpeg|png|webp|svg|ico|css|js|woff|woff2|ttf|map|xml)$') THEN 'rejected_asset_url'
        WHEN platform = 'instagram' THEN CASE WHEN len(s) >= 2 AND s[1] IN ('p', 'reel', 'reels') THEN 'accepted_instagram_content' ELSE 'rejected_instagram_non_content' END
        WHEN platform = 'tiktok' THEN CASE WHEN len(s) >= 3 AND s[1] LIKE '@%' AND s[2] = 'video' THEN 'accepted_tiktok_video' ELSE 'rejected_tiktok_non_video' END
        WHEN platform = 'x' THEN CASE WHEN len(s) >= 3 AND s[2] = 'status' THEN 'accepted_x_status' ELSE 'rejected_x_non_status' END
        WHEN platform = 'facebook' THEN CASE WHEN host = 'fb.watch' THEN 'accepted_facebook_watch' WHEN list_contains(s, 'reel') OR list_contains(s, 'watch') THEN 'accepted_facebook_reel_or_watch'
            WHEN list_contains(s, 'posts') THEN 'accepted_facebook_post' WHEN len(s) >= 2 AND s[1] NOT IN ('help', 'privacy', 'settings', 'policies') THEN 'accepted_facebook_generic_content' ELSE 'rejected_facebook_non_content' END
        WHEN platform = 'linkedin' THEN CASE WHEN len(s) = 0 THEN 'rejected_linkedin_empty_path' WHEN s[1] IN ('comm', 'help', 'psettings', 'emimp', 'company', 'school', 'learning') THEN 'rejected_linkedin_tracking_or_non_content'
            WHEN s[1] = 'posts' THEN 'accepted_linkedin_post' WHEN s[1] = 'pulse' THEN 'accepted_linkedin_pulse' WHEN len(s) >= 2 AND s[1] = 'feed' AND s[2] = 'update' THEN 'accepted_linkedin_feed_update' ELSE 'rejected_linkedin_non_content' END
        WHEN platform = 'youtube' THEN CASE WHEN host = 'youtu.be' AND len(s) >= 1 THEN 'accepted_youtube_shortlink' WHEN len(s) >= 2 AND s[1] = 'shorts' THEN 'accepted_youtube_shorts'
            WHEN path = '/watch' AND regexp_matches(q, '(^|&)v=[^&]') THEN 'accepted_youtube_watch' ELSE 'rejected_youtube_non_content' END
        ELSE CASE WHEN len(s) >= 2 AND s[1] = 'pin' THEN 'accepted_pinterest_pin' ELSE 'rejected_pinterest_non_pin' END END AS filter_reason FROM segs)"""


def a10_platform_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = cl.classify(normalize(_links(spark, sf_dir), "link")).withColumn("platform", queue_of(F.col("platform"), ("instagram", "tiktok", "x", "youtube")))
    return cl.platform_counts(c)


def _forms(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page's address in four forms."""
    forms = ["url", "regexp_replace(url, '^https?', 'http')", "concat(regexp_replace(url, '#.*$', ''), CASE WHEN url LIKE '%?%' THEN '&' ELSE '?' END, 'utm_source=n')", "concat(regexp_replace(url, '[?#].*$', ''), '/')"]
    return _table(spark, sf_dir, "pages").selectExpr("page_id", f"stack(4, {', '.join(f'{i}, {x}' for i, x in enumerate(forms))}) AS (variant, url)")


def _queue_columns(rows: DataFrame) -> DataFrame:
    return rows.select("normalized_url", "original_url", "page_id", "variant", F.array_join("normalization_notes", ",").alias("notes"), "status")


def u11_normalized_queue(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Of the forms of all addresses that agree the first stays."""
    return _queue_columns(dedup.normalized_queue(_forms(spark, sf_dir), ["page_id", "variant"]))


def m9_url_discovery(spark: SparkSession, sf_dir: str) -> DataFrame:
    parts = _messages(spark, sf_dir)
    return dedup.url_queue(dedup.message_urls(parts)).select("url", "source_message_id", "status")


def m8_message_urls(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dedup.message_urls(_messages(spark, sf_dir)).select("message_id", "url_count", F.array_join("urls", " ").alias("urls"))


_TEXT = f"concat('see ', {_LINK}, '). and (http://foo.com/b), https://youtu.be/', page_id % 50, '\"; HTTPS://x.com/same/status/1')"


def _messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _table(spark, sf_dir, "pages").selectExpr("lpad(page_id, 12, '0') AS message_id", "page_id AS message_ord", "'' AS subject", "'' AS `from`", "'' AS email_datetime", "'' AS gmail_query", "0 AS part_ord", f"{_TEXT} AS text")


_FOUND_SQL = f"""WITH texts AS (SELECT lpad(page_id::VARCHAR, 12, '0') AS message_id, page_id, {_TEXT} AS text FROM pages),
    raw AS (SELECT message_id, page_id, unnest(regexp_extract_all(text, '(?i)https?://[^\\s<>()"'']+')) AS u FROM texts),
    cut AS (SELECT DISTINCT message_id, page_id, regexp_replace(u, '[.,);\\]>"'']+$', '') AS url FROM raw),
    social AS (SELECT * FROM cut WHERE lower(regexp_extract(url, '{_REGEX}', 2)) IN ({_SOCIAL}))"""


def j1_skip_processed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events of users who have bought nothing, as far as the log says; the log is the events of purchases."""
    e = _table(spark, sf_dir, "events")
    log = e.filter("event_type = 'purchase'").select("user_id", F.when(F.col("event_id") % 50 != 0, "error").otherwise("ok").alias("status"))
    return dedup.skip_done(e.select("event_id", "user_id", "event_type"), processed_keys(log, "user_id", retry_errors=True), "user_id")


def _slides(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = _table(spark, sf_dir, "conversations")
    return c.select(
        F.col("conv_id").cast("string").alias("post_id"), F.col("role").alias("content_type"), F.format_string("slide_%02d.png", F.col("turn") + 1).alias("slide_filename"), (F.col("turn") + 1).cast("int").alias("slide_index"),
        (F.max("turn").over(Window.partitionBy("conv_id")) + 1).cast("int").alias("slide_total"), F.concat(F.lit("/"), "conv_id", F.lit("/"), "turn", F.lit(".png")).alias("source_image"), F.col("text").alias("ocr_text_raw"),
        F.when((F.col("conv_id") * 7 + F.col("turn")) % 10 == 0, "error").otherwise("ok").alias("ocr_status"), F.when((F.col("conv_id") + F.col("turn")) % 97 == 0, "ocr_extractor_started").alias("event"),
    )


def a2_group_posts(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = slides.group_posts(_slides(spark, sf_dir), PATTERNS)
    return p.select("post_id", "content_type", "slide_total", "slide_count_found", F.array_join(F.transform("slides", lambda s: s["slide_index"].cast("string")), ",").alias("slide_order"),
                    F.array_join("source_images", ",").alias("source_images"), F.md5("ocr_text_combined_raw").alias("text_md5"), "availability_status", "all_ocr_status_ok")


_POSTS_SQL = r"""WITH rows AS (SELECT *, conv_id::VARCHAR AS post_id, (max(turn) OVER (PARTITION BY conv_id) + 1)::INTEGER AS total, (conv_id * 7 + turn) % 10 <> 0 AS ok,
        regexp_replace(text, '^\s+|\s+$', '', 'g') AS t FROM conversations),
    posts AS (SELECT post_id, CASE WHEN count(DISTINCT nullif(role, '')) = 0 THEN 'unknown' WHEN count(DISTINCT nullif(role, '')) = 1 THEN min(nullif(role, '')) ELSE 'mixed' END AS content_type,
        coalesce(max(total) FILTER (WHERE ok), count(*))::INTEGER AS slide_total, count(*)::INTEGER AS slide_count_found, string_agg((turn + 1)::VARCHAR, ',' ORDER BY turn) AS slide_order,
        string_agg('/' || conv_id || '/' || turn || '.png', ',' ORDER BY turn) AS source_images,
        coalesce(string_agg('[SLIDE ' || printf('%02d', turn + 1) || '/' || printf('%02d', total) || ']' || chr(10) || t, chr(10) || chr(10) ORDER BY turn) FILTER (WHERE t <> ''), '') AS combined,
        bool_and(ok) AS all_ocr_status_ok FROM rows WHERE (conv_id + turn) % 97 <> 0 GROUP BY post_id),
    shown AS (SELECT *, CASE WHEN regexp_matches(lower(combined), 'log in|aux des|the be') THEN 'unavailable' ELSE 'available' END AS availability_status FROM posts)"""


def s14_handoff(spark: SparkSession, sf_dir: str) -> DataFrame:
    h = handoff.hand_off(handoff.prepare(slides.group_posts(_slides(spark, sf_dir), PATTERNS)))
    return h.select("post_id", "content_type", "slide_total", "slide_count_found", F.size("slides").alias("n_slides"), F.md5("ocr_text_combined_raw").alias("text_md5"), "handoff_status", "producer", "source_post_prep_status")


def a9_outcome_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return handoff.outcome_counts(slides.group_posts(_slides(spark, sf_dir), PATTERNS))


def s5_distinct_slides(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Turns of a conversation up to the first whose role and text (spaces and case aside) repeat."""
    s = _table(spark, sf_dir, "conversations").select(F.col("conv_id").alias("post_id"), (F.col("turn") + 1).alias("slide_index"), F.concat("role", F.lower(F.trim("text"))).alias("content"))
    return slides.distinct_prefix(s).select("post_id", "slide_index", "signature")


def s6_slide_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = _table(spark, sf_dir, "conversations")
    total = F.count("*").over(Window.partitionBy("conv_id"))
    s = s.withColumn("path", F.concat(F.lit("/shots/"), F.when(F.col("turn") == 7, F.concat(F.lit("r"), "conv_id", F.lit(".png"))).otherwise(slide_name(F.concat(F.lit("c"), "conv_id"), F.col("turn") + 1, total))))
    return s.select("conv_id", "turn", *image_facts(F.col("path")))


def s1_post_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _links(spark, sf_dir).select(_P, post_id_of(F.col("link")).alias("post_id"), content_type_of(F.col("link")).alias("content_type"))


#: Replies are damaged by doc_id modulo this: see ``_replies``.
_REPLY_KINDS = 16
_RAW, _CLEAN = "@raw@", "@clean@"
#: What stands in a reply of a kind instead of what would, as JSON.
_INSTEAD = {8: ('"target_engine":["all_models"]', '"target_engine":[null]'), 9: ('"comments":["PROMPT_EXTRACTED"]', '"comments":["a",null]'), 10: (f'"{_RAW}"', "0"), 11: ('"prompt_carrousel_page_num":1', '"prompt_carrousel_page_num":true'),
            12: ('"prompt_count_detected":7', '"prompt_count_detected":false'), 13: (f'"{_RAW}"', "false"), 14: (f'"{_CLEAN}"', "5"), 15: ('"prompt_carrousel_page_num":1', '"prompt_carrousel_page_num":1.0')}


def _replies(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A reply for each document, damaged in one of several ways by its id."""
    d = _table(spark, sf_dir, "documents").join(_table(spark, sf_dir, "labels"), "doc_id", "left")
    kind, text = F.col("doc_id") % _REPLY_KINDS, F.coalesce("text", F.lit(""))
    prompt = F.struct(
        F.when(kind != 5, F.lit(1)).alias("prompt_carrousel_page_num"), F.when(kind == 5, "1").alias("page_text"), F.lit("t").alias("prompt_title"), F.lit("d").alias("prompt_date"),
        F.when(kind.isin(10, 13), _RAW).otherwise(text).alias("prompt_text_raw"), F.when(kind == 6, " ").when(kind == 14, _CLEAN).otherwise(text).alias("prompt_text_clean"), F.lit("Learning_Aid").alias("prompt_type"), F.array(F.lit("all_models")).alias("target_engine"), F.array(F.lit("chat")).alias("output_modality"),
        F.array(F.lit("PROMPT_EXTRACTED")).alias("comments"), F.when(kind != 7, F.when(F.col("quality") == 1, "high").otherwise("low")).alias("extraction_confidence"), F.when(kind != 7, F.lit(80)).alias("extraction_confidence_score"),
    )
    reply = F.to_json(F.struct(F.lit("other").alias("post_id"), F.lit("instagram").alias("prompt_social_media"), F.lit("post").alias("content_type"), F.when(kind != 4, "c").alias("carrousel_title"), F.lit(7).alias("prompt_count_detected"), F.array(prompt).alias("prompts")))
    reply = F.replace(reply, F.lit('"page_text"'), F.lit('"prompt_carrousel_page_num"'))
    part = lambda i: F.coalesce(*[F.when(kind == k, F.lit(x[i])) for k, x in _INSTEAD.items()], F.lit('"page_text"'))
    reply = F.replace(reply, part(0), part(1))
    fence = "`" * 3
    reply = F.when(kind == 1, F.concat(F.lit(f"{fence}json\n"), reply, F.lit(f"\n{fence}"))).when(kind == 2, F.concat(F.lit("Sure! "), reply, F.lit(" hope it helps"))).when(kind == 3, F.lit("no JSON {")).otherwise(reply)
    return d.select(F.col("doc_id").cast("string").alias("post_id"), F.lit("post").alias("content_type"), reply.alias("raw_reply"))


def v6_valid_replies(spark: SparkSession, sf_dir: str) -> DataFrame:
    valid = F.size("errors") == 0
    first = F.coalesce(F.get("prompts", F.lit(0))["extraction_confidence"], F.lit(""))
    return replies.judged(_replies(spark, sf_dir)).select(
        "post_id", F.when(valid, "valid").otherwise("failed").alias("verdict"), F.when(valid, F.col("prompt_count_detected")).otherwise(0).alias("n_prompts"), F.when(valid, first).otherwise("").alias("confidence")
    )


def e1_flat_prompts(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = library.flatten(replies.validate(_replies(spark, sf_dir))[0])
    return p.select("prompt_unique_id", F.md5("prompt_text_clean").alias("clean_md5"), "prompt_size_chars", "extraction_confidence", F.array_join("target_engine", ",").alias("target_engine"), "record_status", "model")


_FRESH, _BATCH = "length(coalesce(text, '')) % 3 = 0", "length(coalesce(text, '')) % 3 < 2"


def _merged(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = _table(spark, sf_dir, "documents").select(F.concat("doc_id", F.lit("__p1")).alias("prompt_unique_id"), "doc_id", "source", "text", F.md5("text").alias("text_md5"), F.length("text").alias("prompt_size_chars"))
    # by the length of its text a document is in the library, in the batch (twice), or in both
    old = d.filter(f"NOT ({_FRESH})").drop("doc_id", "source", "text").withColumns({"record_status": F.lit("old"), "note": F.lit("kept"), "created_at": F.lit("2024-01-01").cast("timestamp"), "updated_at": F.lit("2024-01-01").cast("timestamp")})
    twice = d.filter(_BATCH).withColumn("seq", F.explode(F.array(F.lit(1), F.lit(2)))).withColumn("record_status", F.concat(F.lit("new"), "seq")).drop("doc_id", "source", "text")
    return library.merge(old, twice, ["seq"], now="2024-06-01")


def l1_upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    m = _merged(spark, sf_dir)
    day = lambda c: F.date_format(c, "yyyy-MM-dd").alias(c)
    return m.select("prompt_unique_id", "prompt_size_chars", "text_md5", "record_status", F.coalesce("note", F.lit("")).alias("note"), day("created_at"), day("updated_at"), "action")


def l2_upsert_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return library.counts(_merged(spark, sf_dir))


def v8_violations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What documents lack as prompts: short ones stand for missing fields."""
    d = _table(spark, sf_dir, "documents")
    rows = d.select(F.concat("doc_id", F.lit("__p1")).alias("prompt_unique_id"), F.col("text").alias("prompt_text_original"), F.when(F.col("doc_id") % 7 != 0, F.col("text")).otherwise("").alias("prompt_text_clean"), F.when(F.col("doc_id") % 5 != 0, "Learning_Aid").alias("prompt_type"),
                    F.array().cast("array<string>").alias("target_engine"), F.array(F.lit("chat")).alias("output_modality"), F.length("text").alias("prompt_size_chars"), F.lit("active").alias("record_status"))
    return library.violations(rows).select("prompt_unique_id", F.array_join("violations", ",").alias("violations"))


def o2_first_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A throttled run: the ten first of all links."""
    return dedup.take_first(_links(spark, sf_dir), ["link", "page_id"], 10)


def x2_incremental(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The conversations as a stream: each conversation once, over a checkpoint."""
    t = f"{sf_dir}/conversations.parque[t]"  # a pattern, for a file or a folder
    folder = scratch(spark, "stream")
    run_once(unseen(stream_of(spark, t, _table(spark, sf_dir, "conversations").schema, "parquet").select("conv_id"), "conv_id"), f"{folder}/out", f"{folder}/checkpoint")
    return spark.read.parquet(f"{folder}/out")


QUERIES = {f.__name__: f for f in (
    a2_group_posts, u10_canonical_urls, u7_query_strings, u2_wrapped_urls, f11_classified_urls, a10_platform_counts, u11_normalized_queue, m8_message_urls, m9_url_discovery, j1_skip_processed, s1_post_ids, s5_distinct_slides, s6_slide_names,
    s14_handoff, a9_outcome_counts, v6_valid_replies, e1_flat_prompts, v8_violations, l1_upsert, l2_upsert_counts, o2_first_links, x2_incremental,
)}

_VARIANTS_SQL = """forms AS (SELECT page_id, 0 AS variant, url AS link FROM pages UNION ALL SELECT page_id, 1, regexp_replace(url, '^https?', 'http') FROM pages
    UNION ALL SELECT page_id, 2, regexp_replace(url, '#.*$', '') || CASE WHEN url LIKE '%?%' THEN '&' ELSE '?' END || 'utm_source=n' FROM pages UNION ALL SELECT page_id, 3, regexp_replace(url, '[?#].*$', '') || '/' FROM pages)"""
_MERGE_SQL = f"""WITH d AS (SELECT doc_id || '__p1' AS prompt_unique_id, length(text)::INTEGER AS n, md5(text) AS text_md5, NOT ({_FRESH}) AS old, {_BATCH} AS new FROM documents),
    m AS (SELECT prompt_unique_id, n AS prompt_size_chars, text_md5, CASE WHEN new THEN 'new2' ELSE 'old' END AS record_status, CASE WHEN old THEN 'kept' ELSE '' END AS note,
        CASE WHEN old THEN '2024-01-01' ELSE '2024-06-01' END AS created_at, CASE WHEN new THEN '2024-06-01' ELSE '2024-01-01' END AS updated_at,
        CASE WHEN new AND old THEN 'updated' WHEN new THEN 'inserted' ELSE 'kept' END AS action FROM d)"""
#: Kinds of replies whose prompt is valid.
_GOOD = (0, 1, 2, 7, 11, 12)

ORACLE_SQL = {
    "u10_canonical_urls": f"{_CANON_SQL} SELECT page_id, normalized_url, notes FROM canon",
    "u7_query_strings": """WITH p AS (SELECT page_id, url_encode(url) AS u, url_encode(url || ' é') AS v FROM pages),
        forms AS (SELECT page_id, unnest([0, 1, 2, 3]) AS form, unnest(['?v=a+b&v=&list=' || u || '&list=c+d%2B', '?list=' || replace(v, '%20', '+') || '&list=+&v=', '?v=%25zz&v=~%2A', '']) AS q,
            unnest(['drop_param:feature,drop_param:V,drop_param:utm_source,query_normalized', 'query_normalized', 'drop_param:,query_normalized', 'drop_param:a,drop_param:b']) AS notes FROM p)
        SELECT page_id, form, 'https://www.youtube.com/watch' || q AS kept, notes, 'https://x.com/u' AS none FROM forms""",
    "u2_wrapped_urls": f"""WITH forms AS (SELECT page_id, unnest(range(4))::INTEGER AS variant, {_BASE} AS link FROM pages), {_canonical_sql('forms', 'page_id, variant')}
        SELECT page_id, variant, normalized_url, array_to_string(list_concat(CASE WHEN variant = 0 AND contains(link, '&') THEN ['html_entity_decoded'] WHEN variant IN (1, 2) THEN ['wrapped_target_extracted'] ELSE [] END, list_filter([notes], lambda x: x <> '')), ',') AS notes FROM canon""",
    "f11_classified_urls": f"{_classified_sql()} SELECT page_id, normalized_url, platform, CASE WHEN filter_reason LIKE 'accepted%' THEN 'pending' ELSE 'rejected' END AS status, filter_reason FROM judged",
    "a10_platform_counts": f"{_classified_sql()} SELECT CASE WHEN platform IN ('instagram', 'tiktok', 'x', 'youtube') THEN platform ELSE 'unknown' END AS platform, count(*) AS n_urls FROM judged GROUP BY 1",
    "u11_normalized_queue": f"WITH {_VARIANTS_SQL}, {_canonical_sql('forms', 'page_id, variant')} SELECT normalized_url, link AS original_url, page_id, variant, notes, 'pending' AS status FROM canon QUALIFY row_number() OVER (PARTITION BY normalized_url ORDER BY page_id, variant) = 1",
    "m8_message_urls": f"{_FOUND_SQL} SELECT message_id, count(*)::INTEGER AS url_count, string_agg(url, ' ' ORDER BY url) AS urls FROM social GROUP BY message_id",
    "m9_url_discovery": f"{_FOUND_SQL} SELECT url, min(message_id) AS source_message_id, 'pending' AS status FROM social GROUP BY url",
    "j1_skip_processed": "SELECT event_id, user_id, event_type FROM events WHERE user_id NOT IN (SELECT user_id FROM events WHERE event_type = 'purchase' AND event_id % 50 = 0)",
    "s1_post_ids": f"""WITH {_LINKS_SQL}, s AS (SELECT page_id, string_split(rtrim(link, '/'), '/') AS p FROM links)
        SELECT page_id, p[-1] AS post_id, CASE p[-2] WHEN 'p' THEN 'post' WHEN 'reel' THEN 'reel' WHEN 'reels' THEN 'reel' ELSE 'unknown' END AS content_type FROM s""",
    "a2_group_posts": f"{_POSTS_SQL} SELECT post_id, content_type, slide_total, slide_count_found, slide_order, source_images, md5(combined) AS text_md5, availability_status, all_ocr_status_ok FROM shown",
    "s14_handoff": f"""{_POSTS_SQL} SELECT post_id, content_type, slide_total, slide_count_found, slide_count_found AS n_slides, md5(combined) AS text_md5, 'ready_for_ai_semantic_extraction' AS handoff_status,
        'text_manipulator_agent_handoff_v2' AS producer, 'ready_for_text_manipulator_agent' AS source_post_prep_status FROM shown WHERE availability_status = 'available'""",
    "a9_outcome_counts": f"""{_POSTS_SQL} SELECT count(*) AS input_rows, 0::BIGINT AS skipped_missing_post_id, count(*) FILTER (WHERE availability_status = 'unavailable') AS skipped_unavailable, 0::BIGINT AS skipped_empty_slides,
        count(*) FILTER (WHERE availability_status <> 'unavailable') AS output_rows FROM shown""",
    "s5_distinct_slides": """WITH s AS (SELECT conv_id AS post_id, turn + 1 AS slide_index, sha256(role || lower(trim(text))) AS signature FROM conversations),
        n AS (SELECT *, row_number() OVER (PARTITION BY post_id, signature ORDER BY slide_index) > 1 AS again FROM s), f AS (SELECT *, min(slide_index) FILTER (WHERE again) OVER (PARTITION BY post_id) AS first FROM n)
        SELECT post_id, slide_index, signature FROM f WHERE (first IS NULL OR slide_index < first) AND slide_index <= 20""",
    "s6_slide_names": """WITH s AS (SELECT *, count(*) OVER (PARTITION BY conv_id) AS total FROM conversations)
        SELECT conv_id, turn, CASE WHEN turn = 7 THEN 'r' || conv_id ELSE 'c' || conv_id END AS post_id, CASE WHEN turn = 7 THEN 'reel_or_single' ELSE 'post' END AS content_type,
            CASE WHEN turn = 7 THEN 'r' || conv_id || '.png' ELSE printf('c%d_slide_%02d_of_%02d.png', conv_id, turn + 1, total) END AS slide_filename,
            CASE WHEN turn = 7 THEN 1 ELSE (turn + 1)::INTEGER END AS slide_index, CASE WHEN turn = 7 THEN 1 ELSE total::INTEGER END AS slide_total FROM s""",
    "v6_valid_replies": f"""SELECT doc_id::VARCHAR AS post_id, CASE WHEN kind IN (3, 4) OR kind IN (5, 8, 9, 14, 15) AND t THEN 'failed' ELSE 'valid' END AS verdict, CASE WHEN kind IN {_GOOD} AND t THEN 1 ELSE 0 END AS n_prompts,
        CASE WHEN kind NOT IN {_GOOD} OR NOT t THEN '' WHEN kind = 7 THEN 'medium' WHEN quality = 1 THEN 'high' ELSE 'low' END AS confidence
        FROM (SELECT d.doc_id, d.doc_id % {_REPLY_KINDS} AS kind, quality, regexp_matches(coalesce(text, ''), '[^\\s]') AS t FROM documents d LEFT JOIN labels l USING (doc_id))""",
    "e1_flat_prompts": f"""SELECT doc_id || '__p1' AS prompt_unique_id, md5(text) AS clean_md5, length(text)::INTEGER AS prompt_size_chars, CASE WHEN doc_id % {_REPLY_KINDS} = 7 THEN 'medium' WHEN quality = 1 THEN 'high' ELSE 'low' END AS extraction_confidence,
        'all_models' AS target_engine, 'active' AS record_status, 'all_models' AS model FROM documents LEFT JOIN labels USING (doc_id) WHERE doc_id % {_REPLY_KINDS} IN {_GOOD} AND regexp_matches(coalesce(text, ''), '[^\\s]')""",
    "v8_violations": """SELECT doc_id || '__p1' AS prompt_unique_id, array_to_string(list_filter([CASE WHEN coalesce(text, '') = '' THEN 'prompt_text_original' END, CASE WHEN doc_id % 7 = 0 OR coalesce(text, '') = '' THEN 'prompt_text_clean' END,
        CASE WHEN doc_id % 5 = 0 THEN 'prompt_type' END, CASE WHEN text IS NULL THEN 'prompt_size_chars' END], lambda x: x IS NOT NULL), ',') AS violations FROM documents""",
    "l1_upsert": f"{_MERGE_SQL} SELECT * FROM m",
    "l2_upsert_counts": f"{_MERGE_SQL} SELECT action, count(*) AS n_rows FROM m WHERE action <> 'kept' GROUP BY action",
    "o2_first_links": f"WITH {_LINKS_SQL} SELECT page_id, link FROM links ORDER BY link, page_id LIMIT 10",
    "x2_incremental": "SELECT DISTINCT conv_id FROM conversations",
}

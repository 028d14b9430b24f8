"""Golden rows, invariants and order independence of the library's operators."""

import json
import os

import pytest
from pyspark.sql import functions as F

from promptlake.functions.text import availability, image_facts, int_or, tidy, unfenced
from promptlake.functions.urls import found_urls, normalize
from promptlake.operators import dedup, handoff, library, replies, slides
from promptlake.operators.classify import classify
from promptlake.plans import pipeline
from promptlake.plans.queries import ORACLE_SQL, QUERIES
from promptlake.sources import jsonl, media
from promptlake.streaming import incremental

# url, normalized, notes, platform, reason
GOLDEN = [
    ("https://instagram.com/p/ABC123/?igsh=xyz#c", "https://instagram.com/p/ABC123/", "drop_param:igsh,drop_fragment", "instagram", "accepted_instagram_content"),
    ("http://www.instagram.com//reel//XYZ", "https://www.instagram.com/reel/XYZ/", "force_https", "instagram", "accepted_instagram_content"),
    ("https://www.youtube.com/watch?v=abc&amp;t=30s&amp;si=q", "https://www.youtube.com/watch?v=abc", "html_entity_decoded,drop_param:t,drop_param:si,query_normalized", "youtube", "accepted_youtube_watch"),
    ("https://www.facebook.com/l.php?u=https%3A%2F%2Fwww.instagram.com%2Fp%2FABC%2F%3Figsh%3D1&h=AT0", "https://www.instagram.com/p/ABC/", "wrapped_target_extracted,drop_param:igsh", "instagram", "accepted_instagram_content"),
    ("https://www.facebook.com/watch/?v=123", "https://www.facebook.com/watch", "drop_param:v", "facebook", "accepted_facebook_reel_or_watch"),
    ("http://X.com:80/user/status/1/", "https://x.com/user/status/1", "drop_default_port,force_https", "x", "accepted_x_status"),
    ("https://www.linkedin.com/company/acme/?trk=z", "https://www.linkedin.com/company/acme", "drop_param:trk", "linkedin", "rejected_linkedin_tracking_or_non_content"),
    ("https://www.tiktok.com/@me/video/9?lang=en", "https://www.tiktok.com/@me/video/9", "drop_param:lang", "tiktok", "accepted_tiktok_video"),
    ("https://www.pinterest.com/pin/77/", "https://www.pinterest.com/pin/77", "", "pinterest", "accepted_pinterest_pin"),
    ("https://example.com/a?b=1", "https://example.com/a", "drop_param:b", "unknown", "rejected_unknown_platform"),
    ("https://www.instagram.com/p/a.jpg", "https://www.instagram.com/p/a.jpg/", "", "instagram", "accepted_instagram_content"),
    ("https://youtu.be/abc?si=1", "https://youtu.be/abc", "drop_param:si", "youtube", "accepted_youtube_shortlink"),
    ("https://fb.watch/", "https://fb.watch/", "", "facebook", "accepted_facebook_watch"),
    ("https://www.youtube.com/watch?v=&list=L", "https://www.youtube.com/watch?v=&list=L", "", "youtube", "rejected_youtube_non_content"),
    ("https://example.com/a?x=1&copy=2", "https://example.com/a", "html_entity_decoded,drop_param:x", "unknown", "rejected_unknown_platform"),
    ("https://www.linkedin.com/", "https://www.linkedin.com/", "", "linkedin", "rejected_linkedin_empty_path"),
    ("https://x.com/a.png", "https://x.com/a.png", "", "x", "rejected_asset_url"),
]


def test_golden_urls(spark):
    d = spark.createDataFrame([(i, g[0]) for i, g in enumerate(GOLDEN)] + [(90, ""), (91, None), (92, "https://[bad/x")], "i int, url string")
    out = {r["i"]: r for r in classify(normalize(d, "url")).collect()}
    for i, (_, url, notes, platform, reason) in enumerate(GOLDEN):
        assert (out[i]["normalized_url"], ",".join(out[i]["normalization_notes"]), out[i]["platform"], out[i]["filter_reason"]) == (url, notes, platform, reason)
    assert 90 not in out and 91 not in out
    assert out[92]["normalized_url"] is None and out[92]["filter_reason"] == "rejected_missing_normalized_url"
    again = normalize(d.filter("i < 90").join(normalize(d, "url").select("i", "normalized_url"), "i").select("i", F.col("normalized_url").alias("url")), "url")
    assert again.filter("url <> normalized_url").count() == 0  # canonical forms stay


def test_discovery(spark):
    d = spark.createDataFrame([('see https://x.com/a/status/1). and (http://foo.com/b), https://youtu.be/z"',)], "text string")
    assert d.select(found_urls(F.col("text"))).first()[0] == ["https://x.com/a/status/1", "https://youtu.be/z"]


@pytest.mark.parametrize("parts", [1, 7])
def test_first_wins_in_any_order(spark, parts):
    d = spark.createDataFrame([(1, "http://x.com/u/status/1?s=20"), (2, "https://x.com/u/status/1"), (3, "https://x.com/u/status/2")], "seq int, url string").repartition(parts)
    out = {r["normalized_url"]: r for r in dedup.normalized_queue(d, ["seq"]).collect()}
    assert len(out) == 2 and out["https://x.com/u/status/1"]["seq"] == 1 and out["https://x.com/u/status/1"]["normalization_notes"] == ["drop_param:s", "force_https"]


OCR = "post_id string, content_type string, slide_filename string, slide_index string, slide_total string, source_image string, ocr_text_raw string, ocr_status string, event string, processed_at timestamp"


def slide(post, i, total, status, kind, image, text, event=None):
    return (post, kind, f"{image}", str(i) if i is not None else None, str(total), image, text, status, event, None)


def test_groups(spark):
    rows = [
        slide("P1", 2, 3, "ok", "post", "/b.png", "world "), slide("P1", 1, 3, "ok", "post", "/a.png", " hello"), slide("P1", 3, 9, "error", "post", "/c.png", ""), slide("P1", 1, 1, "ok", "post", "/m.png", "x", "ocr_extractor_started"),
        slide("P2", 1, 1, "error", "post", "/d.png", "Post isn't available"), slide("P2", 2, 1, "error", "reel_or_single", "/d.png", None), slide("P3", None, 1, "ok", None, "/e.png", "my blog in 2024"), slide(" ", 1, 1, "ok", "post", "/f.png", "y"), slide("P4", 123, 200, "ok", "", "/g.png", "t"),
    ]
    g = slides.group_posts(spark.createDataFrame(rows, OCR).repartition(3))
    out = {r["post_id"]: r for r in g.collect()}
    assert set(out) == {"P1", "P2", "P3", "P4"}
    p = out["P1"]
    assert (p["content_type"], p["slide_total"], p["slide_count_found"], p["all_ocr_status_ok"], p["availability_status"]) == ("post", 3, 3, False, "available")
    assert p["source_images"] == ["/a.png", "/b.png", "/c.png"] and p["ocr_text_combined_raw"] == "[SLIDE 01/03]\nhello\n\n[SLIDE 02/03]\nworld"
    assert (out["P2"]["content_type"], out["P2"]["slide_total"], out["P2"]["availability_status"], out["P2"]["source_images"]) == ("mixed", 2, "unavailable", ["/d.png"])
    assert (out["P3"]["content_type"], out["P3"]["availability_status"]) == ("unknown", "unavailable")
    assert out["P4"]["ocr_text_combined_raw"] == "[SLIDE 123/200]\nt"
    h = {r["post_id"]: r for r in handoff.hand_off(handoff.prepare(g)).collect()}
    assert set(h) == {"P1", "P4"} and [s["slide_index"] for s in h["P1"]["slides"]] == [1, 2, 3]
    assert handoff.outcome_counts(g).first()["skipped_unavailable"] == 2


def test_scalars(spark):
    d = spark.createDataFrame([("C8aZ_slide_01_of_08.png",), ("/x/C7DH.png",), ("z.jpg",)], "p string")
    assert [tuple(r) for r in d.select(*image_facts(F.col("p"))).collect()] == [("C8aZ", "post", "C8aZ_slide_01_of_08.png", 1, 8), ("C7DH", "reel_or_single", "C7DH.png", 1, 1), ("unknown", "unknown", "z.jpg", None, None)]
    one = spark.range(1)
    assert one.select(tidy(F.lit(" a\r\nb\rc \t"))).first()[0] == "a\nb\nc"
    assert [one.select(int_or(F.lit(v), 7)).first()[0] for v in (" 12 ", "1.5", "x", None)] == [12, 7, 7, 7]
    assert one.select(availability(F.lit("Please LOG IN"))).first()[0] == "unavailable"
    assert one.select(unfenced(F.lit("```json\n{}\n```"))).first()[0] == "{}"
    s = spark.createDataFrame([("p", 1, "a"), ("p", 2, "b"), ("p", 3, "a"), ("p", 4, "c")] + [("q", i, str(i)) for i in range(1, 25)], "post_id string, slide_index int, content string")
    assert sorted((r[0], r[1]) for r in slides.distinct_prefix(s).select("post_id", "slide_index").collect()) == [("p", 1), ("p", 2)] + [("q", i) for i in range(1, 21)]


PROMPT = {"prompt_carrousel_page_num": 1, "prompt_title": None, "prompt_date": None, "prompt_text_raw": "r", "prompt_text_clean": "a😀", "prompt_type": "Learning_Aid", "target_engine": ["all_models"], "output_modality": ["chat"], "comments": [], "extraction_confidence": "high", "extraction_confidence_score": 80}
REPLY = {"post_id": "other", "prompt_social_media": "instagram", "content_type": "x", "carrousel_title": "t", "prompt_count_detected": 7, "prompts": [PROMPT]}


def reply(prompt=None, drop=(), **top):
    p = {k: v for k, v in (PROMPT | (prompt or {})).items() if k not in drop}
    return json.dumps({k: v for k, v in (REPLY | {"prompts": [p]} | top).items() if k not in drop})


REPLIES = {
    "ok": (reply(), 1), "fence": (f"```json\n{reply()}\n```", 1), "prose": (f"Sure! {reply()} hope it helps", 1), "two": (f"{reply()} and {reply()}", None), "no_title": (reply(drop=["carrousel_title"]), None), "none": (reply(prompts=[]), 0),
    "blank": (reply(prompts=[PROMPT | {"prompt_text_clean": " "}, PROMPT, 5]), 1), "defaults": (reply(drop=["extraction_confidence", "extraction_confidence_score"]), 1), "text_score": (reply({"extraction_confidence_score": "80"}), None),
    "real_score": (reply({"extraction_confidence_score": 80.5}), None), "big_score": (reply({"extraction_confidence_score": 101}), None), "bool_page": (reply({"prompt_carrousel_page_num": True}), 1), "bool_count": (reply(prompt_count_detected=False), 1), "bool_score": (reply({"extraction_confidence_score": True}), 1), "real_page": (reply({"prompt_carrousel_page_num": 1.0}), None), "big_page": (reply({"prompt_carrousel_page_num": 1 << 40}), None),
    "null_in_list": (reply({"target_engine": [None]}), None), "null_after": (reply({"comments": ["a", None]}), None), "empty_lists": (reply({"target_engine": [], "comments": [], "output_modality": []}), 1), "list_in_list": (reply({"comments": [["a"]]}), None), "text_for_list": (reply({"comments": "a"}), None), "null_list": (reply({"comments": None}), None),
    **{f"says_nothing_{i}": (reply({"prompt_text_raw": x}), 0) for i, x in enumerate((0, 0.0, -0.0, False, [], {}, None, "", " \x1f\xa0\u2003\n"))}, **{f"no_text_{i}": (reply({"prompt_text_clean": x}), None) for i, x in enumerate((5, 0.5, True, [0], [None], {"a": None}))}, "missing_text": (reply(drop=["prompt_text_raw"]), 0),
    "level_list": (reply({"extraction_confidence": ["high"]}), None), "count_text": (reply(prompt_count_detected="1"), None), "prompts_object": (reply(prompts={}), None), "prompts_null": (reply(prompts=None), None), "title_number": (reply(carrousel_title=5), None), "no_braces": ("} {", None), "fenced_prose": (f"```\nSo: {reply()}\n```", 1), "null_level": (reply({"extraction_confidence": None}), None),
    "mixed_list": (reply({"comments": ["a", 1]}), None), "words": ("not JSON", None), "null": (None, None), "list": ("[1]", None),
}


def test_replies(spark):
    good, failed = replies.validate(spark.createDataFrame([(k, "post", v[0]) for k, v in REPLIES.items()], "post_id string, content_type string, raw_reply string"))
    counts = {r["post_id"]: r["prompt_count_detected"] for r in good.collect()} | {r["post_id"]: None for r in failed.filter(F.size("errors") > 0).collect()}
    assert counts == {k: v[1] for k, v in REPLIES.items()}
    p = {r["post_id"]: r for r in good.collect()}
    assert (p["defaults"]["prompts"][0]["extraction_confidence"], p["defaults"]["prompts"][0]["extraction_confidence_score"]) == ("medium", 50)
    flat = library.flatten(good.filter("post_id = 'ok'")).first()
    assert (flat["prompt_unique_id"], flat["prompt_size_chars"], flat["prompt_carrousel_id"]) == ("ok__p1", 2, "ok")
    assert replies.strict_errors(good).filter("post_id = 'ok'").first()["strict_errors"] == []


def test_model_calls(spark):
    tries, answer = spark.sparkContext.accumulator(0), reply()

    def model(prompt):
        tries.add(1)
        if "P2" in prompt:
            raise RuntimeError("down")
        return answer

    d = spark.createDataFrame([("P1", "post", "x"), ("P2", "post", "y")], "post_id string, content_type string, ocr_text_combined_raw string")
    out = {r["post_id"]: r for r in replies.call_model(replies.with_prompts(d, "Say {{HANDOFF_ROW_JSON}}!"), model, retries=2).collect()}
    assert out["P1"]["call_error"] is None and out["P2"]["raw_reply"] is None and out["P2"]["call_error"] == "down" and tries.value == 4


def test_reply_store(spark, tmp_path, monkeypatch):
    """Asked until valid, at most rounds x tries; never twice for what is settled, by other runs neither; a killed run goes on."""
    tries = spark.sparkContext.accumulator(0)
    flag, said = str(tmp_path / "mended"), reply(prompts=[])

    def model(prompt):
        tries.add(1)
        kind = prompt[:1]
        if kind == "e":
            raise RuntimeError("down")
        if kind == "m" and not os.path.exists(flag):
            return "no JSON"
        return "" if kind == "b" else "no JSON" if kind == "n" else said

    names = [f"{k}{i}" for k in "vvvenbm" for i in range(3)] + ["v0"] * 4
    d = spark.createDataFrame([(str(i), "post", p) for i, p in enumerate(names)], "post_id string, content_type string, user_prompt string").repartition(3)
    run = lambda **how: {names[int(r["post_id"])]: r for r in replies.answered(d, model, "m1", str(tmp_path / "store"), buckets=4, **how).collect()}
    real, seen = replies.BucketedLog.insert, []

    def killed(self, rows):
        seen.append(1)
        if len(seen) > 2:
            raise KeyboardInterrupt
        real(self, rows)

    with monkeypatch.context() as m:
        m.setattr(replies.BucketedLog, "insert", killed)
        with pytest.raises(KeyboardInterrupt):
            run(waves=4)
    half = tries.value
    assert 0 < half
    out = run(waves=4)
    # in all: valid ones once, errors and empty replies three tries in each of three rounds, others once in each round
    assert tries.value == 3 + 3 * 9 + 3 * 9 + 3 * 3 + 3 * 3
    assert [(out[k]["valid"], out[k]["n_rounds"], out[k]["n_tries"], out[k]["call_error"]) for k in ("v0", "e1", "b1", "n1", "m2")] == [(True, 1, 1, None), (False, 3, 9, "down"), (False, 3, 9, "empty reply"), (False, 3, 3, None), (False, 3, 3, None)]
    asked = tries.value
    assert run() == out and tries.value == asked  # a second run asks nothing
    open(flag, "w").close()
    new = run(retry_failed=True)
    assert new["m0"]["valid"] and new["m0"]["n_rounds"] == 4 and tries.value == asked + 3 + 3 * 9 + 3 * 9 + 3 * 3
    other = replies.answered(d.limit(1), model, "m2", str(tmp_path / "store"), buckets=4)  # another model has its own replies
    assert other.count() == 1 and tries.value > asked + 66


def test_load(spark, tmp_path):
    good, _ = replies.validate(spark.createDataFrame([("P", "post", reply(prompts=[PROMPT | {"prompt_text_raw": "first"}, PROMPT | {"prompt_text_raw": "last"}]))], "post_id string, content_type string, raw_reply string"))
    batch = library.checked(library.flatten(good))
    assert library.collisions(batch).first()["n_rows"] == 2
    table = str(tmp_path / "table")
    assert {r["action"]: r["n_rows"] for r in library.load(table, batch, ["prompt_pos"]).collect()} == {"inserted": 1}
    one = library.current(spark, table).first()
    assert one["prompt_text_original"] == "last"
    assert {r["action"]: r["n_rows"] for r in library.load(table, batch, ["prompt_pos"]).collect()} == {"updated": 1}
    two = library.current(spark, table).first()
    assert two["created_at"] == one["created_at"] and two["updated_at"] > one["updated_at"] and library.current(spark, table).count() == 1
    with pytest.raises(ValueError, match="lack"):
        library.checked(batch.withColumn("prompt_type", F.lit("")))
    bad = batch.withColumn("prompt_type", F.lit(""))
    with pytest.raises(ValueError, match="lack"):
        library.load(table, bad, ["prompt_pos"])
    assert library.current(spark, table).first() == two and "action" not in library.current(spark, table).columns
    assert library.report(batch) == {"status": "ok", "n_rows": 2, "n_failed": 0, "failures": []}
    told = library.report(bad, 1)
    assert told["status"] == "partial" and told["n_failed"] == 2 and told["failures"] == [("P__p1", ["prompt_type"])]


def test_jsonl(spark, tmp_path):
    (tmp_path / "a.jsonl").write_text('{"normalized_url": "u", "status": "ok"}\n\n[1]\nbroken\n{"normalized_url": null}\n')
    from pyspark.sql.types import StructType

    s = StructType.fromDDL("normalized_url string, status string")
    good, bad = jsonl.read_lenient(spark, str(tmp_path / "a.jsonl"), s)
    assert good.count() == 2 and [(r["line_number"], r["line"]) for r in bad.collect()] == [(4, "broken")]
    assert [r[0] for r in jsonl.read_processed(spark, str(tmp_path / "a.jsonl"), s, "normalized_url").collect()] == ["u"]
    with pytest.raises(ValueError, match="a.jsonl:3: "):
        jsonl.read_strict(spark, str(tmp_path / "a.jsonl"), s)
    with pytest.raises(Exception, match="not JSON"):
        jsonl.read_objects(spark, str(tmp_path / "a.jsonl"), s).collect()
    (tmp_path / "b.jsonl").write_text('{"normalized_url": "é"}\n7\n')
    rows = jsonl.read_objects(spark, str(tmp_path / "b.jsonl"), s)
    assert [r[0] for r in rows.collect()] == ["é"]
    jsonl.split_by(good, F.col("status") == "ok", str(tmp_path / "ready"), str(tmp_path / "rejected"))
    assert spark.read.json(str(tmp_path / "ready")).count() == 1 and spark.read.schema(s).json(str(tmp_path / "rejected")).count() == 1
    jsonl.write_queues(spark.createDataFrame([(" X ",), (None,), ("other",)], "platform string"), str(tmp_path / "q"), ("x",))
    assert {r["queue"]: r["count"] for r in spark.read.json(str(tmp_path / "q")).groupBy("queue").count().collect()} == {"x": 1, "unknown": 2}


def test_mail_and_images(spark, tmp_path):
    (tmp_path / "m").mkdir()
    (tmp_path / "m/1.eml").write_bytes(
        b"Subject: =?utf-8?q?caf=C3=A9?=\nFrom: a@b\nDate: Mon, 02 Jan 2023 03:04:05 +0200\nMIME-Version: 1.0\nContent-Type: multipart/mixed; boundary=B\n\n--B\nContent-Type: text/plain; charset=latin-1\n\nlook https://x.com/a/status/1.\n--B\nContent-Type: text/plain\nContent-Disposition: attachment\n\nhttps://x.com/b/status/2\n--B--\n"
    )
    (tmp_path / "m/2.eml").write_bytes(b"Subject: s\nDate: soon\nContent-Type: application/x-odd\n\nhttps://youtu.be/z")
    parts = media.mail_parts(media.stored_mail(spark, str(tmp_path / "m")))
    rows = sorted((r["subject"], r["email_datetime"], r["text"].strip()) for r in parts.collect())
    assert rows == [("café", "2023-01-02T01:04:05+00:00", "look https://x.com/a/status/1."), ("s", "soon", "https://youtu.be/z")]
    assert {r["normalized_url"]: r["status"] for r in pipeline.discover(parts).collect()} == {"https://x.com/a/status/1": "pending", "https://youtu.be/z": "pending"}
    for p in ("a_slide_01_of_02.png", "sub/a_slide_02_of_02.png", "sub/deep/no.png", "sub/x.txt"):
        (tmp_path / "shots" / p).parent.mkdir(parents=True, exist_ok=True)
        (tmp_path / "shots" / p).write_bytes(p.encode())
    shots = media.screenshots(spark, str(tmp_path / "shots"))

    def reader(content):
        if b"02" in content[-9:-4] and b"sub" in content:
            raise ValueError("unreadable")
        return "text"

    got = {r["slide_index"]: (r["ocr_status"], r["ocr_text_raw"], r["error"]) for r in media.extract_texts(shots, reader).collect()}
    assert got == {1: ("ok", "text", None), 2: ("error", "", "unreadable")}


def test_incremental(spark, tmp_path):
    from pyspark.sql.types import StructType

    s, inbox = StructType.fromDDL("k string"), tmp_path / "in"
    inbox.mkdir()
    run = lambda: incremental.run_once(incremental.unseen(incremental.stream_of(spark, str(inbox), s), "k"), str(tmp_path / "out"), str(tmp_path / "cp"))
    (inbox / "1.json").write_text('{"k": "a"}\n{"k": "b"}\n{"k": "a"}\n')
    run()
    (inbox / "2.json").write_text('{"k": "b"}\n{"k": "c"}\n')
    run()
    assert sorted(r["k"] for r in spark.read.parquet(str(tmp_path / "out")).collect()) == ["a", "b", "c"]
    queue = spark.createDataFrame([("a",), ("z",)], "k string")
    assert pipeline.remaining(queue, spark.read.parquet(str(tmp_path / "out")), "k", "INCREMENTAL").collect()[0]["k"] == "z"
    with pytest.raises(ValueError, match="mode"):
        pipeline.remaining(queue, None, "k", "OTHER")

    def fails():
        raise RuntimeError("stop")

    summary = pipeline.run_stages(spark, [("one", lambda: queue), ("two", fails), ("three", lambda: queue)]).collect()
    assert [(r["stage"], r["status"], r["failed_stage"]) for r in summary] == [("one", "ok", "two"), ("two", "failed", "two")]


def test_plans(spark):
    for name in ("a2_group_posts", "j1_skip_processed", "s14_handoff", "l1_upsert", "m9_url_discovery"):
        plan = QUERIES[name](spark, "/root/testdata/sf0.001")._jdf.queryExecution().toString()
        assert "Python" not in plan and "Pandas" not in plan
    assert set(ORACLE_SQL) == set(QUERIES)


def test_entry(spark):
    import __spark_entry__

    assert __spark_entry__.entry(spark).count() > 0

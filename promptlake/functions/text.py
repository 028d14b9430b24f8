"""Texts, paths and slides."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..rules import UNAVAILABLE


def post_id_of(url: Column) -> Column:
    """The last segment of a path."""
    return F.element_at(F.split(F.regexp_replace(url, r"/+$", ""), "/"), -1)


def content_type_of(url: Column) -> Column:
    """Post or reel by the segment before the last."""
    kind = F.try_element_at(F.split(F.regexp_replace(url, r"/+$", ""), "/"), F.lit(-2))
    return F.when(kind == "p", "post").when(kind.isin("reel", "reels"), "reel").otherwise("unknown")


def slide_name(post: Column, index: Column, total: Column) -> Column:
    """<post>_slide_NN_of_MM.png (S3)."""
    return F.format_string("%s_slide_%02d_of_%02d.png", post, index, total)


def image_facts(path: Column) -> list[Column]:
    """post_id, content_type, slide_filename, slide_index and slide_total from a file's name."""
    name = F.regexp_extract(path, r"[^/]+$", 0)
    carousel, single = r"^(.+?)_slide_(\d{2})_of_(\d{2})\.png$", r"^([^/\\]+)\.png$"
    many, one = name.rlike(carousel), name.rlike(single)
    number = lambda group: F.when(many, F.regexp_extract(name, carousel, group)).when(one, F.lit("1")).cast("int")
    return [
        F.when(many, F.regexp_extract(name, carousel, 1)).when(one, F.regexp_extract(name, single, 1)).otherwise(F.lit("unknown")).alias("post_id"),
        F.when(many, "post").when(one, "reel_or_single").otherwise("unknown").alias("content_type"),
        name.alias("slide_filename"),
        number(2).alias("slide_index"),
        number(3).alias("slide_total"),
    ]


def availability(text: Column, patterns: tuple[str, ...] = UNAVAILABLE) -> Column:
    """unavailable where the text says so."""
    return F.when(F.lower(F.coalesce(text, F.lit(""))).rlike("|".join(patterns)), "unavailable").otherwise("available")


def int_or(value: Column, default: Column | int) -> Column:
    """A whole number or the default."""
    return F.coalesce(value.cast("string").try_cast("int"), default if isinstance(default, Column) else F.lit(default))


#: What counts as white space at the ends of texts.
WHITE = "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a\u2028\u2029\u202f\u205f\u3000"


def strip(text: Column) -> Column:
    """Without white space of any kind at both ends; only the ends are looked at."""
    return F.btrim(text, F.lit(WHITE))


def tidy(text: Column) -> Column:
    """Null as empty, line ends as \\n, stripped."""
    return strip(F.regexp_replace(F.coalesce(text, F.lit("")), "\r\n?", "\n"))


def user_prompt(template: str, record: Column, mark: str = "{{HANDOFF_ROW_JSON}}") -> Column:
    """The template with the record as JSON (V1)."""
    return F.replace(F.lit(template), F.lit(mark), F.to_json(record, {"ignoreNullFields": "false"}))


def unfenced(reply: Column, stripped: bool = False) -> Column:
    """A reply without the fence of backticks around it (V2)."""
    fence = r"(?s)^\x60{3}[^\n]*\n(.*)\n\s*\x60{3}\s*$"
    t = reply if stripped else strip(reply)
    return F.when(t.startswith("`" * 3) & t.rlike(fence), strip(F.regexp_extract(t, fence, 1))).otherwise(t)


def json_object_in(text: Column) -> Column:
    """From the first { to the last } (V3)."""
    return F.when(text.startswith("{") & text.endswith("}"), text).otherwise(F.regexp_extract(text, r"(?s)\{.*\}", 0))


def json_in_list(text: Column) -> Column:
    """A list of what a text says in JSON, as a variant, else null: the parser alone stops after the first value."""
    return F.try_parse_json(F.concat(F.lit("["), text, F.lit("]")))


def only_value(values: Column) -> Column:
    """The value of a list of one, else null."""
    return F.when(F.try_variant_get(values, "$[1]", "variant").isNull(), F.try_variant_get(values, "$[0]", "variant"))


def whole_json(text: Column) -> Column:
    """A text that is one JSON value and nothing more, as a variant, else null (V4)."""
    return only_value(json_in_list(text))

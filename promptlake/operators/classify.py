"""Platform and acceptance of URLs."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ..functions.urls import NETLOC, PATH, QUERY, part
from ..rules import ASSET_ENDINGS, PLATFORM_HOSTS
from ..schemas import CLASSIFIED


def platform_of(host: Column, platforms: Mapping[str, tuple[str, ...]] = PLATFORM_HOSTS) -> Column:
    """The platform of a host, or unknown (F1)."""
    out = F.lit("unknown")
    for name, hosts in platforms.items():
        out = F.when(host.isin(list(hosts)), name).otherwise(out)
    return out


def _reasons(platform: Column, host: Column, path: Column, query: Column, asset_endings: tuple[str, ...]) -> Column:
    """The reason code, whose first word is accepted or rejected."""
    seg = F.filter(F.split(path, "/"), lambda s: s != "")
    n = F.size(seg)
    at = lambda i: F.coalesce(F.get(seg, F.lit(i)), F.lit(""))
    rules = {
        "instagram": [((n >= 2) & at(0).isin("p", "reel", "reels"), "accepted_instagram_content"), (None, "rejected_instagram_non_content")],
        "tiktok": [((n >= 3) & at(0).startswith("@") & (at(1) == "video"), "accepted_tiktok_video"), (None, "rejected_tiktok_non_video")],
        "x": [((n >= 3) & (at(1) == "status"), "accepted_x_status"), (None, "rejected_x_non_status")],
        "facebook": [
            (host == "fb.watch", "accepted_facebook_watch"),
            (F.array_contains(seg, "reel") | F.array_contains(seg, "watch"), "accepted_facebook_reel_or_watch"),
            (F.array_contains(seg, "posts"), "accepted_facebook_post"),
            ((n >= 2) & ~at(0).isin("help", "privacy", "settings", "policies"), "accepted_facebook_generic_content"),
            (None, "rejected_facebook_non_content"),
        ],
        "linkedin": [
            (n == 0, "rejected_linkedin_empty_path"),
            (at(0).isin("comm", "help", "psettings", "emimp", "company", "school", "learning"), "rejected_linkedin_tracking_or_non_content"),
            (at(0) == "posts", "accepted_linkedin_post"),
            (at(0) == "pulse", "accepted_linkedin_pulse"),
            ((n >= 2) & (at(0) == "feed") & (at(1) == "update"), "accepted_linkedin_feed_update"),
            (None, "rejected_linkedin_non_content"),
        ],
        "youtube": [
            ((host == "youtu.be") & (n >= 1), "accepted_youtube_shortlink"),
            ((at(0) == "shorts") & (n >= 2), "accepted_youtube_shorts"),
            (path.rlike("^/watch/*$") & query.rlike("(^|&)v=[^&]"), "accepted_youtube_watch"),
            (None, "rejected_youtube_non_content"),
        ],
        "pinterest": [((n >= 2) & (at(0) == "pin"), "accepted_pinterest_pin"), (None, "rejected_pinterest_non_pin")],
    }
    out = F.when(platform == "unknown", "rejected_unknown_platform").when(F.lower(path).rlike(r"\.(" + "|".join(asset_endings) + ")$"), "rejected_asset_url")
    for name, cases in rules.items():
        for when, reason in cases:
            out = out.when(platform == name if when is None else (platform == name) & when, reason)
    return out.otherwise("rejected_unhandled_platform")


def classify(queue: DataFrame, column: str = "normalized_url", platforms: Mapping[str, tuple[str, ...]] = PLATFORM_HOSTS, asset_endings: tuple[str, ...] = ASSET_ENDINGS) -> DataFrame:
    """``queue`` with platform, status and filter_reason; blank URLs are rejected first."""
    url = F.coalesce(F.trim(column), F.lit(""))
    path = F.when(part(url, PATH) == "", "/").otherwise(F.regexp_replace(part(url, PATH), r";[^/]*$", ""))
    # generators are computed once; filters on the verdict would else repeat all that leads to it
    q = queue.drop("filter_reason").select("*", F.explode(F.array(F.struct(url.alias("url"), F.lower(part(url, NETLOC)).alias("host"), path.alias("path"), part(url, QUERY).alias("query")))).alias("_u"))
    u, blank = F.col("_u"), F.col("_u.url") == ""
    q = q.withColumn("platform", F.when(blank, "unknown").otherwise(platform_of(u["host"], platforms)))
    reason = F.when(blank, "rejected_missing_normalized_url").otherwise(_reasons(F.col("platform"), u["host"], u["path"], u["query"], asset_endings))
    q = q.select("*", F.explode(F.array(reason)).alias("filter_reason")).drop("_u")
    q = q.withColumn("status", F.when(F.col("filter_reason").startswith("accepted"), "pending").otherwise("rejected"))
    if "normalization_notes" in queue.columns:
        q = q.withColumn("normalization_notes", F.coalesce("normalization_notes", F.array().cast("array<string>")))
    return q


def platform_counts(classified: DataFrame) -> DataFrame:
    """Rows of each platform (A10)."""
    return classified.groupBy("platform").agg(F.count("*").alias("n_urls"))


def output_rows(classified: DataFrame) -> DataFrame:
    """The ten columns of the filter's output, whatever else a queue carries."""
    return classified.select(*StructType.fromDDL(CLASSIFIED).fieldNames())


def filter_counts(classified: DataFrame) -> DataFrame:
    """One row of the filter's counters."""
    accepted, missing = F.col("status") == "pending", F.col("filter_reason") == "rejected_missing_normalized_url"
    return classified.agg(F.count("*").alias("input_rows"), F.count_if(accepted).alias("accepted_rows"), F.count_if(~accepted).alias("rejected_rows"), F.count_if(missing).alias("missing_url_rows"))

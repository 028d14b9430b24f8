"""The queries of this subpackage: each takes (spark, sf_dir) and reads whole tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import chat, html_sst, jaccard, linededup, mixing, negatives, quality, repair, sharding, suffix, tokens, warc, winnow
from .common import checkpointed, scratch, table
from .oracles import ORACLE_SQL, PROBE  # noqa: F401


def op1_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.quality_rules(table(spark, sf_dir, "documents"))


def op2_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_sst.extract(table(spark, sf_dir, "pages"))


def op3_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix.remove_repeats(table(spark, sf_dir, "documents")).drop("spans")


def op4_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = scratch(spark, "warc")
    warc.write_archives(table(spark, sf_dir, "pages"), folder)
    return warc.read_archives(spark, folder).drop("url")


def op5_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return winnow.decontaminate(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")).drop("spans")


def op6_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    probe = spark.range(2).select(F.lit(-1).cast("long").alias("conv_id"), F.col("id").alias("turn"), F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"), F.lit(PROBE).alias("text"))
    return chat.read_back(checkpointed(chat.windows(turns.unionByName(probe))))


def op7_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(table(spark, sf_dir, "documents")).select("doc_id", "size", "source_size", "target", "taken")


def op8_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.jaccard_components(table(spark, sf_dir, "documents"))


def op9_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = linededup.dedup_passages(table(spark, sf_dir, "documents"))
    return out.select("doc_id", "n_lines", "n_chunks", "n_removed_chunks", "n_removed_lines", F.sha2("kept", 256).alias("kept_sha256"))


def op10_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.shard(table(spark, sf_dir, "documents"), n_shards=40)


def op11_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repair.repairs(repair.damaged(table(spark, sf_dir, "conversations")))


def op12_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    return negatives.hard_negatives(negatives.relabelled(table(spark, sf_dir, "embeddings")))


def op13_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return tokens.count_tokens(table(spark, sf_dir, "documents"), public_tokenizers.path("piece_bpe_32k.model"))


QUERIES = {f.__name__: f for f in (op1_quality_rules, op2_html_extraction, op3_suffix_dedup, op4_warc, op5_decontamination, op6_chat_format, op7_mixing, op8_jaccard_join, op9_line_dedup, op10_sharding, op11_conversation_repair, op12_hard_negatives, op13_token_counts)}


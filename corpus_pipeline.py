"""From raw documents to a sharded training mix, as stages over the columns of ``documents``.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; a runner writes it as
Parquet and reads it as the next one's docs.  All but the last return the columns of
``documents``; the last adds the shard and the place in it.

Null texts, languages and sources, rows without an id, rows that repeat, very long texts
and empty tables are no errors in any stage; what each does with them is in the docstring
of its function in ``promptlake.llm``.  Further columns are carried along, whatever their
names (``sharding`` puts ``doc_`` before one that is named as a column it adds).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from promptlake.llm import jaccard, mixing, quality, sharding, winnow
from promptlake.llm.common import scratch, table

N_SHARDS = 40


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop what the quality rules reject (texts without 50 words, null ones too)."""
    return quality.keep_good(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep one row of each component of the n-gram Jaccard join, that of the smallest id."""
    return jaccard.keep_one(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop documents in which a window of a benchmark item occurs; with an empty benchmark all stay."""
    return winnow.keep_clean(docs, table(spark, sf_dir, "benchmark"))


def mixing_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Repeat or leave out documents so that sources reach their target words; texts without words go with their source's share."""
    return mixing.apply_mix(docs)


def sharding_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Add size, shard and slot; repeated rows spread over shards as others do."""
    return sharding.with_shards(docs, N_SHARDS)


STAGES = [
    ("quality rules", quality_rules),
    ("n-gram Jaccard join", near_duplicates),
    ("benchmark decontamination", decontamination),
    ("mixing sources to target weights", mixing_sources),
    ("sharding", sharding_documents),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each stage's rows written in the shared folder and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        folder = scratch(spark, "pipeline")
        stage(spark, docs, sf_dir).write.parquet(folder)
        docs = spark.read.parquet(folder)
    return STAGES[-1][1](spark, docs, sf_dir)


#: The stages repeat rows by seeded draws and shard by crc32, which the oracle's SQL lacks;
#: tests hold the run against a brute-force version.
ORACLE_SQL = None

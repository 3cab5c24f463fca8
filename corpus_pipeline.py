"""The corpus pipeline: toxic documents go, one of each group of near copies stays, contaminated documents go, sources
are mixed to their targets, and what is left is dealt to shards.

Every stage takes (spark, docs, sf_dir) and returns a DataFrame, which is written and read again for the next one. All
but the last return the columns of ``documents``; the last returns the shard and slot of every row.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from staywise.llm import contamination, mixing, overlap_join, sharding, toxicity
from staywise.llm.catalog import table
from staywise.session import materialize


def reject_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents below the toxicity threshold; every other one goes."""
    return toxicity.accepted(docs, table(spark, sf_dir, "labels"))


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group that near-copy links connect, the document with the smallest doc_id."""
    return overlap_join.keep_first(docs)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that are not contaminated by the benchmark."""
    return contamination.clean_documents(docs, table(spark, sf_dir, "benchmark"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each source's documents up to its target, repeated where the source is smaller; documents stay whole."""
    return mixing.mixed_documents(docs)


def shard(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Per row: doc_id, size, text_crc32, law, shard, slot, grown_shard."""
    return sharding.assign_shards(docs)


STAGES = [
    ("toxicity", reject_toxic),
    ("jaccard_join", drop_near_copies),
    ("decontaminate", decontaminate),
    ("mix", mix_sources),
    ("shard", shard),
]

#: A fitted classifier decides in the first stage, which SQL can't express.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    docs = table(spark, sf_dir, "documents")
    for i, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if i < len(STAGES) - 1:
            docs = materialize(docs, name)
    return docs

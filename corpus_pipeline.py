"""From raw documents to packed sequences: the stages of the corpus pipeline."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from tidegate.llm import host_rules, jaccard_join, line_dedup, mixing, packing
from tidegate.llm.common import Workspace

TOKENIZER = public_tokenizers.path("word_bpe_49k.json")


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop the documents that fail the rules, and those of rejected hosts."""
    return host_rules.keep_good(docs)


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Delete the blocks of lines that an earlier document has, and documents left without a word."""
    return line_dedup.without_repeated_lines(docs)


def near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep the first document of each group of near duplicates."""
    return jaccard_join.one_of_each(docs)


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Repeat or leave out documents until every source has its share of words."""
    return mixing.repeat_by_mix(docs)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Place the token pieces of the documents in sequences."""
    return packing.pack_documents(docs, TOKENIZER)


STAGES = [("quality rules", quality), ("line dedup", lines), ("n-gram Jaccard join", near),
          ("mixing", mixed), ("packing", packed)]

#: The stages iterate, align and search; SQL can't express them.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply all stages to the documents, each to what the one before has written."""
    ws = Workspace(spark, "pipeline")
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = ws.keep(stage(spark, docs, sf_dir), name.replace(" ", "-"))
        ws.release()
    return docs

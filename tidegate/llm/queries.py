"""The registered queries of this subpackage, with the SQL they must equal where SQL can say it."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .ann import neighbours
from .conversation_repair import repair_damaged
from .host_rules import judge
from .jaccard_join import near_duplicates
from .line_dedup import dedup_lines
from .mixing import mix
from .packing import pack_documents
from .pitman_yor import score_texts
from .sharding import shard_rows
from .substring_dedup import remove_repeats
from .token_alignment import align_documents
from .toxicity import fit, score_documents
from .trie_bpe import round_trip

TOKENIZER = public_tokenizers.path("word_bpe_49k.json")
BYTE_BPE = public_tokenizers.path("byte_bpe_50k.json")
PIECE_BPE = public_tokenizers.path("piece_bpe_32k.model")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op3_pitman_yor(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score_texts(table(spark, sf_dir, "documents"))


def op4_host_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return judge(table(spark, sf_dir, "documents")).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


def op5_feistel_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shard_rows(table(spark, sf_dir, "documents"))


def op6_entropy_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix(table(spark, sf_dir, "documents")).select(
        "doc_id", "size", "source_size", "target", "taken", "copies")


def op1_string_kernel_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return score_documents(docs, fit(docs, table(spark, sf_dir, "labels")))


def op2_multi_index_hashing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neighbours(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0)


def op7_line_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dedup_lines(table(spark, sf_dir, "documents")).select(
        "doc_id", F.col("__tidegate_lines").cast("long").alias("n_lines"), F.col("__tidegate_gone").cast("long").alias("n_removed"),
        F.sha2(F.coalesce("text", F.lit("")), 256).alias("kept_sha256"))


def op8_fm_index_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return remove_repeats(table(spark, sf_dir, "documents")).select(
        F.col("id").alias("doc_id"), "n_words", "n_removed", F.sha2("kept_text", 256).alias("kept_sha256"))


def op9_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents"))


def op10_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack_documents(table(spark, sf_dir, "documents"), TOKENIZER)


def op11_trie_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return round_trip(table(spark, sf_dir, "documents"), BYTE_BPE)


def op12_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repair_damaged(table(spark, sf_dir, "conversations"))


def op13_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return align_documents(table(spark, sf_dir, "documents"), BYTE_BPE, PIECE_BPE)


QUERIES = {q.__name__: q for q in (
    op1_string_kernel_toxicity, op2_multi_index_hashing, op3_pitman_yor, op4_host_rules, op5_feistel_shards, op6_entropy_mix,
    op7_line_alignment, op8_fm_index_dedup, op9_jaccard_join, op10_best_fit_packing, op11_trie_bpe,
    op12_conversation_repair, op13_token_alignment)}
ORACLES: dict[str, str] = {}

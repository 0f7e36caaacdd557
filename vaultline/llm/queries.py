"""One registered query per operator, with production parameters over whole tables."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import bpe, chat, katz, language, lines, merkle, mixing, neardup, neighbours, private, quality, trie, warc
from .oracle import ORACLE  # noqa: F401  (registered with the queries)
from .tables import held_out, table

RANK_FILE = "byte_bpe_multi_50k.tiktoken"


def op1_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lines.dedup_lines(table(spark, sf_dir, "documents")).select(
        "row.doc_id", "text", "n_lines", "n_removed", "words_removed")


def op2_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.quality_rules(table(spark, sf_dir, "documents")).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        "base_failed", "kept", "quality")


def bpe_settings() -> tuple[dict[bytes, int], bpe.Settings]:
    return bpe.load_ranks(public_tokenizers.path(RANK_FILE)), bpe.Settings(public_tokenizers.PATTERN)


def op3_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.encode(table(spark, sf_dir, "documents"), *bpe_settings())


def op4_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select(
        "doc_id", "text", "lang", held_out(F.col("doc_id"), 4).alias("held_out"))
    profiles = language.learn(docs.filter(~F.col("held_out")))
    return language.identify(docs, profiles,
                             keep={"doc_id": F.col("doc_id"), "held_out": F.col("held_out")})


def op5_setsketch_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neardup.near_duplicates(table(spark, sf_dir, "documents")).select(
        "doc_id", "n_shingles", "component_id", "kept")


def op6_private_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    return private.find(table(spark, sf_dir, "documents"))


def op7_chat_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    said = "</s>[INST] ok [/INST]"
    given = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    extra = spark.range(2).select(F.lit(-7).alias("conv_id"), F.col("id").alias("turn"),
                                  F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"),
                                  F.lit(said).alias("text"))
    return chat.digests(given.unionByName(extra))


def op8_permutation_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neighbours.search(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0)


def op9_katz_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = katz.score(table(spark, sf_dir, "documents"), ~held_out(F.col("doc_id"), 7))
    return out.select("doc_id", (~F.col("train")).alias("held_out"), "n_tokens", "n_known",
                      "train_tokens", "base_score", "score")


def op10_source_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(table(spark, sf_dir, "documents")).select(
        "row.doc_id", "size", F.col("source_size").cast("long").alias("source_size"), "target",
        (F.col("copies") * F.col("size")).alias("taken"))


def op11_conversation_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return trie.conversation_trie(table(spark, sf_dir, "conversations"))


def op12_warc_archives(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.round_trip(table(spark, sf_dir, "pages"))


def op13_merkle_proofs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merkle.proofs(table(spark, sf_dir, "documents"))


QUERIES = {f.__name__: f for f in (op1_line_dedup, op2_quality_rules, op3_byte_bpe, op4_language_id, op5_setsketch_dedup, op6_private_data,
                                   op7_chat_windows, op8_permutation_index, op9_katz_score, op10_source_mix,
                                   op11_conversation_trie, op12_warc_archives, op13_merkle_proofs)}


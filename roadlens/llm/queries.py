"""Registered queries of the training-data operators, each over its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from roadlens.llm import ann, chat, conversation_repair, hnsw, lexical_search, license_scan, line_dedup, mix, ngram_join, sentencepiece_codec, substring_dedup, token_counts, toxicity
from roadlens.llm.common import table


def model_path(name: str) -> str:
    """Place of a public tokenizer file; the package is on every machine."""
    import public_tokenizers

    return public_tokenizers.path(name)


PIECE_MODEL = "piece_bpe_32k.model"


def op1_license_scans(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = license_scan.scan_licenses(table(spark, sf_dir, "documents"))
    return out.withColumn("n_spans", F.size("spans").cast("long")).drop("spans")


def op2_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_dedup.dedup_digest(table(spark, sf_dir, "documents"), min_words=1)


def op3_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sentencepiece_codec.encode_digest(table(spark, sf_dir, "documents"), model_path(PIECE_MODEL))


def op4_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.ngram_components(table(spark, sf_dir, "documents"))


def op5_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hnsw.near_vectors(table(spark, sf_dir, "embeddings"))


def op6_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix.mix(table(spark, sf_dir, "documents"))


def op7_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    probe = "</s>[INST] ok [/INST]"
    extra = spark.range(2).select(
        F.lit(-7).cast("long").alias("conv_id"),
        F.col("id").alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"),
        F.lit(probe).alias("text"),
    )
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text").union(extra)
    return chat.read_back(chat.format_chat(turns))


def op8_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.token_counts(table(spark, sf_dir, "documents"), model_path(PIECE_MODEL))


def op9_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return toxicity.score(docs, toxicity.fit(docs, table(spark, sf_dir, "labels")))


def op10_nearest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ann.nearest(table(spark, sf_dir, "embeddings"))


def op11_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    index = lexical_search.build_index(table(spark, sf_dir, "documents"))
    return lexical_search.search(index, table(spark, sf_dir, "benchmark"))


def op12_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    return conversation_repair.repair_digest(table(spark, sf_dir, "conversations"))


def op13_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring_dedup.dedup_digest(table(spark, sf_dir, "documents"))


QUERIES: dict[str, tuple[Callable[[SparkSession, str], DataFrame], str | None]] = {
    "op1_license_scans": (op1_license_scans, None),
    "op2_line_dedup": (op2_line_dedup, None),
    "op3_sentencepiece": (op3_sentencepiece, None),
    "op4_ngram_join": (op4_ngram_join, None),
    "op5_embedding_dedup": (op5_embedding_dedup, None),
    "op6_mix_sources": (op6_mix_sources, mix.OP6_SQL),
    "op7_chat_format": (op7_chat_format, chat.OP7_SQL),
    "op8_token_counts": (op8_token_counts, None),
    "op9_toxicity": (op9_toxicity, None),
    "op10_nearest": (op10_nearest, None),
    "op11_lexical_search": (op11_lexical_search, lexical_search.OP11_SQL),
    "op12_conversation_repair": (op12_conversation_repair, None),
    "op13_substring_dedup": (op13_substring_dedup, substring_dedup.OP13_SQL),
}

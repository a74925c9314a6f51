"""Registered queries of the corpus operators: each reads its whole table and returns its full result."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from vanewright.llm import ann, audit, centroids, chat, decontam, html, langid, mixing, neardup, pii, secrets, tokens, toxicity


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.op1(table(spark, sf_dir, "documents"))


def op2_embedding_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ann.op2(table(spark, sf_dir, "embeddings"))


def op3_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return langid.op3(table(spark, sf_dir, "documents"))


def op4_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.op4(table(spark, sf_dir, "documents"))


def op5_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.op5(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op6_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.op6(table(spark, sf_dir, "documents"))


def op7_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return tokens.op7(table(spark, sf_dir, "documents"), public_tokenizers.path("piece_bpe_32k.model"))


def op8_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neardup.op8(table(spark, sf_dir, "documents"))


def op9_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html.op9(table(spark, sf_dir, "pages"))


def op10_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontam.op10(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op11_centroids(spark: SparkSession, sf_dir: str) -> DataFrame:
    return centroids.op11(table(spark, sf_dir, "embeddings"))


def op12_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chat.op12(table(spark, sf_dir, "conversations"))


def op13_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return audit.op13(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f for f in (op1_secrets, op2_embedding_near_dedup, op3_language_id, op4_personal_data, op5_toxicity, op6_mixing, op7_token_counts, op8_minhash_near_dedup, op9_main_text, op10_decontamination, op11_centroids, op12_chat_format, op13_filter_audit)
}

SQL: dict[str, str] = {"op1_secrets": secrets.SQL, "op2_embedding_near_dedup": ann.SQL, "op6_mixing": mixing.SQL, "op8_minhash_near_dedup": neardup.SQL, "op10_decontamination": decontam.SQL, "op11_centroids": centroids.SQL, "op12_chat_format": chat.SQL, "op13_filter_audit": audit.SQL}

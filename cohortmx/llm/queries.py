"""The registered queries of this folder: one per operator, and the pipeline."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cohortmx.llm import (chat_format, dart_minhash, decontaminate, heap_kmeans, jump_shards, language_id, merkle, packing,
                          quality_rules, secret_crf, token_counts, toxicity, winnowing)
from cohortmx.llm.common import documents, table
from cohortmx.llm.oracles import ORACLE  # noqa: F401


def op1_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.length_histogram(token_counts.token_lengths(documents(spark, sf_dir)))


def op2_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    held_out = quality_rules.held_out(F.col("doc_id"))
    model = quality_rules.learn(docs, table(spark, sf_dir, "labels"), held_out)
    return quality_rules.score_texts(docs.select("doc_id", "text"), model).select(
        "doc_id", held_out.alias("held_out"), "score", (F.col("score") >= quality_rules.GOOD_AT).cast("int").alias("predicted"))


def op3_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    held_out = toxicity.held_out(F.col("doc_id"))
    lexicon = toxicity.learn(docs, table(spark, sf_dir, "labels"), held_out)
    return toxicity.score_texts(docs.select("doc_id", "text"), lexicon).select(
        "doc_id", held_out.alias("held_out"), "score", (F.col("score") >= toxicity.FLAG_AT).cast("int").alias("predicted"), "n_terms")


def op4_secret_crf(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    return secret_crf.scan(docs, secret_crf.learn(docs))


def op5_winnowing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return winnowing.edited_pairs(documents(spark, sf_dir))


def op6_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.best_fit_pack(documents(spark, sf_dir))


def op7_dart_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dart_minhash.near_duplicates(documents(spark, sf_dir))


def op8_jump_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jump_shards.assign(documents(spark, sf_dir))


def op9_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.contamination(documents(spark, sf_dir), table(spark, sf_dir, "benchmark"))


def op10_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    held_out = language_id.held_out(F.col("doc_id"))
    learned = language_id.profiles(docs.where(~held_out))
    return language_id.identify(docs.select("doc_id", "text"), learned).select("doc_id", held_out.alias("held_out"), "lang_pred", "score")


def op11_heap_kmeans(spark: SparkSession, sf_dir: str) -> DataFrame:
    return heap_kmeans.cluster(table(spark, sf_dir, "embeddings"))


def op12_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merkle.manifest(documents(spark, sf_dir))


def op13_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chat_format.conversation_digests(table(spark, sf_dir, "conversations"))


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    import corpus_pipeline

    return corpus_pipeline.run(spark, sf_dir)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_token_counts": op1_token_counts,
    "op2_quality_rules": op2_quality_rules,
    "op3_toxicity": op3_toxicity,
    "op4_secret_crf": op4_secret_crf,
    "op5_winnowing": op5_winnowing,
    "op6_best_fit_packing": op6_best_fit_packing,
    "op7_dart_minhash": op7_dart_minhash,
    "op8_jump_shards": op8_jump_shards,
    "op9_decontamination": op9_decontamination,
    "op10_language_id": op10_language_id,
    "op11_heap_kmeans": op11_heap_kmeans,
    "op12_merkle_manifest": op12_merkle_manifest,
    "op13_chat_format": op13_chat_format,
    "pipeline": pipeline,
}

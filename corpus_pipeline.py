"""Corpus pipeline: toxicity, near duplicates, benchmark leaks, secrets, packing.

Each stage takes all documents that the stage before it kept, written as
Parquet and read again; all but the last return the columns of documents.
Null and repeated rows, empty texts and extra columns pass as the operators
say: only toxic, duplicate and contaminated rows go, secrets are masked.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cohortmx.llm import dart_minhash, decontaminate, packing, secret_crf, toxicity
from cohortmx.llm.common import documents, table
from cohortmx.session import scratch_path


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that score below the flag, by a lexicon learned from this input's labels."""
    lexicon = toxicity.learn(docs, table(spark, sf_dir, "labels"), toxicity.held_out(F.col("doc_id")))
    return toxicity.drop_toxic(docs, lexicon)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the smallest id of each near-duplicate class."""
    return dart_minhash.drop_near_duplicates(docs)


def drop_benchmark_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a passage of any benchmark item."""
    return decontaminate.drop_contaminated(docs, table(spark, sf_dir, "benchmark"))


def mask_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, secrets masked, n_chars as the new text has."""
    clean = secret_crf.redact(docs, secret_crf.learn(docs))
    if "n_chars" not in docs.columns:
        return clean
    return clean.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType)).select(*docs.columns)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every piece of every document with its sequence and offset (workers also serve the other stages, so none keeps its chunks)."""
    return packing.best_fit_pack(docs, keep_chunks=False)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("toxicity", drop_toxic),
    ("near_duplicates", drop_near_duplicates),
    ("decontamination", drop_benchmark_leaks),
    ("secrets", mask_secrets),
    ("packing", pack),
]

#: Learned lexicons, signatures, tagging and tokenizing are beyond SQL; tests/llm compare each stage with a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = f"{scratch_path(spark, 'pipeline')}-{uuid.uuid4().hex}"
    docs = documents(spark, sf_dir)
    for i, (name, stage) in enumerate(STAGES):
        stage(spark, docs, sf_dir).write.parquet(f"{out}/{i}-{name}")
        docs = spark.read.parquet(f"{out}/{i}-{name}")
    return docs

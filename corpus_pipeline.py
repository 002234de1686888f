"""The document pipeline: five stages over `documents`, each on all that the one before kept."""

from __future__ import annotations

import uuid

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from orderflow.llm import bpe, language_id
from orderflow.llm.decontamination import without_leaks
from orderflow.llm.line_dedup import near_lines, without_repeats
from orderflow.llm.minhash_dedup import near_duplicates, without_copies
from orderflow.session import checkpoint_root

#: The columns of `documents`, which all stages but the last return.
COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in which no language is found go: those without text or letters."""
    model = language_id.fit(docs)
    return language_id.with_language(docs, model).select(*COLUMNS)


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of near-equal lines the first stays; a document of which no line stays goes."""
    return without_repeats(docs, near_lines(docs)).select(*COLUMNS)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates stays (five words, 0.8)."""
    return without_copies(docs, near_duplicates(docs, width=5, percent=80)).select(*COLUMNS)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark item go."""
    return without_leaks(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet")).select(*COLUMNS)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of each document, as unsigned 32-bit integers, with digests of ids and decoded text."""
    path = public_tokenizers.path("byte_bpe_50k.json")
    coded = bpe.round_trip(docs, path)
    return coded.select(
        "doc_id",
        (F.octet_length("ids") / 4).cast("bigint").alias("n_tokens"),
        "ids",
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2(F.encode("text", "utf-8"), 256).alias("decoded_sha256"),
    )


STAGES = [
    ("language_id", language),
    ("line_dedup", line_dedup),
    ("near_dedup", near_dedup),
    ("decontamination", decontaminate),
    ("bpe", encode),
]

#: Learned classifiers, similarity joins and a tokenizer are beyond SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over `documents`; each one's result is written and read again by the next."""
    folder = f"{checkpoint_root(spark)}/pipeline-{uuid.uuid4().hex}"
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        stage(spark, docs, sf_dir).write.parquet(f"{folder}/{name}")
        docs = spark.read.parquet(f"{folder}/{name}")
    return STAGES[-1][1](spark, docs, sf_dir)

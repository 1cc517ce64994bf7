"""The corpus pipeline: stages over documents, each written and read again for the next.

A stage takes (spark, docs, sf_dir) and returns the columns of `docs`, but for the last one,
which returns token ids and the text they decode to. `docs` is a table in files.
"""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from oncolake.llm import bpe, decontaminate, language, near_copies, pii
from oncolake.llm.queries import PSEUDONYM_KEY
from oncolake.llm.shared import scratch, table

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in one of the languages that the labelled ones have."""
    return language.in_known_language(docs, language.labelled_sample(docs))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies, that of the smallest id: texts that share 80 %
    of their five-word shingles, found through the places of their fingerprints' bytes."""
    return near_copies.deduplicate(docs).select(docs.columns)


def benchmark_decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a passage of the benchmark."""
    return decontaminate.decontaminate(docs, table(spark, sf_dir, "benchmark"))


def pii_pseudonyms(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with pseudonyms for personal values; the length follows the text."""
    done = pii.pseudonymize(docs, PSEUDONYM_KEY)
    return done.withColumn("n_chars", F.length("text").cast("long")).select(docs.columns)


def byte_bpe(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of each document, their number, and the text that they decode to."""
    path = public_tokenizers.path("byte_bpe_50k.tiktoken")
    return bpe.round_trip(docs, path, public_tokenizers.PATTERN, stable_input=True).select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        "ids",
        F.col("decoded").cast("string").alias("text"),
    )


STAGES: list[tuple[str, Stage]] = [
    ("language_id", language_id),
    ("near_dedup", near_dedup),
    ("benchmark_decontamination", benchmark_decontamination),
    ("pii", pii_pseudonyms),
    ("byte_bpe", byte_bpe),
]

#: Language ID, fingerprints, Feistel pseudonyms and merges have no SQL counterpart.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of `sf_dir`."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        path = scratch(spark, f"pipeline-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return STAGES[-1][1](spark, docs, sf_dir)

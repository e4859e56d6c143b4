"""Corpus pipeline: language identification, near-duplicate removal, benchmark
decontamination, BPE encoding.

Each stage works on everything its predecessor kept, written as Parquet to the
shared folder and read back, so a lost executor never reaches behind a stage.
All stages but the last return the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tripcast.llm import bagminhash, chunk_reuse, decontaminate, language_id
from tripcast.llm.common import Scratch, table


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep documents written in one of the languages that are labelled in
    ``docs``; text without a letter, or in no known language, goes."""
    model = language_id.fit(docs)
    return language_id.predict(docs, model).filter(language_id.accepted()).select(*docs.columns)


def remove_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep the document with the smallest id of each near-duplicate class."""
    return bagminhash.one_per_class(docs)


def remove_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop documents that hold a benchmark item within its edit budget."""
    found = decontaminate.scan(docs, table(spark, sf_dir, "benchmark"))
    return found.filter(F.size("matches") == 0).select(*docs.columns)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of each document, and the digest of what they decode to."""
    return chunk_reuse.coded(docs, outputs=("n_tokens", "ids", "decoded_sha256"))


STAGES = [("language_id", identify_language), ("near_dedup", remove_near_duplicates),
          ("decontamination", remove_benchmark), ("bpe", encode)]

ORACLE_SQL = None  # trained and iterative stages; tests/llm holds the result against a brute-force version


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of ``sf_dir``."""
    docs, kept = table(spark, sf_dir, "documents"), Scratch(spark)
    for name, stage in STAGES[:-1]:
        before, kept = kept, Scratch(spark)
        docs = kept.stored(stage(spark, docs, sf_dir), name)
        before.drop()
    return STAGES[-1][1](spark, docs, sf_dir)

"""A training-data pipeline over ``documents``: quality rules, near-duplicates, secrets, mixing, encoding.

Each stage works on all rows that the one before it kept, handles NULLs, empty tables and further columns as its operator
says, and all but the last return the columns of their input.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tideline.llm import op1_line_frequency as quality
from tideline.llm import op5_poisson_mixing as mixing
from tideline.llm import op6_trigram_secrets as secrets
from tideline.llm import op7_covering_simhash as duplicates
from tideline.llm import op8_wfst_pieces as pieces
from tideline.staging import staging_root

# A line in more than 5 texts of a source goes, however large the source is. (A share of the source would keep it in a large one.)
LIMITS = quality.LineLimits(max_share=0.0)


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the rules, without the lines that many documents of their source share."""
    return quality.apply_line_rules(docs, limits=LIMITS)


def duplicate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates, the one with the smallest id."""
    return duplicates.one_per_group(docs)


def secret_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with found secrets masked."""
    return secrets.redact(docs)


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents repeated by the target rates of their sources, in shuffled order."""
    return mixing.mix(docs, mixing.source_rates(docs)).select(*docs.columns)


def encoding_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every document, and whether they decode to its text."""
    encoded = pieces.encode(docs, pieces.compile_machine(), check="round_trip")
    return encoded.select("doc_id", "lang", "source", "n_chars", F.size("ids").cast("long").alias("n_tokens"), "ids", "round_trip")


STAGES = [
    ("quality rules", quality_stage),
    ("SimHash near-dedup", duplicate_stage),
    ("secret scans", secret_stage),
    ("mixing sources to target weights", mixing_stage),
    ("SentencePiece encoding", encoding_stage),
]
# Fingerprints and shortest paths cannot be expressed in SQL; the stages are tested against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each result is written as Parquet and read again as the next one's documents."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    folder = f"{staging_root(spark)}/{spark.sparkContext.applicationId}/pipeline-{uuid.uuid4().hex}"
    for i, (_, function) in enumerate(STAGES):
        path = f"{folder}/{i}"
        function(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs

"""A training corpus out of raw documents: STAGES in order, each written and read again by the next.

Every stage takes ``(spark, docs, sf_dir)`` and returns documents with all their columns; the
last one returns token ids instead of texts. No stage asks for more than ``doc_id`` and ``text``.
Null texts count as empty; an empty table passes all stages.
"""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from playtide.llm import byte_bpe, exact_dedup, simhash, tiling, toxicity
from playtide.llm.frames import stored, whole_text
from playtide.llm.queries import table, toxicity_network

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]
TOXIC = 0.7  # documents with this score or a higher one go


def not_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose highest window the recurrent network does not call toxic."""
    network = toxicity_network(spark, docs, sf_dir)
    return toxicity.score(docs, network, out="__toxic").where(F.col("__toxic") < TOXIC).drop("__toxic")


def exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of equal texts, the one with the smallest id."""
    return exact_dedup.drop_copies(docs)


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies: five-word shingles, likeness 0.8 or more."""
    return simhash.near_duplicates(docs)


def no_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that don't hold a benchmark item, in whatever order its passages stand."""
    return tiling.drop_contaminated(docs, table(spark, sf_dir, "benchmark"))


def token_ids(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids per document, and SHA-256 of the bytes that they decode to."""
    ranks, pattern = public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN
    coded = byte_bpe.encode(docs.select("doc_id", whole_text().alias("text")), ranks, pattern)
    return byte_bpe.decode(coded, ranks, pattern).select(
        "doc_id", F.size("ids").cast("bigint").alias("n_tokens"), "ids", F.sha2("decoded", 256).alias("decoded_sha256"))


STAGES: list[tuple[str, Stage]] = [
    ("toxicity", not_toxic), ("exact_dedup", exact_copies), ("near_dedup", near_copies),
    ("decontamination", no_benchmark), ("byte_bpe", token_ids),
]

# The first stage is a trained network and the third compares sets, which SQL cannot express.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows of the last stage for the documents of ``sf_dir``."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)

"""The training-data pipeline: documents to token files.

``STAGES`` in order; every function takes (spark, docs, sf_dir) and returns a
DataFrame.  Each but the last returns the columns of ``documents``, and its
decisions take effect: rejected documents, copies and contaminated documents go,
mixed documents come as often as they are taken.  ``run`` writes every stage's
result to the shared folder and reads it again for the next.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from lumenlog.llm import decontaminate, mix, neardup, quality, tokens
from lumenlog.llm.common import scratch, stored, table

#: Similarity of near-duplicates in per cent, on sets of 5-word shingles.
NEAR = 80


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose perplexity passes their language's bar."""
    return quality.accepted(docs, table(spark, sf_dir, "labels"))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates."""
    return neardup.dedup(docs, NEAR)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that share no window with the benchmark."""
    return decontaminate.remove(docs, table(spark, sf_dir, "benchmark"), mode="documents")


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mixture takes them."""
    return mix.mix(docs)


def token_ids(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The token files, read back: a row per document in them."""
    path = scratch(spark, "pipeline-tokens")
    tokens.write_tokens(docs, path, tokens.tokenizer_file())
    return tokens.read_tokens(spark, path)


STAGES = [
    ("quality classifier", quality_classifier),
    ("MinHash near-dedup", near_dedup),
    ("benchmark decontamination", decontamination),
    ("mixing sources to target weights", mixing),
    ("token-ID / binary output", token_ids),
]

#: Neither the model, the components nor the tokenizer can be said in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name.split()[0].lower())
    return STAGES[-1][1](spark, docs, sf_dir)

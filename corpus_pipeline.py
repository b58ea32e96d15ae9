"""A training corpus from raw documents, stage by stage.

Each stage takes all rows that its predecessor kept, as a written table. The
last one returns the tokenised corpus; the others return documents with the
columns they came with.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from attestal.llm import bpe, exact, langid, mixing, near
from attestal.llm.common import stored


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without letters or without a main language go."""
    return langid.with_main_language(docs)


def exact_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts the one with the largest id stays."""
    return exact.exact_dedup(docs).where("kept").select(*docs.columns)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of texts linked over 0.8 on five-word shingles the one with the smallest id stays."""
    return near.drop_near_duplicates(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them: not at all, once or twice."""
    return mixing.mixed_documents(docs)


def tokenize(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, source, n_tokens, ids, and the digests of the ids and of the bytes they decode to."""
    ranks = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    return bpe.encode_decode(docs.select("doc_id", "source", "text"), ranks, public_tokenizers.PATTERN, keep_ids=True)


STAGES = [
    ("language_id", language_id),
    ("exact_dedup", exact_dedup),
    ("near_dedup", near_dedup),
    ("mix_sources", mix_sources),
    ("tokenize", tokenize),
]

#: SQL cannot express mixture inference; the tests hold the pipeline against a plain version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents; each result is written and read again as the next one's input."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)

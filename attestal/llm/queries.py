"""Registered queries of the text operators, each over its whole table."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from attestal.llm import bpe, exact, html, langid, licences, lm, mixing, near, negatives, pii, quality, turns, urls

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(build: Query) -> Query:
    QUERIES[build.__name__] = build
    return build


def _documents(spark: SparkSession, sf: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/documents.parquet")


def _pages(spark: SparkSession, sf: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/pages.parquet")


@query
def op5_mixing(spark: SparkSession, sf: str) -> DataFrame:
    mixed = mixing.mix(_documents(spark, sf).select("doc_id", "text", "source"))
    return mixed.select("doc_id", "size", "source_size", "target", "taken")


@query
def op8_exact_dedup(spark: SparkSession, sf: str) -> DataFrame:
    found = exact.exact_dedup(_documents(spark, sf).select("doc_id", "text"), keep_text=False)
    return found.select("doc_id", "keep_id", "group_size", "kept", "text_sha256")


@query
def op10_near_dedup(spark: SparkSession, sf: str) -> DataFrame:
    found = near.near_duplicates(_documents(spark, sf).select("doc_id", "text"), n=3, similarity=0.85)
    return found.select("doc_id", "n_shingles", "component_id", "kept")


@query
def op7_language_id(spark: SparkSession, sf: str) -> DataFrame:
    return langid.identify(_documents(spark, sf).select("doc_id", "text", "lang"))


@query
def op9_bpe(spark: SparkSession, sf: str) -> DataFrame:
    ranks = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    return bpe.encode_decode(_documents(spark, sf).select("doc_id", "text"), ranks, public_tokenizers.PATTERN)


@query
def op1_pii(spark: SparkSession, sf: str) -> DataFrame:
    return pii.find_pii(_documents(spark, sf).select("doc_id", "text")).drop("text")


@query
def op2_quality(spark: SparkSession, sf: str) -> DataFrame:
    return quality.quality(_documents(spark, sf).select("doc_id", "text", "lang", "source")).drop("lang", "source")


@query
def op3_urls(spark: SparkSession, sf: str) -> DataFrame:
    return urls.filter_urls(_pages(spark, sf).select("page_id", "url")).drop("url")


@query
def op4_html(spark: SparkSession, sf: str) -> DataFrame:
    return html.extract(_pages(spark, sf).select("page_id", "url", "html"))


@query
def op6_lm_scores(spark: SparkSession, sf: str) -> DataFrame:
    return lm.score_documents(_documents(spark, sf).select("doc_id", "text"))


@query
def op11_conversation_repair(spark: SparkSession, sf: str) -> DataFrame:
    rows = turns.damage(spark.read.parquet(f"{sf}/conversations.parquet"))
    return turns.repair(rows, copies=F.col("copies")).drop("turns")


@query
def op12_licence_scan(spark: SparkSession, sf: str) -> DataFrame:
    return licences.scan_licences(_documents(spark, sf).select("doc_id", "text"), keep_text=False).drop("spans")


@query
def op13_hard_negatives(spark: SparkSession, sf: str) -> DataFrame:
    rows = spark.read.parquet(f"{sf}/embeddings.parquet")
    shifted = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    rows = rows.select("vec_id", shifted.cast("int").alias("label"), "embedding")
    return negatives.hard_negatives(rows, F.col("vec_id") % 100 == 0)

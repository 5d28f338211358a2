"""The registered queries of the training-corpus operators, and their DuckDB counterparts."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

import corpus_pipeline
from riskloom.llm import (
    ann,
    bpe,
    collocations,
    jaccard_join,
    license_scan,
    line_dedup,
    mixing,
    packing,
    quality_classifier,
    quality_rules,
    secret_scan,
    sharding,
    spelling,
)

LLM_QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
LLM_ORACLE: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def register(build: Callable[[SparkSession, str], DataFrame]):
        LLM_QUERIES[name] = build
        if sql is not None:
            LLM_ORACLE[name] = sql
        return build
    return register


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/labels.parquet")


@query("op1_quality_rules")
def _(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules.quality_rules(documents(spark, sf_dir), labels(spark, sf_dir))


@query("op2_bpe_round_trip")
def _(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.round_trip(documents(spark, sf_dir), public_tokenizers.path("word_bpe_49k.json"))


@query("op3_kd_tree_sharding")
def _(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.shard_documents(documents(spark, sf_dir))


@query("op4_quality_classifier")
def _(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_classifier.score_quality(documents(spark, sf_dir), labels(spark, sf_dir))


@query("op5_license_scan", license_scan.oracle())
def _(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_scan.scan(license_scan.documents_as_files(documents(spark, sf_dir)))


@query("op6_lexical_packing")
def _(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(documents(spark, sf_dir), public_tokenizers.path("byte_bpe_50k.json"))


@query("op7_hnsw_search")
def _(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ann.nearest(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))


@query("op8_line_dedup", line_dedup.ORACLE)
def _(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_dedup.dedup_pages(spark.read.parquet(f"{sf_dir}/pages.parquet"))


@query("op9_jaccard_join")
def _(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_join.near_groups(documents(spark, sf_dir))


@query("op10_secret_scan")
def _(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secret_scan.scan(documents(spark, sf_dir))


@query("op11_spelling_variants")
def _(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.spelling_variants(documents(spark, sf_dir))


@query("op12_collocations", collocations.ORACLE)
def _(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.collocations(documents(spark, sf_dir))


@query("op13_source_mix")
def _(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mixed(documents(spark, sf_dir))


LLM_QUERIES["pipeline"] = corpus_pipeline.run
if corpus_pipeline.ORACLE_SQL:
    LLM_ORACLE["pipeline"] = corpus_pipeline.ORACLE_SQL

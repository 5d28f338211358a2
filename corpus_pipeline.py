"""From raw documents to packed sequences: the stages of a training corpus, each written and read
again as the input of the next.

Quality rules reject documents, line dedup removes the boilerplate of their sources, of each group
of near copies one document stays, secrets are replaced by a mark, and what remains is packed.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from riskloom.llm import jaccard_join, line_dedup, packing, quality_rules, secret_scan
from riskloom.llm.scratch import written


def keep_by_quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return quality_rules.keep_good(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def drop_boilerplate_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    # copies and near copies are still there and would make their own lines boilerplate
    return line_dedup.dedup_documents(docs, by_group=True)


def keep_one_of_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return jaccard_join.one_of_each(docs)


def redact_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return secret_scan.redact(docs)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packing.pack(docs, public_tokenizers.path("byte_bpe_50k.json"))


STAGES = [
    ("quality rules", keep_by_quality_rules),
    ("line dedup", drop_boilerplate_lines),
    ("n-gram Jaccard join", keep_one_of_near_copies),
    ("secret scans", redact_secrets),
    ("packing", pack_sequences),
]

# learned rules, components and tokens are beyond SQL: the tests of the operators hold each stage's
# results against brute force
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The packed pieces of `documents` after all stages."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)

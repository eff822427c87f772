"""A corpus pipeline in stages, each by one operator of daybook.llm."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from daybook.llm import decontamination, jaccard_join, packing, quality_rules, secret_scan
from daybook.llm.batches import stored
from daybook.llm.queries import END_ID, VOCABULARY, benchmark_items
from daybook.llm.registry import prepared


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that no quality rule rejects."""
    prepared(spark)
    return quality_rules.keep_good(docs)


def one_of_each_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates: that with the least id."""
    prepared(spark)
    return jaccard_join.one_of_each_group(docs)


def without_test_items(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no test item."""
    prepared(spark)
    return decontamination.remove_contaminated(docs, benchmark_items(spark, sf_dir))


def without_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents; each secret is replaced by its kind, and n_chars follows."""
    prepared(spark)
    clean = secret_scan.scan_secrets(docs, redact=True)
    changed = F.size("found") > 0
    return clean.withColumn("n_chars", F.when(changed, F.length("text").cast("bigint")).otherwise(F.col("n_chars"))).select(*docs.columns)


def sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of documents with their token ids and their places in training sequences."""
    prepared(spark)
    return packing.pack_documents(docs, public_tokenizers.path(VOCABULARY), END_ID, with_ids=True)


STAGES = [
    ("quality_rules", quality),
    ("near_duplicates", one_of_each_group),
    ("benchmark_decontamination", without_test_items),
    ("secret_scan", without_secrets),
    ("packing", sequences),
]

#: Tokens and similar hashes are beyond SQL; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages in turn, from the table of documents to packed pieces."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)

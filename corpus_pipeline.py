"""The corpus pipeline: quality rules, near copies, repeated passages, packing.

Each stage takes (spark, docs, sf_dir) and gives a DataFrame; all but the last give the columns of
``documents``. Between stages the rows are written as Parquet and read again.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from ticketry.llm.common import shared_folder, small_batches
from ticketry.llm.packing import pack
from ticketry.llm.quality_rules import keep
from ticketry.llm.simhash import one_of_each
from ticketry.llm.substring_dedup import without_repeats


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the base rules and the fences of their language and source."""
    return keep(docs)


def simhash_near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of fingerprints at most three bits apart: the smallest doc_id."""
    small_batches(spark)
    return one_of_each(docs, shingle=3, max_bits=3)


def substring_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the 50-word windows that also start in one with a smaller doc_id."""
    small_batches(spark)
    return without_repeats(docs, window=50)


def best_fit_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document's tokens, packed into sequences of at most 4096."""
    small_batches(spark)
    return pack(docs, capacity=4096)


STAGES = [
    ("quality_rules", quality_rules),
    ("simhash_near_dedup", simhash_near_dedup),
    ("substring_dedup", substring_dedup),
    ("best_fit_packing", best_fit_packing),
]

#: The fingerprints of the second stage are beyond SQL; tests hold run() against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each stage's rows are a table in the shared folder."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    folder = f"{shared_folder(docs)}/pipeline-{uuid.uuid4().hex}"
    for name, stage in STAGES:
        path = f"{folder}/{name}"
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs

"""A training-data pipeline over ``documents``: each stage works on what its predecessor kept.

A stage takes (spark, docs, sf_dir) and returns a DataFrame; all but the last return the columns
of ``documents``. Null and empty texts leave at the first stage, as they are in no language;
repeated rows are one row after the second; an empty table passes through all stages.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from triplens.llm.common import stored
from triplens.llm.exact import fresh_index, keep_first
from triplens.llm.jaccard import keep_one
from triplens.llm.language import identified
from triplens.llm.packing import pack_documents
from triplens.llm.pii import sanitise


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a letter, or that share no n-gram with any language's profile, go."""
    return identified(docs)


def exact_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts the row with the smallest id stays."""
    return keep_first(docs, fresh_index(spark))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each class of near duplicates (five words, 0.8) the document with the smallest id stays."""
    return keep_one(docs)


def pii(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data and words that give it away are replaced; all documents stay."""
    return sanitise(docs)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of token sequences of 1024, as ``op7_packing`` returns them."""
    return pack_documents(docs)


STAGES = [
    ("language_id", language_id),
    ("exact_dedup", exact_dedup),
    ("near_dedup", near_dedup),
    ("pii", pii),
    ("packing", packing),
]

#: SQL can't express learned profiles, disclosure words or tokenisation; tests compare by brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages on ``documents``, each written as Parquet and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), name)
    return docs

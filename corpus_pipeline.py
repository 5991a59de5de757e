"""The corpus pipeline: from raw documents to packed token sequences.

Each stage takes all rows that the one before it kept.  All but the last return
the columns of the documents.  Nulls, repeated rows and empty tables are handled
as the operators' docstrings say.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from topicweave.llm import exact, neardup, packing, pii, quality
from topicweave.scratch import Scratch


def quality_filter(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Without the documents that the quality classifier rejects.

    A null text is scored as an empty one; without labels every document scores
    0.5 and is rejected.  Each row is judged on its own, so repeated ids are no matter.
    """
    return quality.keep_good(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def exact_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group of equal texts: the largest id, of equal ids the last in the files; null is empty."""
    return exact.keep_one(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each class of near-duplicates: the smallest id, of equal ids the first in the files; null is empty."""
    return neardup.keep_one(docs)


def mask_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every row, with the personal data in its text replaced by its kind; null stays null."""
    return pii.mask(docs)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents in sequences of at most 2048 tokens; a null text has its end token only."""
    return packing.pack(docs)


STAGES = [
    ("quality", quality_filter),
    ("exact_dedup", exact_dedup),
    ("near_dedup", near_dedup),
    ("pii", mask_personal_data),
    ("packing", pack_sequences),
]

#: Learning, sketches and token ids are beyond SQL; tests compare each stage with a plain version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The packed pieces; every stage but the last is written to the scratch folder, which replaces its predecessor's."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    scratch = Scratch(spark, "pipeline")
    before = None
    for name, stage in STAGES[:-1]:
        before = docs = scratch.table(stage(spark, docs, sf_dir), name, replaces=before)
    return STAGES[-1][1](spark, docs, sf_dir)

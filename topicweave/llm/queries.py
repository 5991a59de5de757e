"""One query for each operator, over its whole table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from topicweave.llm import bpe, centroids, exact, langid, licenses, neardup, packing, pii, quality, sharding, toxicity, variants, vectors
from topicweave.llm.shared import documents


def op1_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.shard_documents(documents(spark, sf_dir), shards=24)


def op5_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    return langid.predict(documents(spark, sf_dir))


def op6_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neardup.near_duplicates(documents(spark, sf_dir)).drop("_locator")


def op7_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact.deduplicate(documents(spark, sf_dir)).drop("_locator")


def op2_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.score_documents(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/labels.parquet"))


def op3_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.summary(documents(spark, sf_dir))


def op4_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.encode_digests(documents(spark, sf_dir))


def op8_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.score_documents(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/labels.parquet"))


def op9_embeddings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vectors.link(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))


def op10_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(documents(spark, sf_dir))


def op11_centroids(spark: SparkSession, sf_dir: str) -> DataFrame:
    return centroids.cluster(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))


def op12_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan(documents(spark, sf_dir))


def op13_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return variants.group_variants(documents(spark, sf_dir))


QUERIES = {
    f.__name__: f
    for f in (
        op1_sharding, op2_quality, op3_pii, op4_bpe, op5_language, op6_near_dedup, op7_exact_dedup, op8_toxicity,
        op9_embeddings, op10_packing, op11_centroids, op12_licenses, op13_variants,
    )
}

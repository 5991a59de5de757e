"""Corpora, vectors, word lists, dictionaries and saved runs as DataFrames."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from topicweave.sources.records import csv_records

# The strings pandas reads as missing.
MISSING = (
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN",
    "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null",
)

# Parameters used when no tuned ones are saved.
DEFAULT_PARAMETERS = {
    "n_neighbors": 15, "n_components": 10, "min_dist": 0.0, "umap_metric": "cosine",
    "min_cluster_size": 150, "min_samples": 15, "cluster_method": "eom",
}


def read_corpus_csv(
    spark: SparkSession,
    path: str,
    schema: T.StructType | str | None = None,
    pandas_na: bool = True,
    multi_line: bool = True,
) -> DataFrame:
    """A CSV with header, quotes doubled inside quotes, BOM or not.

    Columns are strings, or those of ``schema``.  Fields may hold line breaks, and a
    large file is still read by many tasks (see ``records``); ``multi_line=False``
    saves the second pass where no field does.  Files in partition folders
    (``column=value``) are read whole by one task each.  Lines end with ``\\n`` or
    ``\\r\\n``; line breaks inside fields are kept as they are.
    """
    options = dict(header=True, quote='"', escape='"', encoding="UTF-8", multiLine=multi_line)
    df = spark.read.options(**options).csv(path)
    if multi_line and df.columns and len(spark.read.text(path).columns) == 1:
        strings = T.StructType([T.StructField(c, T.StringType()) for c in df.columns])
        parsed = F.from_csv("record", strings.toDDL(), dict(quote='"', escape='"', multiLine="true"))
        df = csv_records(spark, path).select(parsed.alias("row")).select("row.*")
    if pandas_na:
        df = df.select(
            [F.when(~F.col(f"`{c}`").isin(*MISSING), F.col(f"`{c}`")).alias(c) for c in df.columns]
        )
    if schema is None:
        return df
    fields = T.StructType.fromDDL(schema) if isinstance(schema, str) else schema
    return df.select([F.col(f"`{f.name}`").try_cast(f.dataType).alias(f.name) for f in fields])


def spread(df: DataFrame, key: str) -> DataFrame:
    """``df`` over all cores, by ``key``, if its files give fewer tasks than that.

    A large table has more splits than cores and is left as it is.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores, key) if df.rdd.getNumPartitions() < cores else df


def read_vectors(
    spark: SparkSession, path: str, id_col: str = "doc_id", vec_col: str = "vec"
) -> DataFrame:
    """(doc_id, vec) from a Parquet table."""
    return spark.read.parquet(path).select(
        F.col(id_col).cast("long").alias("doc_id"), F.col(vec_col).alias("vec")
    )


def latest_artifact(spark: SparkSession, folder: str, glob: str = "*") -> str | None:
    """Path of the most recently modified file that matches, or None."""
    files = (
        spark.read.format("binaryFile")
        .option("pathGlobFilter", glob)
        .option("recursiveFileLookup", True)
        .load(folder)
        .select("path", "modificationTime")
    )
    return files.agg(F.max_by("path", F.struct("modificationTime", "path"))).first()[0]


def read_word_list(spark: SparkSession, path: str, distinct: bool = True) -> DataFrame:
    """(word): one per line, trimmed, without blank lines and ``#`` comments."""
    lines = spark.read.text(path).select(F.regexp_replace("value", r"(?U)^[\s\x1c-\x1f﻿]+|[\s\x1c-\x1f]+$", "").alias("word"))
    lines = lines.where((F.char_length("word") > 0) & ~F.col("word").startswith("#"))
    return lines.distinct() if distinct else lines


def read_user_dict(spark: SparkSession, path: str, default_tag: str = "NNP") -> DataFrame:
    """(term, tag) from a tab-separated file; a missing tag is a proper noun's, and quotes are letters."""
    rows = spark.read.schema("term string, tag string").option("sep", "\t").option("quote", "").csv(path)
    return rows.where(F.col("term").isNotNull() & ~F.col("term").startswith("#")).select(
        F.trim("term").alias("term"), F.coalesce(F.trim("tag"), F.lit(default_tag)).alias("tag")
    )


def load_tuned_config(spark: SparkSession, folder: str) -> dict:
    """Parameters of the newest tuned configuration, or the defaults."""
    try:
        path = latest_artifact(spark, folder, "part-*.json")
    except Exception as e:  # the folder may not exist yet
        if "PATH_NOT_FOUND" not in str(e):
            raise
        path = None
    if path is None:
        return dict(DEFAULT_PARAMETERS)
    row = spark.read.json(path).first()
    return {
        "n_neighbors": row.umap.n_neighbors,
        "n_components": row.umap.n_components,
        "min_dist": row.umap.min_dist,
        "umap_metric": row.umap.metric,
        "min_cluster_size": row.hdbscan.min_cluster_size,
        "min_samples": row.hdbscan.min_samples,
        "cluster_method": row.hdbscan.cluster_selection_method,
    }


def load_topic_model(spark: SparkSession, path: str) -> dict[str, DataFrame]:
    """The tables of a saved model by name."""
    names = ("topic_words", "ctfidf", "doc_topics", "topic_vectors")
    return {name: spark.read.parquet(f"{path}/{name}") for name in names}

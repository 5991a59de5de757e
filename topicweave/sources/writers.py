"""Results as tables and files.

Every run writes below ``run_id=...`` of its output folder, so artifacts of one
run stay together.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def new_run_id(spark: SparkSession) -> str:
    return spark.range(1).select(F.date_format(F.current_timestamp(), "yyyyMMdd_HHmmss")).first()[0]


def _flat(df: DataFrame) -> DataFrame:
    """Nested columns as JSON text, for CSV."""
    nested = (T.ArrayType, T.StructType, T.MapType)
    return df.select(
        [F.to_json(f"`{f.name}`").alias(f.name) if isinstance(f.dataType, nested) else F.col(f"`{f.name}`") for f in df.schema.fields]
    )


def _csv(df: DataFrame, path: str) -> str:
    text_as_is = {"ignoreLeadingWhiteSpace": False, "ignoreTrailingWhiteSpace": False}
    _flat(df).write.options(header=True, quote='"', escape='"', emptyValue="", **text_as_is).csv(path)
    return path


def _json(df: DataFrame, path: str) -> str:
    df.coalesce(1).write.option("ignoreNullFields", False).json(path)  # one row
    return path


def write_vectors(
    vectors: DataFrame, corpus: DataFrame, out: str, run_id: str, **settings
) -> dict[str, str]:
    """Vectors as Parquet, the corpus as CSV, dimension and settings as JSON."""
    from topicweave.operators.encode import embedding_info

    paths = {k: f"{out}/{k}/run_id={run_id}" for k in ("vectors", "metadata", "info")}
    vectors.write.parquet(paths["vectors"])
    _csv(corpus, paths["metadata"])
    written = vectors.sparkSession.read.parquet(paths["vectors"])
    _json(embedding_info(written, timestamp=run_id, **settings), paths["info"])
    return paths


def write_tuning_results(ranked: DataFrame, out: str, run_id: str) -> str:
    """All trials in ranking order; a grid's worth of rows, so one file."""
    return _csv(ranked.coalesce(1), f"{out}/tuning_results/run_id={run_id}")


def tuned_config(best: DataFrame, n_trials: int, run_id: str) -> DataFrame:
    """The best trial as one nested row."""
    return best.select(
        F.lit(run_id).alias("timestamp"),
        F.lit(n_trials).alias("n_trials"),
        F.struct("n_neighbors", "n_components", "min_dist", F.lit("cosine").alias("metric")).alias("umap"),
        F.struct(
            "min_cluster_size",
            "min_samples",
            F.col("cluster_method").alias("cluster_selection_method"),
            F.lit("euclidean").alias("metric"),
        ).alias("hdbscan"),
        F.struct(
            F.col("n_clusters").alias("n_topics"),
            "noise_ratio", "silhouette", "diversity", "coherence", "composite",
        ).alias("best_metrics"),
    )


def write_tuned_config(best: DataFrame, n_trials: int, out: str, run_id: str) -> str:
    return _json(tuned_config(best, n_trials, run_id), f"{out}/tuned_config/run_id={run_id}")


def write_topic_info(info: DataFrame, out: str, run_id: str) -> str:
    return _csv(info.coalesce(1), f"{out}/topic_info/run_id={run_id}")  # topics, not documents


def write_label_prompts(prompts: DataFrame, out: str, run_id: str) -> str:
    path = f"{out}/label_prompts/run_id={run_id}"
    prompts.write.option("ignoreNullFields", False).json(path)
    return path


def write_doc_topics(corpus_with_topics: DataFrame, out: str, run_id: str) -> str:
    return _csv(corpus_with_topics, f"{out}/doc_topics/run_id={run_id}")


def write_run_summary(summary: DataFrame, out: str, run_id: str, **settings) -> str:
    """The summary and the settings; one that is None becomes a null."""
    fixed = [(F.lit(v) if v is not None else F.lit(None).cast("string")).alias(k) for k, v in settings.items()]
    return _json(
        summary.select(F.lit(run_id).alias("timestamp"), "*", *fixed), f"{out}/run_summary/run_id={run_id}"
    )


def save_topic_model(
    path: str,
    topic_words: DataFrame,
    ctfidf: DataFrame,
    doc_topics: DataFrame,
    topic_vectors: DataFrame,
) -> str:
    """A model as Parquet tables in one folder."""
    tables = {
        "topic_words": topic_words, "ctfidf": ctfidf, "doc_topics": doc_topics, "topic_vectors": topic_vectors,
    }
    for name, df in tables.items():
        df.write.parquet(f"{path}/{name}")
    return path

"""The three jobs, from tables to tables and files."""

from __future__ import annotations

import time
from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from topicweave.operators import cluster, corpus as prep, encode, quality, represent, tokens as tok
from topicweave.operators.reduce import reduce_dimensions
from topicweave.operators.tuning import run_trials
from topicweave.scratch import Scratch
from topicweave.sources import readers, writers


def embed(
    corpus: DataFrame,
    load_encoder: Callable | None = None,
    text_column: str = "text",
    id_column: str | None = None,
    verify_column: str | None = None,
    verify_values: Sequence | None = None,
    max_chars: int = 2500,
    batch_size: int = 4,
    normalize: bool = True,
    out: str | None = None,
    **settings,
) -> tuple[DataFrame, DataFrame]:
    """(documents, vectors): verified, non-empty documents with ids, and their vectors.

    Without an encoder words are hashed.  Filters run before the encoder.
    """
    spark = corpus.sparkSession
    rows = prep.filter_verified(corpus, verify_column, verify_values)
    col = prep.resolve_text_column(rows, text_column)
    rows = prep.truncate_text(prep.drop_empty_text(rows, col), col, max_chars)
    scratch = Scratch(spark, "embed")
    docs = scratch.table(prep.with_doc_id(rows, id_column), "docs")
    if load_encoder is None:
        vectors = encode.hash_documents(docs, "text_for_embed", max_chars=max_chars, normalize=normalize)
    else:
        vectors = encode.encode_documents(docs, load_encoder, "text_for_embed", batch_size, max_chars, normalize)
    vectors = scratch.table(vectors, "vectors")
    if out is not None:
        writers.write_vectors(
            vectors, docs, out, writers.new_run_id(spark),
            max_chars=max_chars, batch_size=batch_size, normalize_embeddings=normalize, **settings,
        )
    return docs, vectors


def dealt_out(docs: DataFrame) -> DataFrame:
    """``docs`` over all tasks by ``doc_id``: a filter may have left them in a few of the files they were read from.

    The hash is not that of a join on ``doc_id``: the planner would leave this out for such a join, and then join
    by broadcast, where the files were read.
    """
    spark = docs.sparkSession
    parts = max(spark.sparkContext.defaultParallelism, int(spark.conf.get("spark.sql.shuffle.partitions")))
    return docs.repartition(parts, F.xxhash64("doc_id"))


def tune(
    docs: DataFrame,
    vectors: DataFrame,
    umap_grid: Mapping = quality.UMAP_GRID,
    hdbscan_grid: Mapping = quality.HDBSCAN_GRID,
    target: tuple[int, int] = (20, 50),
    tokenizer: str | Callable = "whitespace",
    text_column: str = "text",
    stopwords=None,
    min_token_len: int = 2,
    min_df: int | float = 5,
    max_df: int | float = 0.95,
    out: str | None = None,
    tokenizer_options: Mapping | None = None,
    **options,
) -> DataFrame:
    """All trials of the grid, best first.

    ``tokenizer_options`` goes to :func:`topicweave.operators.tokens.tokenize`.
    """
    spark = docs.sparkSession
    col = prep.resolve_text_column(docs, text_column)
    texts = dealt_out(prep.fill_missing_text(docs, col))
    tokens = tok.tokenize(texts, tokenizer, col, stopwords, min_token_len, **(tokenizer_options or {}))
    trials = quality.expand_grid(spark, umap_grid, hdbscan_grid)
    metrics = run_trials(
        vectors, tokens.select("doc_id", "tokens"), trials, target, min_df, max_df, **options
    )
    scratch = Scratch(spark, "tune")
    metrics = scratch.table(metrics, "metrics")
    ranked = quality.rank_trials(metrics)
    if out is not None and not metrics.isEmpty():
        run_id = writers.new_run_id(spark)
        writers.write_tuning_results(ranked, out, run_id)
        writers.write_tuned_config(quality.best_trial(metrics), metrics.count(), out, run_id)
    return ranked


@dataclass
class TopicModel:
    doc_topics: DataFrame
    ctfidf: DataFrame
    topic_words: DataFrame
    representative_docs: DataFrame
    topic_vectors: DataFrame
    info: DataFrame
    summary: DataFrame
    prompts: DataFrame | None = None


def describe(
    docs: DataFrame,
    vectors: DataFrame,
    tokens: DataFrame,
    doc_topics: DataFrame,
    scratch: Scratch,
    min_df: int | float = 5,
    max_df: int | float = 0.95,
    representation: Sequence[str] = ("KeyBERT", "MMR"),
    mode: str = "parallel",
    mmr_diversity: float = 0.3,
    models: Mapping[str, represent.RepresentationModel] | None = None,
    word_vectors: Callable[[DataFrame], DataFrame] | None = None,
    prompt: str | None = None,
    text_column: str = "text",
) -> TopicModel:
    """The words, documents and report of given topics.

    ``word_vectors`` turns candidates into ``(word, vec)``, for instance with
    the encoder of the documents; by default a word is the mean of the
    documents that hold it.  ``models`` adds or replaces representation models.
    ``prompt`` is the template of the label prompts, filled with words and
    documents of each topic; without one there are none.
    """
    counts = represent.topic_term_counts(tokens, doc_topics)
    scores = scratch.table(
        represent.ctfidf(scratch.table(represent.filter_vocabulary(counts, min_df, max_df), "counts")), "ctfidf"
    )
    reps = scratch.table(represent.representative_docs(tokens, doc_topics, scores, 4), "reps")
    centers = scratch.table(represent.topic_vectors(reps, vectors), "centers")
    candidates = represent.top_words(scores, 100)
    make = word_vectors or (lambda c: represent.centroid_word_vectors(tokens, vectors, c))
    of_words = scratch.table(make(candidates), "word_vectors")
    known = {
        "KeyBERT": lambda c: represent.keybert_words(c, of_words, centers),
        "MMR": lambda c: represent.mmr_words(c, of_words, centers, mmr_diversity),
        **(models or {}),
    }
    topic_words = scratch.table(
        represent.represent(scores, known, representation, mode), "topic_words"
    )
    info = represent.topic_info(doc_topics, topic_words, reps.where("rank <= 3"))
    prompts = None
    if prompt is not None:
        col = prep.resolve_text_column(docs, text_column)
        prompts = scratch.table(represent.label_prompts(topic_words, reps, docs, prompt, col), "prompts")
    return TopicModel(
        doc_topics, scores, topic_words, reps, centers, info, represent.run_summary(doc_topics), prompts
    )


def model(
    docs: DataFrame,
    vectors: DataFrame,
    parameters: Mapping | None = None,
    tuned_dir: str | None = None,
    nr_topics: int | None = None,
    tokenizer: str | Callable = "whitespace",
    text_column: str = "text",
    stopwords=None,
    min_token_len: int = 2,
    out: str | None = None,
    save_model: bool = True,
    n_epochs: int = 200,
    rounds: int = 10,
    knn_method: str = "exact",
    embedding_model: str | None = None,
    tokenizer_options: Mapping | None = None,
    **description,
) -> TopicModel:
    """Reduce, cluster and describe a corpus; write the results below ``out``.

    ``knn_method="ivf"`` searches neighbours in the nearest cells only, which pays
    in many dimensions.  ``tokenizer_options`` goes to
    :func:`topicweave.operators.tokens.tokenize`, ``embedding_model`` to the summary,
    which also tells the seconds from the call to the end of the other outputs.
    """
    begun = time.monotonic()
    spark = docs.sparkSession
    encode.require_alignment(vectors, docs)
    scratch = Scratch(spark, "model")
    col = prep.resolve_text_column(docs, text_column)
    texts = dealt_out(prep.fill_missing_text(docs, col))
    tokens = scratch.table(
        tok.tokenize(texts, tokenizer, col, stopwords, min_token_len, **(tokenizer_options or {})).select("doc_id", "tokens"),
        "tokens",
    )
    saved = readers.load_tuned_config(spark, tuned_dir) if tuned_dir else readers.DEFAULT_PARAMETERS
    p = {**saved, **(parameters or {})}
    reduced = scratch.table(
        reduce_dimensions(
            vectors, p["n_components"], p["n_neighbors"], p["min_dist"], p["umap_metric"],
            n_epochs=n_epochs, rounds=rounds, knn_method=knn_method,
        ),
        "reduced",
    )
    doc_topics = scratch.table(
        cluster.hdbscan(reduced, p["min_cluster_size"], p["min_samples"], p["cluster_method"], knn_method=knn_method), "topics"
    )
    if nr_topics:
        centers = represent.mean_vectors(doc_topics.join(vectors, "doc_id"), "topic")
        doc_topics = scratch.table(cluster.reduce_topics(centers, doc_topics, nr_topics), "topics")
    result = describe(docs, vectors, tokens, doc_topics, scratch, text_column=text_column, **description)
    if out is not None:
        run_id = writers.new_run_id(spark)
        if save_model:
            writers.save_topic_model(
                f"{out}/topic_model/run_id={run_id}",
                result.topic_words, result.ctfidf, doc_topics, result.topic_vectors,
            )
        writers.write_topic_info(result.info, out, run_id)
        writers.write_doc_topics(represent.doc_topics_table(docs, doc_topics), out, run_id)
        if result.prompts is not None:
            writers.write_label_prompts(result.prompts, out, run_id)
        writers.write_run_summary(
            result.summary, out, run_id, **{k: v for k, v in p.items()},
            elapsed_seconds=round(time.monotonic() - begun, 1), embedding_model=embedding_model,
            tokenizer=tokenizer if isinstance(tokenizer, str) else "user",
        )
    return result

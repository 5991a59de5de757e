"""Topics as words: counts, class-based TF-IDF, keyword models, reports."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

import numpy as np
import pandas as pd
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from topicweave.functions.vector import cosine
from topicweave.scratch import Scratch

MAIN = "Main"
# scores that are sent to every worker, instead of the words of all documents to the scores
SHARED_SCORES = 1_000_000


def written(df: DataFrame, name: str) -> DataFrame:
    """The rows as a written table; a table that a job has written already stays as it is."""
    return df if hasattr(df, "_scratch_path") else Scratch(df.sparkSession, name).table(df, name)


def topic_term_counts(
    tokens: DataFrame, doc_topics: DataFrame, lowercase: bool = True
) -> DataFrame:
    """(topic, word, n): how often each word occurs in the documents of a topic."""
    word = F.explode("tokens")
    words = tokens.select("doc_id", "tokens").join(
        doc_topics.select("doc_id", "topic"), "doc_id"
    ).select("topic", word.alias("word"))
    if lowercase:
        words = words.withColumn("word", F.lower("word"))
    return words.groupBy("topic", "word").agg(F.count(F.lit(1)).alias("n"))


def _bound(limit: int | float, units: Column) -> Column:
    """An int is a count, a float a share of all units."""
    return units * limit if isinstance(limit, float) else F.lit(limit)


def filter_vocabulary(
    counts: DataFrame,
    min_df: int | float = 5,
    max_df: int | float = 0.95,
    doc_frequency: DataFrame | None = None,
    n_docs: Column | None = None,
) -> DataFrame:
    """Words whose document frequency lies between the bounds.

    A topic counts as one document, since the vectoriser sees the joined texts
    of a topic.  ``doc_frequency`` (word, df) with ``n_docs`` counts over
    documents instead.  The counts are written first, as they are read several times.
    """
    counts = written(counts, "counts")
    if doc_frequency is not None:
        joined = counts.join(doc_frequency, "word")
        units = n_docs
    else:
        joined = counts.withColumn(
            "df", F.count(F.lit(1)).over(Window.partitionBy("word"))
        )
        units = counts.agg(F.count_distinct("topic")).scalar()
    return joined.where(
        (F.col("df") >= _bound(min_df, units)) & (F.col("df") <= _bound(max_df, units))
    ).drop("df")


def ctfidf(counts: DataFrame) -> DataFrame:
    """(topic, word, n, tf, idf, score) with score = tf * ln(1 + A / f).

    tf is the share of the word in its topic, f its count over all topics and
    A the mean number of words per topic, cut to an integer.  The counts are
    written first, as they are read several times.
    """
    counts = written(counts, "counts")
    totals = counts.groupBy("topic").agg(F.sum("n").alias("words_in_topic"))
    mean_words = totals.agg(F.floor(F.avg("words_in_topic"))).scalar()
    per_word = Window.partitionBy("word")
    return (
        counts.withColumn("f", F.sum("n").over(per_word))
        .join(totals, "topic")
        .withColumn("tf", F.col("n").cast("double") / F.col("words_in_topic"))
        .withColumn("idf", F.log(1 + mean_words.cast("double") / F.col("f")))
        .select("topic", "word", "n", "tf", "idf", (F.col("tf") * F.col("idf")).alias("score"))
    )


def top_words(
    scores: DataFrame, n: int = 10, aspect: str = MAIN, score: str = "score"
) -> DataFrame:
    """(topic, aspect, rank, word, score): the best ``n`` words of each topic."""
    best_first = Window.partitionBy("topic").orderBy(F.desc(score), "word")
    return (
        scores.withColumn("rank", F.row_number().over(best_first))
        .where(F.col("rank") <= n)
        .select("topic", F.lit(aspect).alias("aspect"), "rank", "word", F.col(score).alias("score"))
    )


def representative_docs(
    tokens: DataFrame, doc_topics: DataFrame, scores: DataFrame, n: int = 3, lowercase: bool = True
) -> DataFrame:
    """(topic, rank, doc_id, similarity): documents nearest their topic.

    Nearness is the cosine between the c-TF-IDF vectors of document and topic.  Up to
    ``SHARED_SCORES`` scores go to the documents, whose words then stay where they are.
    """
    scores = written(scores, "scores")
    word = F.lower("word") if lowercase else F.col("word")
    # the counts of one document never leave its row's task: one group per document
    doc_words = (
        tokens.select("doc_id", "tokens")
        .join(doc_topics.select("doc_id", "topic"), "doc_id")
        .select("doc_id", "topic", F.explode("tokens").alias("word"))
        .withColumn("word", word)
        .groupBy("doc_id", "topic", "word")
        .agg(F.count(F.lit(1)).alias("k"))
    )
    length = scores.groupBy("topic").agg(
        F.sqrt(F.sum(F.col("score") * F.col("score"))).alias("topic_norm")
    )
    weight = F.col("k") * F.col("idf")
    known = scores.select("topic", "word", "idf", "score")
    if Scratch.rows(scores) <= SHARED_SCORES:
        known = F.broadcast(known)
    sims = (
        doc_words.join(known, ["topic", "word"])
        .groupBy("topic", "doc_id")
        .agg(
            F.sum(weight * F.col("score")).alias("dot"),
            F.sqrt(F.sum(weight * weight)).alias("doc_norm"),
        )
        .join(length, "topic")
        .where((F.col("doc_norm") > 0) & (F.col("topic_norm") > 0))
        .withColumn("similarity", F.col("dot") / (F.col("doc_norm") * F.col("topic_norm")))
    )
    # equal texts have equal similarity up to the last bits: rank on 9 decimals
    nearest = Window.partitionBy("topic").orderBy(F.desc(F.round("similarity", 9)), "doc_id")
    return (
        sims.withColumn("rank", F.row_number().over(nearest))
        .where(F.col("rank") <= n)
        .select("topic", "rank", "doc_id", "similarity")
    )


def mean_vectors(rows: DataFrame, *keys: str, vec: str = "vec") -> DataFrame:
    """Mean of the vectors per key, summed map-side before the shuffle."""
    mean = Summarizer.mean(array_to_vector(F.col(vec)))
    return rows.groupBy(*keys).agg(vector_to_array(mean).alias(vec))


def centroid_word_vectors(
    tokens: DataFrame, vectors: DataFrame, candidates: DataFrame, lowercase: bool = True
) -> DataFrame:
    """(word, vec): mean vector of the documents that hold the word."""
    wanted = candidates.select("word").distinct()
    distinct = F.array_distinct(
        F.transform("tokens", lambda w: F.lower(w)) if lowercase else F.col("tokens")
    )
    held = (
        tokens.select("doc_id", F.explode(distinct).alias("word"))
        .join(wanted, "word", "left_semi")
        .join(vectors.select("doc_id", "vec"), "doc_id")
    )
    return mean_vectors(held, "word")


def topic_vectors(rep_docs: DataFrame, vectors: DataFrame) -> DataFrame:
    """(topic, vec): mean vector of the representative documents."""
    return mean_vectors(
        rep_docs.select("topic", "doc_id").join(vectors.select("doc_id", "vec"), "doc_id"), "topic"
    )


def keybert_words(
    candidates: DataFrame,
    word_vectors: DataFrame,
    topics: DataFrame,
    n: int = 10,
    aspect: str = "KeyBERT",
) -> DataFrame:
    """Candidate words re-ranked by the cosine between word and topic vector."""
    sims = (
        candidates.select("topic", "word")
        .join(word_vectors.select("word", F.col("vec").alias("word_vec")), "word")
        .join(topics.select("topic", F.col("vec").alias("topic_vec")), "topic")
        .withColumn("score", F.round(cosine(F.col("word_vec"), F.col("topic_vec")), 9))
    )
    return top_words(sims, n, aspect)


def mmr_words(
    candidates: DataFrame,
    word_vectors: DataFrame,
    topics: DataFrame,
    diversity: float = 0.3,
    n: int = 10,
    n_candidates: int = 30,
    aspect: str = "MMR",
) -> DataFrame:
    """Words chosen one by one: near the topic, far from those chosen before.

    A topic's group holds its first ``n_candidates`` words, never documents.
    """
    schema = "topic int, rank int, word string, score double"

    def choose(group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values("rank")
        words = np.stack(group["word_vec"].to_numpy()).astype(float)
        words /= np.maximum(np.linalg.norm(words, axis=1, keepdims=True), 1e-12)
        topic = np.asarray(group["topic_vec"].iloc[0], dtype=float)
        relevance = np.round(words @ topic / max(np.linalg.norm(topic), 1e-12), 9)
        likeness = np.round(words @ words.T, 9)
        chosen = [int(np.argmax(relevance))]
        while len(chosen) < min(n, len(group)):
            gain = (1 - diversity) * relevance - diversity * likeness[:, chosen].max(axis=1)
            gain[chosen] = -np.inf
            chosen.append(int(np.argmax(gain)))
        picked = group.iloc[chosen]
        return pd.DataFrame(
            {
                "topic": picked["topic"].to_numpy(),
                "rank": np.arange(1, len(chosen) + 1),
                "word": picked["word"].to_numpy(),
                "score": relevance[chosen],
            }
        )

    first = candidates.where(F.col("rank") <= n_candidates).select("topic", "rank", "word")
    return (
        first.join(word_vectors.select("word", F.col("vec").alias("word_vec")), "word")
        .join(topics.select("topic", F.col("vec").alias("topic_vec")), "topic")
        .select(F.col("topic").cast("int").alias("topic"), "rank", "word", "word_vec", "topic_vec")
        .groupBy("topic")
        .applyInPandas(choose, schema)
        .select("topic", F.lit(aspect).alias("aspect"), "rank", "word", "score")
    )


RepresentationModel = Callable[[DataFrame], DataFrame]


def represent(
    scores: DataFrame,
    models: Mapping[str, RepresentationModel],
    names: Sequence[str] = ("KeyBERT", "MMR"),
    mode: str = "parallel",
    n: int = 10,
    n_candidates: int = 100,
) -> DataFrame:
    """Topic words of the main representation and of the named models.

    A model takes candidates ``(topic, aspect, rank, word, score)`` and returns
    rows of the same form.  ``parallel`` keeps c-TF-IDF as the main aspect and
    adds one aspect per model; ``chained`` feeds each model the words of the one
    before and the last result is the main aspect.  Names without a model are
    skipped.
    """
    candidates = top_words(scores, n_candidates)
    known = [name for name in names if name in models]
    if mode == "chained":
        words = candidates
        for name in known:
            words = models[name](words)
        return words.where(F.col("rank") <= n).withColumn("aspect", F.lit(MAIN))
    if mode != "parallel":
        raise ValueError(f"unknown mode {mode!r}")
    result = candidates.where(F.col("rank") <= n)
    for name in known:
        result = result.unionByName(models[name](candidates).withColumn("aspect", F.lit(name)))
    return result


def ranked_list(value: str) -> Column:
    """Aggregate: the values of a group in order of ``rank``."""
    return F.transform(
        F.array_sort(F.collect_list(F.struct("rank", value))), lambda r: r[value]
    )


def topic_word_lists(topic_words: DataFrame) -> DataFrame:
    """One row per topic, one list column per aspect."""
    aspects = sorted(r.aspect for r in topic_words.select("aspect").distinct().collect())
    return (
        topic_words.groupBy("topic")
        .pivot("aspect", aspects)
        .agg(ranked_list("word"))
    )


def of_aspect(topic_words: DataFrame, aspect: str = MAIN) -> DataFrame:
    """The words of one aspect; all words if the table has a single, unnamed one."""
    return topic_words.where(F.col("aspect") == aspect) if "aspect" in topic_words.columns else topic_words


def label_prompts(
    topic_words: DataFrame,
    rep_docs: DataFrame,
    corpus: DataFrame,
    template: str,
    text_col: str = "text",
    n_docs: int = 4,
    aspect: str = MAIN,
) -> DataFrame:
    """(topic, prompt): the template with each topic's keywords and documents.

    [DOCUMENTS] and [KEYWORDS] in the template are filled in; the keywords are
    those of one ``aspect``.
    """
    keywords = (
        of_aspect(topic_words, aspect).where(F.col("topic") != -1)
        .groupBy("topic")
        .agg(F.array_join(ranked_list("word"), ", ").alias("keywords"))
    )
    texts = (
        rep_docs.where(F.col("rank") <= n_docs)
        .join(corpus.select("doc_id", F.col(text_col).alias("text")), "doc_id")
        .groupBy("topic")
        .agg(ranked_list("text").alias("texts"))
        .select(
            "topic",
            F.array_join(F.transform("texts", lambda t: F.concat(F.lit("- "), t, F.lit("\n"))), "").alias("documents"),
        )
    )
    filled = F.replace(
        F.replace(F.lit(template), F.lit("[KEYWORDS]"), F.col("keywords")),
        F.lit("[DOCUMENTS]"),
        F.coalesce("documents", F.lit("")),
    )
    return keywords.join(texts, "topic", "left").select("topic", filled.alias("prompt"))


def topic_info(
    doc_topics: DataFrame, topic_words: DataFrame, rep_docs: DataFrame | None = None
) -> DataFrame:
    """One row per topic: Topic, Count, Name, Representation, one column per aspect."""
    counts = doc_topics.groupBy("topic").agg(F.count(F.lit(1)).alias("Count"))
    lists = topic_word_lists(topic_words)
    aspects = [c for c in lists.columns if c not in ("topic", MAIN)]
    info = counts.join(lists, "topic", "left")
    name = F.concat_ws("_", F.col("topic").cast("string"), F.slice(F.col(MAIN), 1, 4))
    columns = [
        F.col("topic").alias("Topic"),
        "Count",
        name.alias("Name"),
        F.col(MAIN).alias("Representation"),
        *aspects,
    ]
    if rep_docs is not None:
        ids = rep_docs.groupBy("topic").agg(ranked_list("doc_id").alias("Representative_Docs"))
        info = info.join(ids, "topic", "left")
        columns.append("Representative_Docs")
    return info.select(*columns).orderBy("Topic")


def doc_topics_table(corpus: DataFrame, doc_topics: DataFrame) -> DataFrame:
    """The corpus with its topic column."""
    return corpus.join(doc_topics.select("doc_id", "topic"), "doc_id")


def run_summary(doc_topics: DataFrame) -> DataFrame:
    """One row: documents, topics, outliers and their percentage."""
    outlier = F.col("topic") == -1
    return doc_topics.agg(
        F.count(F.lit(1)).alias("n_documents"),
        F.count_distinct(F.when(~outlier, F.col("topic"))).alias("n_topics"),
        F.count_if(outlier).alias("n_outliers"),
        F.round(F.avg(F.when(outlier, 100.0).otherwise(0.0)), 1).alias("pct_outliers"),
    )

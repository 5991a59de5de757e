"""Operator inputs derived from the test tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from topicweave.operators import represent, tokens as tok
from topicweave.sources.readers import read_vectors, spread

# a short stopword list in the languages of the test documents
STOPWORDS = ["the", "and", "of", "to", "in", "that", "for", "with", "der", "die", "und", "les", "des"]


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def documents(spark: SparkSession, sf: str) -> DataFrame:
    return spread(table(spark, sf, "documents"), "doc_id")


def vectors(spark: SparkSession, sf: str) -> DataFrame:
    return read_vectors(spark, f"{sf}/embeddings.parquet", "vec_id", "embedding")


def tokens(spark: SparkSession, sf: str) -> DataFrame:
    docs = documents(spark, sf).select("doc_id", "text")
    return tok.tokenize_whitespace(docs).select("doc_id", "tokens")


def masked(spark: SparkSession, sf: str) -> DataFrame:
    """Documents, some with empty or missing text according to their labels."""
    docs = documents(spark, sf).select("doc_id", "text")
    labels = table(spark, sf, "labels")
    text = (
        F.when(F.col("toxic") == 1, F.lit("")).when(F.col("quality") == 0, F.lit(None)).otherwise(F.col("text"))
    )
    return docs.join(labels, "doc_id", "left").select("doc_id", text.alias("text"), "quality", "toxic")


def doc_topics(spark: SparkSession, sf: str) -> DataFrame:
    """The source of a document as its topic; toxic ones count as noise."""
    docs = documents(spark, sf).select("doc_id", "source")
    labels = table(spark, sf, "labels").select("doc_id", "toxic")
    topic = F.when(F.col("toxic") == 1, -1).otherwise(F.substring("source", 4, 10).cast("int"))
    return docs.join(labels, "doc_id", "left").select("doc_id", topic.alias("topic"))


def label_topics(spark: SparkSession, sf: str) -> DataFrame:
    """The label of a vector as its topic; label 9 counts as noise."""
    label = F.col("label")
    return table(spark, sf, "embeddings").select(
        F.col("vec_id").alias("doc_id"), F.when(label == 9, -1).otherwise(label).alias("topic")
    )


def scores(spark: SparkSession, sf: str) -> DataFrame:
    counts = represent.topic_term_counts(tokens(spark, sf), doc_topics(spark, sf))
    return represent.ctfidf(represent.filter_vocabulary(counts))


def topic_words(spark: SparkSession, sf: str) -> DataFrame:
    return represent.top_words(scores(spark, sf), 10)


def pairs(spark: SparkSession, sf: str) -> DataFrame:
    """Words of the documents with a tag from their spelling."""
    docs = tok.tokenize_none(documents(spark, sf).select("doc_id", "text"))

    def tag(w):
        first, last = F.substring(w, 1, 1), F.substring(w, -1, 1)
        return (
            F.when(first.between("A", "Z"), "NNP")
            .when(last == "s", "XSN")
            .when(F.char_length(w) <= 2, "XPN")
            .when(last.isin("a", "i", "o", "u"), "JKB")
            .when(first.between("a", "e"), "SL")
            .otherwise("NNG")
        )

    return docs.select(
        "doc_id", F.transform("tokens", lambda w: F.struct(w.alias("form"), tag(w).alias("tag"))).alias("pairs")
    )


def dictionaries(spark: SparkSession, sf: str) -> DataFrame:
    """One domain per language, with the sources as terms."""
    return documents(spark, sf).groupBy(F.col("lang").alias("domain"), F.col("source").alias("term")).agg(
        F.min("doc_id").alias("pos")
    ).select("domain", F.lit("np").alias("kind"), "pos", "term")


def benchmark_bigrams(spark: SparkSession, sf: str) -> DataFrame:
    """Neighbouring words of the benchmark texts, joined, as dictionary terms."""
    items = tok.tokenize_none(table(spark, sf, "benchmark").select("item_id", "text"))
    starts = F.when(F.size("tokens") > 1, F.sequence(F.lit(1), F.size("tokens") - 1))
    bigram = F.transform(starts, lambda i: F.array_join(F.slice("tokens", i, 2), ""))
    return items.select(F.explode(bigram).alias("term")).distinct().select(
        F.lit("bench").alias("domain"), F.lit("np").alias("kind"), F.lit(0).cast("long").alias("pos"), "term"
    )


def benchmark_carets(spark: SparkSession, sf: str) -> DataFrame:
    """Long words of the benchmark texts, to be split behind the fourth letter, as caret terms."""
    items = tok.tokenize_none(table(spark, sf, "benchmark").select("item_id", "text"))
    words = items.select(F.explode("tokens").alias("word")).distinct().where("char_length(word) >= 8 and not contains(word, '^')")
    term = F.concat_ws("^", F.substring("word", 1, 4), F.substring("word", 5, 1_000_000))
    return words.select(
        F.lit("bench").alias("domain"), F.lit("cp_caret").alias("kind"), F.lit(0).cast("long").alias("pos"), term.alias("term")
    )


def labelings(spark: SparkSession, sf: str) -> DataFrame:
    """Three labelings of the embedded documents, as three trials."""
    both = documents(spark, sf).select("doc_id", "source", "lang").join(
        label_topics(spark, sf).withColumnRenamed("topic", "label"), "doc_id"
    )
    source = F.substring("source", 4, 10).cast("int")
    lang = F.when(F.col("lang") == "en", 0).when(F.col("lang") == "fr", 1).when(F.col("lang") == "de", 2).otherwise(-1)
    every = F.array(
        *[
            F.struct(F.lit(i).alias("trial_id"), c.cast("int").alias("topic"))
            for i, c in enumerate((source, F.col("label"), lang))
        ]
    )
    return both.select("doc_id", F.inline(every))

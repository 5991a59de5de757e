"""One query per operator, over whole tables."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from catalog import inputs as given
from topicweave.operators import (
    cluster, corpus, dictionary, encode, neighbours, quality, reduce, represent, separation, spanning, tokens as tok,
    tuning,
)
from topicweave.plans import jobs
from topicweave.scratch import Scratch
from topicweave.sources import readers, writers

QUERIES = {}


def query(fn):
    QUERIES[fn.__name__] = fn
    return fn


def six(*names: str):
    return [F.round(n, 6).alias(n) for n in names]


# sources and sinks


@query
def read_corpus_csv(spark: SparkSession, sf: str) -> DataFrame:
    out = Scratch(spark, "csv")
    writers.write_doc_topics(given.masked(spark, sf), out.root, "r")
    schema = "doc_id long, text string, quality int, toxic int"
    return readers.read_corpus_csv(spark, f"{out.root}/doc_topics/run_id=r", schema)


@query
def read_vectors(spark: SparkSession, sf: str) -> DataFrame:
    total = F.aggregate("vec", F.lit(0.0), lambda s, x: s + x.cast("double"))
    return given.vectors(spark, sf).select(
        "doc_id", F.size("vec").cast("long").alias("dim"), F.round(total, 6).alias("total")
    )


@query
def latest_artifact(spark: SparkSession, sf: str) -> DataFrame:
    out = Scratch(spark, "artifacts")
    topics = given.doc_topics(spark, sf)
    for run in ("first", "second"):
        writers.write_run_summary(represent.run_summary(topics), out.root, run)
    path = readers.latest_artifact(spark, out.root, "part-*.json")
    return spark.read.json(path).select("timestamp", "n_documents", "n_topics", "n_outliers")


@query
def check_alignment(spark: SparkSession, sf: str) -> DataFrame:
    vectors = given.vectors(spark, sf)
    repeated = vectors.union(vectors.where("doc_id % 5 = 0"))  # the rows of a second, overlapping run
    return encode.check_alignment(repeated, given.documents(spark, sf))


@query
def read_word_list(spark: SparkSession, sf: str) -> DataFrame:
    out = Scratch(spark, "words")
    words = tok.tokenize_none(given.table(spark, sf, "benchmark")).select(F.explode("tokens").alias("w"))
    lines = words.select(F.explode(F.array(F.concat(F.lit("  "), "w", F.lit(" ")), F.lit("# note"), F.lit(""))).alias("value"))
    lines.write.text(f"{out.root}/list")
    return readers.read_word_list(spark, f"{out.root}/list")


@query
def read_user_dict(spark: SparkSession, sf: str) -> DataFrame:
    out = Scratch(spark, "userdict")
    rows = given.table(spark, sf, "part").select(
        F.when(F.col("p_partkey") == F.col("p_size"), F.col("p_brand"))
        .otherwise(F.concat_ws("\t", "p_brand", F.lit("NNG"))).alias("value")
    )
    rows.write.text(f"{out.root}/dict")
    return readers.read_user_dict(spark, f"{out.root}/dict").groupBy("term", "tag").agg(F.count(F.lit(1)).alias("n"))


@query
def write_vectors(spark: SparkSession, sf: str) -> DataFrame:
    out = Scratch(spark, "vectors")
    docs = given.documents(spark, sf).select("doc_id", "text")
    paths = writers.write_vectors(given.vectors(spark, sf), docs, out.root, "r", max_chars=2500)
    saved = readers.read_corpus_csv(spark, paths["metadata"], "doc_id long, text string")
    dims = readers.read_vectors(spark, paths["vectors"]).select("doc_id", F.size("vec").cast("long").alias("dim"))
    return saved.join(dims, "doc_id").select("doc_id", F.char_length("text").cast("long").alias("n_chars"), "dim")


@query
def embedding_info(spark: SparkSession, sf: str) -> DataFrame:
    info = encode.embedding_info(given.vectors(spark, sf), max_chars=2500, normalize_embeddings=True)
    return info.withColumns({c: F.col(c).cast("long") for c in ("embedding_dim", "max_chars")})


@query
def write_tuning_results(spark: SparkSession, sf: str) -> DataFrame:
    out = Scratch(spark, "results")
    path = writers.write_tuning_results(rank_trials(spark, sf), out.root, "r")
    return readers.read_corpus_csv(
        spark, path, "trial_id int, n_clusters long, noise_ratio double, diversity double, composite double"
    )


@query
def tuned_config(spark: SparkSession, sf: str) -> DataFrame:
    out = Scratch(spark, "config")
    metrics = _measured(spark, sf)
    # the labelings stand for settings: their number and size are the parameters
    best = quality.best_trial(metrics).withColumns({
        "n_neighbors": F.col("trial_id") + 10, "n_components": F.lit(5), "min_dist": F.lit(0.0),
        "min_cluster_size": F.col("n_clusters").cast("int"), "min_samples": F.lit(15), "cluster_method": F.lit("eom"),
    })
    writers.write_tuned_config(best, metrics.count(), out.root, "r")
    loaded = readers.load_tuned_config(spark, f"{out.root}/tuned_config")
    return spark.createDataFrame(
        [(int(loaded["n_neighbors"]), int(loaded["min_cluster_size"]), loaded["cluster_method"])],
        "n_neighbors long, min_cluster_size long, cluster_method string",
    )


@query
def write_topic_info(spark: SparkSession, sf: str) -> DataFrame:
    out = Scratch(spark, "info")
    info = represent.topic_info(given.doc_topics(spark, sf), given.topic_words(spark, sf))
    path = writers.write_topic_info(info, out.root, "r")
    return readers.read_corpus_csv(spark, path, "Topic int, Count long, Name string").withColumnsRenamed(
        {"Topic": "topic", "Count": "count", "Name": "name"}
    )


@query
def write_doc_topics(spark: SparkSession, sf: str) -> DataFrame:
    out = Scratch(spark, "doctopics")
    rows = represent.doc_topics_table(given.documents(spark, sf), given.doc_topics(spark, sf))
    path = writers.write_doc_topics(rows, out.root, "r")
    return readers.read_corpus_csv(spark, path, "doc_id long, text string, lang string, topic int")


@query
def write_run_summary(spark: SparkSession, sf: str) -> DataFrame:
    out = Scratch(spark, "summary")
    path = writers.write_run_summary(
        represent.run_summary(given.doc_topics(spark, sf)), out.root, "r", tokenizer="whitespace"
    )
    return spark.read.json(path).select("timestamp", "n_documents", "n_topics", "n_outliers", "pct_outliers", "tokenizer")


@query
def topic_model_tables(spark: SparkSession, sf: str) -> DataFrame:
    out = Scratch(spark, "model")
    scores, topics = given.scores(spark, sf), given.doc_topics(spark, sf)
    centers = represent.mean_vectors(topics.join(given.vectors(spark, sf), "doc_id"), "topic")
    path = writers.save_topic_model(f"{out.root}/m", represent.top_words(scores), scores, topics, centers)
    saved = readers.load_topic_model(spark, path)
    words = saved["topic_words"].groupBy("topic").agg(F.count(F.lit(1)).alias("n_words"))
    return saved["doc_topics"].groupBy("topic").agg(F.count(F.lit(1)).alias("n_docs")).join(words, "topic")


# corpus


@query
def filter_verified(spark: SparkSession, sf: str) -> DataFrame:
    rows = given.documents(spark, sf).join(given.table(spark, sf, "labels"), "doc_id")
    return corpus.filter_verified(rows, "quality", [1]).select("doc_id", "lang", "quality", "toxic")


@query
def drop_empty_text(spark: SparkSession, sf: str) -> DataFrame:
    rows = given.masked(spark, sf)
    return corpus.drop_empty_text(rows, corpus.resolve_text_column(rows, "body")).select("doc_id", "text")


@query
def truncate_text(spark: SparkSession, sf: str) -> DataFrame:
    return corpus.truncate_text(given.documents(spark, sf)).select("doc_id", "text_for_embed")


@query
def fill_missing_text(spark: SparkSession, sf: str) -> DataFrame:
    return corpus.fill_missing_text(given.masked(spark, sf)).select("doc_id", "text")


@query
def with_doc_id(spark: SparkSession, sf: str) -> DataFrame:
    return corpus.with_doc_id(given.documents(spark, sf).select("lang", "text"))


@query
def missing_text_report(spark: SparkSession, sf: str) -> DataFrame:
    return corpus.missing_text_report(given.masked(spark, sf), "text", "quality", [0, 1])


# tokens


@query
def tokenize_whitespace(spark: SparkSession, sf: str) -> DataFrame:
    rows = tok.tokenize_whitespace(given.documents(spark, sf), "text", given.STOPWORDS, 3)
    return tok.join_tokens(rows).select("doc_id", "document", F.size("tokens").cast("long").alias("n_tokens"))


@query
def tokenize_none(spark: SparkSession, sf: str) -> DataFrame:
    rows = tok.tokenize_none(given.documents(spark, sf))
    return tok.join_tokens(rows).select("doc_id", "document", F.size("tokens").cast("long").alias("n_tokens"))


@query
def filter_tokens(spark: SparkSession, sf: str) -> DataFrame:
    stop = spark.createDataFrame([(w,) for w in given.STOPWORDS], "word string")
    rows = tok.filter_tokens(given.tokens(spark, sf), "tokens", stop, 4)
    return tok.join_tokens(rows).select("doc_id", "document")


@query
def join_tokens(spark: SparkSession, sf: str) -> DataFrame:
    rows = tok.tokenize_whitespace(given.table(spark, sf, "conversations"))
    return tok.join_tokens(rows).select("conv_id", "turn", "document")


@query
def doc_word_sets(spark: SparkSession, sf: str) -> DataFrame:
    rows = tok.filter_tokens(given.tokens(spark, sf), min_len=9)
    return tok.doc_word_sets(rows).select("doc_id", F.array_join(F.array_sort("words"), " ").alias("words"))


@query
def tokenize_user(spark: SparkSession, sf: str) -> DataFrame:
    rows = tok.tokenize(given.documents(spark, sf), lambda text: [w.upper() for w in text.split(",")])
    return rows.select("doc_id", F.size("tokens").cast("long").alias("n_tokens"))


@query
def extract_nouns(spark: SparkSession, sf: str) -> DataFrame:
    rows = tok.extract_nouns(given.pairs(spark, sf), "pairs", ["Thst"], 2)
    return tok.join_tokens(rows).select("doc_id", "document", F.size("tokens").cast("long").alias("n_tokens"))


@query
def combine_nominals(spark: SparkSession, sf: str) -> DataFrame:
    rows = tok.combine_nominals(given.pairs(spark, sf))
    proper = F.filter("pairs", lambda p: p["tag"] == "NNP")
    return rows.select(
        "doc_id",
        F.array_join("pairs.form", " ").alias("forms"),
        F.size("pairs").cast("long").alias("n_pairs"),
        F.size(proper).cast("long").alias("n_proper"),
    )


def _registered(spark: SparkSession, sf: str) -> DataFrame:
    brands = given.table(spark, sf, "part").select(F.col("p_partkey").cast("long").alias("pos"), F.col("p_brand").alias("term"))
    nations = given.table(spark, sf, "nation").select(F.col("n_nationkey").cast("long").alias("pos"), F.col("n_name").alias("term"))
    return dictionary.register_dictionary(given.dictionaries(spark, sf), "en", brands, nations)


@query
def register_dictionary(spark: SparkSession, sf: str) -> DataFrame:
    return _registered(spark, sf)


@query
def list_dictionary_domains(spark: SparkSession, sf: str) -> DataFrame:
    return dictionary.list_dictionary_domains(_registered(spark, sf))


@query
def apply_dictionary(spark: SparkSession, sf: str) -> DataFrame:
    terms = given.benchmark_bigrams(spark, sf).unionByName(given.benchmark_carets(spark, sf))
    rows = dictionary.apply_dictionary(given.pairs(spark, sf), "pairs", terms, "bench")
    return rows.select(
        "doc_id",
        F.size("pairs").cast("long").alias("n_before"),
        F.size("after").cast("long").alias("n_after"),
        F.array_join("after.form", " ").alias("forms"),
    )


# vectors


@query
def hash_documents(spark: SparkSession, sf: str) -> DataFrame:
    rows = encode.hash_documents(given.documents(spark, sf)).select("doc_id", F.posexplode("vec").alias("slot", "x"))
    return rows.where("x <> 0").select("doc_id", F.col("slot").cast("long").alias("slot"), *six("x"))


def _shape_encoder():
    """Text statistics as a stand-in for a model."""
    return lambda texts: np.array([[len(t), t.count(" "), t.count("\n"), t.count("e")] for t in texts], dtype=float)


@query
def encode_documents(spark: SparkSession, sf: str) -> DataFrame:
    rows = encode.encode_documents(given.documents(spark, sf), _shape_encoder, normalize=False)
    names = ("n_chars", "n_spaces", "n_lines", "n_e")
    return rows.select("doc_id", *[F.get("vec", F.lit(i)).cast("long").alias(n) for i, n in enumerate(names)])


@query
def l2_normalize(spark: SparkSession, sf: str) -> DataFrame:
    scaled = given.vectors(spark, sf).withColumn("vec", F.transform("vec", lambda x: x * (F.col("doc_id") + 1)))
    return encode.l2_normalize(scaled).select("doc_id", F.posexplode("vec").alias("pos", "x")).select(
        "doc_id", F.col("pos").cast("long").alias("pos"), *six("x")
    )


@query
def knn_cosine(spark: SparkSession, sf: str) -> DataFrame:
    return neighbours.knn_graph(given.vectors(spark, sf), 15).select("src", "dst", "rank", *six("dist"))


@query
def knn_euclidean(spark: SparkSession, sf: str) -> DataFrame:
    knn = neighbours.knn_graph(given.vectors(spark, sf), 10, "euclidean", cell_rows=128)
    return knn.select("src", "dst", "rank", *six("dist"))


@query
def knn_probed(spark: SparkSession, sf: str) -> DataFrame:
    knn = neighbours.knn_graph(given.vectors(spark, sf), 15, method="ivf", cell_rows=64)
    return knn.select("src", "dst", "rank", *six("dist"))


@query
def fuzzy_strengths(spark: SparkSession, sf: str) -> DataFrame:
    knn = neighbours.knn_graph(given.vectors(spark, sf), 14)
    return reduce.fuzzy_strengths(knn, 15).select("src", "dst", *six("rho"), F.round("sigma", 4).alias("sigma"), F.round("strength", 4).alias("strength"))


@query
def fuzzy_graph(spark: SparkSession, sf: str) -> DataFrame:
    knn = neighbours.knn_graph(given.vectors(spark, sf), 14)
    return reduce.fuzzy_graph(knn, 15).select("src", "dst", F.round("w", 4).alias("w"))


@query
def reduce_dimensions(spark: SparkSession, sf: str) -> DataFrame:
    placed = reduce.reduce_dimensions(given.vectors(spark, sf), n_components=5)
    return placed.select("doc_id", F.size("vec").alias("dim"), F.get("vec", F.lit(0)).alias("first"))


@query
def reduce_linear(spark: SparkSession, sf: str) -> DataFrame:
    placed = reduce.reduce_dimensions(given.vectors(spark, sf), n_components=5, method="pca")
    return placed.select("doc_id", F.size("vec").alias("dim"), F.get("vec", F.lit(0)).alias("first"))


# clustering


def _reach(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame]:
    knn = neighbours.knn_graph(given.vectors(spark, sf), 15, "euclidean")
    return knn, spanning.core_distance(knn, 5)


@query
def core_distance(spark: SparkSession, sf: str) -> DataFrame:
    return _reach(spark, sf)[1].select("id", *six("core"))


@query
def core_distances_of_grid(spark: SparkSession, sf: str) -> DataFrame:
    settings = [r.min_samples for r in quality.expand_grid(spark).select("min_samples").distinct().collect()]
    knn = neighbours.knn_graph(given.vectors(spark, sf), max(settings), "euclidean")
    return spanning.core_distances(knn, settings).select("run", "id", *six("core"))


@query
def mutual_reachability(spark: SparkSession, sf: str) -> DataFrame:
    return spanning.mutual_reachability(*_reach(spark, sf)).select("src", "dst", *six("w"))


@query
def minimum_spanning_forest(spark: SparkSession, sf: str) -> DataFrame:
    forest = spanning.minimum_spanning_forest(spanning.mutual_reachability(*_reach(spark, sf)))
    return forest.select("src", "dst", *six("w"))


@query
def hdbscan(spark: SparkSession, sf: str) -> DataFrame:
    return cluster.hdbscan(given.vectors(spark, sf), min_cluster_size=5, min_samples=3)


@query
def hdbscan_leaf(spark: SparkSession, sf: str) -> DataFrame:
    return cluster.hdbscan(given.vectors(spark, sf), min_cluster_size=5, min_samples=3, method="leaf")


@query
def assign_topics(spark: SparkSession, sf: str) -> DataFrame:
    clusters = given.doc_topics(spark, sf).withColumnRenamed("topic", "cluster")
    return cluster.assign_topics(clusters.where("cluster <> -1"), given.documents(spark, sf))


@query
def cluster_counts(spark: SparkSession, sf: str) -> DataFrame:
    return cluster.cluster_counts(given.labelings(spark, sf), ["trial_id"])


@query
def noise_ratio(spark: SparkSession, sf: str) -> DataFrame:
    return cluster.noise_ratio(given.labelings(spark, sf), ["trial_id"]).select("trial_id", *six("noise_ratio"))


@query
def silhouette(spark: SparkSession, sf: str) -> DataFrame:
    return separation.silhouette(given.vectors(spark, sf), given.label_topics(spark, sf)).select(*six("silhouette"))


@query
def silhouette_of_trials(spark: SparkSession, sf: str) -> DataFrame:
    return separation.silhouette(given.vectors(spark, sf), given.labelings(spark, sf), ["trial_id"]).select("trial_id", *six("silhouette"))


@query
def reduce_topics(spark: SparkSession, sf: str) -> DataFrame:
    topics = given.label_topics(spark, sf)
    centers = represent.mean_vectors(topics.join(given.vectors(spark, sf), "doc_id"), "topic")
    return cluster.reduce_topics(centers, topics, 8)


@query
def reduce_topics_to_four(spark: SparkSession, sf: str) -> DataFrame:
    topics = given.label_topics(spark, sf)
    centers = represent.mean_vectors(topics.join(given.vectors(spark, sf), "doc_id"), "topic")
    return cluster.reduce_topics(centers, topics, 4)


# representation


@query
def topic_term_counts(spark: SparkSession, sf: str) -> DataFrame:
    return represent.topic_term_counts(given.tokens(spark, sf), given.doc_topics(spark, sf))


@query
def filter_vocabulary(spark: SparkSession, sf: str) -> DataFrame:
    counts = represent.topic_term_counts(given.tokens(spark, sf), given.doc_topics(spark, sf))
    return represent.filter_vocabulary(counts)


@query
def filter_vocabulary_by_document(spark: SparkSession, sf: str) -> DataFrame:
    tokens = given.tokens(spark, sf)
    counts = represent.topic_term_counts(tokens, given.doc_topics(spark, sf))
    word = F.explode(F.array_distinct(F.transform("tokens", lambda w: F.lower(w)))).alias("word")
    df = tokens.select(word).groupBy("word").agg(F.count(F.lit(1)).alias("df"))
    n_docs = tokens.agg(F.count(F.lit(1))).scalar()
    return represent.filter_vocabulary(counts, 0.01, 0.5, df, n_docs)


@query
def ctfidf(spark: SparkSession, sf: str) -> DataFrame:
    return given.scores(spark, sf).select("topic", "word", "n", *six("tf", "idf", "score"))


@query
def top_words(spark: SparkSession, sf: str) -> DataFrame:
    return given.topic_words(spark, sf).select("topic", "rank", "word", *six("score"))


@query
def representative_docs(spark: SparkSession, sf: str) -> DataFrame:
    reps = represent.representative_docs(given.tokens(spark, sf), given.doc_topics(spark, sf), given.scores(spark, sf), 3)
    return reps.select("topic", "rank", "doc_id", *six("similarity"))


def _with_word_vectors(spark: SparkSession, sf: str):
    scratch = Scratch(spark, "words")
    tokens, vectors = given.tokens(spark, sf), given.vectors(spark, sf)
    topics = given.doc_topics(spark, sf).join(vectors.select("doc_id"), "doc_id", "left_semi")
    candidates = scratch.table(represent.top_words(given.scores(spark, sf), 30), "candidates")
    words = scratch.table(represent.centroid_word_vectors(tokens, vectors, candidates), "word_vectors")
    centers = scratch.table(represent.mean_vectors(topics.join(vectors, "doc_id"), "topic"), "centers")
    return candidates, words, centers


@query
def keybert_words(spark: SparkSession, sf: str) -> DataFrame:
    return represent.keybert_words(*_with_word_vectors(spark, sf)).select("topic", "rank", "word", *six("score"))


@query
def mmr_words(spark: SparkSession, sf: str) -> DataFrame:
    return represent.mmr_words(*_with_word_vectors(spark, sf)).select("topic", "rank", "word", *six("score"))


@query
def represent_parallel(spark: SparkSession, sf: str) -> DataFrame:
    _, words, centers = _with_word_vectors(spark, sf)
    models = {
        "KeyBERT": lambda c: represent.keybert_words(c, words, centers),
        # a user's own model: the longest candidates
        "Longest": lambda c: represent.top_words(
            c.withColumn("score", F.char_length("word").cast("double")), 5
        ),
    }
    names = ("KeyBERT", "Longest", "Unknown")
    rows = represent.represent(given.scores(spark, sf), models, names, n_candidates=30)
    return rows.select("topic", "aspect", "rank", "word", *six("score"))


@query
def represent_chained(spark: SparkSession, sf: str) -> DataFrame:
    _, words, centers = _with_word_vectors(spark, sf)
    models = {
        "KeyBERT": lambda c: represent.keybert_words(c, words, centers, 20),
        "MMR": lambda c: represent.mmr_words(c, words, centers),
    }
    rows = represent.represent(given.scores(spark, sf), models, mode="chained", n_candidates=30)
    return rows.select(
        "topic", "rank", "word", *six("score")
    )


@query
def label_prompts(spark: SparkSession, sf: str) -> DataFrame:
    scratch = Scratch(spark, "prompts")
    scores = scratch.table(given.scores(spark, sf), "scores")
    reps = represent.representative_docs(given.tokens(spark, sf), given.doc_topics(spark, sf), scores, 4)
    return represent.label_prompts(
        represent.top_words(scores), reps, given.documents(spark, sf), template="[DOCUMENTS]Words: [KEYWORDS]"
    )


@query
def topic_info(spark: SparkSession, sf: str) -> DataFrame:
    info = represent.topic_info(given.doc_topics(spark, sf), given.topic_words(spark, sf))
    return info.select(
        F.col("Topic").alias("topic"), F.col("Count").alias("n"), F.col("Name").alias("name"),
        F.array_join("Representation", " ").alias("words"),
    )


@query
def topic_info_preview(spark: SparkSession, sf: str) -> DataFrame:
    info = represent.topic_info(given.doc_topics(spark, sf), given.topic_words(spark, sf)).limit(10)
    return info.select(F.col("Topic").alias("topic"), F.col("Count").alias("n"))


@query
def doc_topics_table(spark: SparkSession, sf: str) -> DataFrame:
    return represent.doc_topics_table(given.documents(spark, sf), given.doc_topics(spark, sf))


@query
def run_summary(spark: SparkSession, sf: str) -> DataFrame:
    return represent.run_summary(given.doc_topics(spark, sf))


# quality


@query
def topic_diversity(spark: SparkSession, sf: str) -> DataFrame:
    return quality.topic_diversity(given.topic_words(spark, sf)).select(*six("diversity"))


@query
def topic_diversity_aspects(spark: SparkSession, sf: str) -> DataFrame:
    """The main words' diversity in a table that also has another model's words."""
    words = given.topic_words(spark, sf)
    others = words.withColumn("word", F.lit("same")).withColumn("aspect", F.lit("KeyBERT"))
    both = words.withColumn("aspect", F.lit(represent.MAIN)).unionByName(others)
    return quality.topic_diversity(both).select(*six("diversity"))


@query
def topic_coherence(spark: SparkSession, sf: str) -> DataFrame:
    sets = tok.doc_word_sets(given.tokens(spark, sf))
    return quality.topic_coherence(given.topic_words(spark, sf), sets).select(*six("coherence"))


def _measured(spark: SparkSession, sf: str) -> DataFrame:
    scratch = Scratch(spark, "measured")
    embedded = given.documents(spark, sf).join(given.vectors(spark, sf).select("doc_id"), "doc_id", "left_semi")
    tokens = scratch.table(tok.tokenize_whitespace(embedded.select("doc_id", "text")).select("doc_id", "tokens"), "tokens")
    counts = tokens.select("doc_id", F.explode("tokens").alias("word")).groupBy(
        "doc_id", F.lower("word").alias("word")
    ).agg(F.count(F.lit(1)).alias("n"))
    counts = scratch.table(counts, "word_counts")
    metrics = tuning.trial_metrics(
        given.vectors(spark, sf), given.labelings(spark, sf), counts, tok.doc_word_sets(tokens), 1, 0.95
    )
    return scratch.table(quality.with_composite_score(metrics, (8, 15)), "metrics")


METRICS = ("noise_ratio", "silhouette", "diversity", "coherence")


@query
def trial_metrics(spark: SparkSession, sf: str) -> DataFrame:
    return _measured(spark, sf).select("trial_id", "n_clusters", *six(*METRICS))


@query
def composite_score(spark: SparkSession, sf: str) -> DataFrame:
    return _measured(spark, sf).select("trial_id", *six("composite"))


@query
def rank_trials(spark: SparkSession, sf: str) -> DataFrame:
    return quality.rank_trials(_measured(spark, sf)).select("trial_id", "n_clusters", "noise_ratio", "diversity", "composite")


@query
def best_trial(spark: SparkSession, sf: str) -> DataFrame:
    return quality.best_trial(_measured(spark, sf)).select("trial_id", "n_clusters", "composite")


# whole jobs


def _embedded(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame]:
    vectors = given.vectors(spark, sf)
    docs = given.documents(spark, sf).join(vectors.select("doc_id"), "doc_id", "left_semi")
    return docs, vectors.join(docs.select("doc_id"), "doc_id", "left_semi")


@query
def embed_corpus(spark: SparkSession, sf: str) -> DataFrame:
    rows = given.documents(spark, sf).join(given.table(spark, sf, "labels"), "doc_id", "left")
    docs, vectors = jobs.embed(rows.drop("doc_id"), verify_column="quality", verify_values=[1])
    return docs.join(vectors, "doc_id").select("doc_id", "lang", F.size("vec").alias("dim"))


@query
def tune_grid(spark: SparkSession, sf: str) -> DataFrame:
    docs, vectors = _embedded(spark, sf)
    return jobs.tune(
        docs, vectors,
        {"n_neighbors": [10, 15], "n_components": [5], "min_dist": [0.0]},
        {"min_cluster_size": [5, 10], "min_samples": [3, 5], "cluster_method": ["eom"]},
        min_df=1, n_epochs=100, rounds=5,
    )


@query
def topic_model(spark: SparkSession, sf: str) -> DataFrame:
    docs, vectors = _embedded(spark, sf)
    parameters = {"n_components": 5, "min_cluster_size": 5, "min_samples": 3}
    result = jobs.model(docs, vectors, parameters, min_df=1, n_epochs=100, rounds=5)
    return result.info.select("Topic", "Count", "Name")

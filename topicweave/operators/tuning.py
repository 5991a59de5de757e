"""Trials of a parameter grid."""

from __future__ import annotations

from concurrent.futures import Future, ThreadPoolExecutor, as_completed

from pyspark import inheritable_thread_target
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from topicweave.operators.cluster import cluster_counts, cluster_grid, noise_ratio
from topicweave.operators.neighbours import (
    CELL_ROWS, as_distance, assign_cells, collapse_copies, comparable, nearest_points,
)
from topicweave.operators.quality import PARAMETERS, topic_coherence, topic_diversity, with_composite_score
from topicweave.operators.reduce import BUCKET_ROWS, reduce_points
from topicweave.operators.represent import MAIN, SHARED_SCORES
from topicweave.operators.separation import silhouette
from topicweave.operators.tokens import doc_word_sets
from topicweave.scratch import Scratch

# reductions that are clustered and measured side by side: most of these jobs are too small for all workers
AT_ONCE = 3


def all_tasks(spark: SparkSession) -> int:
    """Partitions for work on many more rows than what is shuffled for it."""
    return max(spark.sparkContext.defaultParallelism, int(spark.conf.get("spark.sql.shuffle.partitions")))


def documents_alike(doc_topics: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(doc_id, kind) and (kind, topics): documents of a kind have the same topics in all trials.

    A kind is the smallest of its ids; ``topics`` holds ``(trial_id, topic)``, at most the trials.
    """
    topics = F.sort_array(F.collect_list(F.struct("trial_id", "topic"))).alias("topics")
    of_doc = doc_topics.where(F.col("doc_id").isNotNull()).groupBy("doc_id").agg(topics)
    alike = of_doc.groupBy("topics").agg(F.min("doc_id").alias("kind"))
    return of_doc.join(alike, "topics").select("doc_id", "kind"), alike.select("kind", "topics")


def trial_top_words(
    word_counts: DataFrame,
    doc_topics: DataFrame,
    min_df: int | float,
    max_df: int | float,
    n: int = 10,
    kinds: tuple[DataFrame, DataFrame] | None = None,
) -> DataFrame:
    """(trial_id, topic, aspect, rank, word, score) of many clusterings at once.

    ``word_counts(doc_id, word, n)`` are counted once per document.  They are added up
    for documents that have the same topics in all trials first, and only these sums
    go to the topics of every trial.  ``kinds`` are the ``documents_alike``, if written.
    """
    scratch = Scratch(word_counts.sparkSession, "trial_words")  # what follows reads these tables several times
    kind_of, alike = kinds or documents_alike(doc_topics)
    counts = scratch.table(
        word_counts.join(kind_of, "doc_id").groupBy("kind", "word").agg(F.sum("n").alias("n")), "counts"
    )
    units = (
        counts.select("kind").distinct().join(alike, "kind").select(F.inline("topics"))
        .groupBy("trial_id").agg(F.count_distinct("topic").alias("units"))
    )
    bound = lambda limit: F.col("units") * limit if isinstance(limit, float) else F.lit(limit)
    # by word, so that neither the sums nor the counts over a word take another shuffle
    per_word = Window.partitionBy("trial_id", "word")
    kept = (
        counts.repartition(all_tasks(word_counts.sparkSession), "word")
        .join(alike, "kind").select("word", "n", F.inline("topics"))
        .groupBy("trial_id", "topic", "word")
        .agg(F.sum("n").alias("n"))
        .withColumn("df", F.count(F.lit(1)).over(per_word))
        .withColumn("f", F.sum("n").over(per_word))
        .join(F.broadcast(units), "trial_id")  # one row a trial
        .where((F.col("df") >= bound(min_df)) & (F.col("df") <= bound(max_df)))
    )
    kept = scratch.table(kept, "kept", replaces=counts)
    totals = kept.groupBy("trial_id", "topic").agg(F.sum("n").alias("in_topic"))
    mean = totals.groupBy("trial_id").agg(F.floor(F.avg("in_topic")).alias("mean"))
    scored = (
        kept.join(totals, ["trial_id", "topic"])
        .join(mean, "trial_id")
        .withColumn("score", F.col("n").cast("double") / F.col("in_topic") * F.log(1 + F.col("mean").cast("double") / F.col("f")))
    )
    best_first = Window.partitionBy("trial_id", "topic").orderBy(F.desc("score"), "word")
    return (
        scored.withColumn("rank", F.row_number().over(best_first))
        .where(F.col("rank") <= n)
        .select("trial_id", "topic", F.lit(MAIN).alias("aspect"), "rank", "word", "score")
    )


def run_trials(
    vectors: DataFrame,
    tokens: DataFrame,
    trials: DataFrame,
    target: tuple[int, int] = (20, 50),
    min_df: int | float = 5,
    max_df: int | float = 0.95,
    seed: int = 42,
    knn_method: str = "exact",
    n_epochs: int = 200,
    rounds: int = 10,
    exact_tree: bool = True,
    cell_rows: int = CELL_ROWS,
    bucket_rows: int = BUCKET_ROWS,
    ledger: str | None = None,
) -> DataFrame:
    """Metrics of every trial that gives at least two topics and words.

    The neighbour graph is searched once for the whole grid, each reduction is
    laid out once, and all clusterings of a reduction share one job per step.
    ``AT_ONCE`` reductions are clustered and measured side by side while others are laid out.  Each reduction's trials are entered in a ledger when they are done or have
    failed; a failure costs the trials of its reduction only, and an error is raised
    if nothing is left.  A folder named as ``ledger`` is kept: another run takes what
    it has finished from there and tries the rest again.
    """
    spark = vectors.sparkSession
    scratch = Scratch(spark, "trials")
    book = Ledger(spark, ledger or f"{scratch.root}/ledger")
    done = book.done()
    rows = [r for r in trials.collect() if tuple(r[c] for c in PARAMETERS) not in done]  # the grid
    settings: dict[tuple, list] = {}
    for r in rows:
        settings.setdefault((r.n_neighbors, r.n_components, r.min_dist), []).append(r)
    if not settings:
        return _measured(trials, book, target)
    points, members = collapse_copies(vectors, scratch)
    if members is not None:
        members = scratch.table(members, "members")
    cells = assign_cells(comparable(points.select("id", "vec"), "cosine"), scratch, cell_rows)
    widest = max(r.n_neighbors for r in rows)
    knn = scratch.table(
        nearest_points(cells, widest - 1, scratch, knn_method).withColumn("dist", as_distance(F.col("d2"), "cosine")), "knn"
    )
    tokens = scratch.table(tokens.select("doc_id", "tokens"), "tokens")
    # the words of a document go to one task together, and are counted there
    word_counts = scratch.table(
        tokens.repartition(all_tasks(spark), "doc_id").select("doc_id", F.explode("tokens").alias("word"))
        .groupBy("doc_id", F.lower("word").alias("word"))
        .agg(F.count(F.lit(1)).alias("n")),
        "word_counts",
    )
    word_sets = scratch.table(doc_word_sets(tokens), "word_sets")

    def placed(n_neighbors: int, n_components: int, min_dist: float) -> DataFrame:
        places = reduce_points(
            cells.points.select("id", "vec"), knn, scratch, n_components, n_neighbors, min_dist,
            seed, n_epochs, rounds, bucket_rows,
        )
        if members is None:
            return places.withColumnRenamed("id", "doc_id")
        return scratch.table(members.join(places, "id").select("doc_id", "vec"), "reduced")

    def measured(reduced: DataFrame, group: list) -> DataFrame:
        doc_topics = cluster_grid(
            reduced,
            [(r.trial_id, r.min_cluster_size, r.min_samples, r.cluster_method) for r in group],
            exact_tree=exact_tree,
            cell_rows=cell_rows,
            knn_method=knn_method,
        ).withColumnRenamed("trial", "trial_id")
        own = Scratch(spark, "measured")  # others run beside it
        return own.table(trial_metrics(reduced, doc_topics, word_counts, word_sets, min_df, max_df), "metrics")

    failed = None
    with ThreadPoolExecutor(AT_ONCE) as pool:
        running = {}
        for setting, group in settings.items():
            try:
                running[pool.submit(inheritable_thread_target(measured), placed(*setting), group)] = group
            except Exception as error:  # whatever ends one reduction, the others go on
                lost = Future()
                lost.set_exception(error)
                running[lost] = group
        for future in as_completed(running):  # only this thread writes to the ledger
            own = trials.where(F.col("trial_id").isin([r.trial_id for r in running[future]]))
            try:
                book.enter(own.join(future.result(), "trial_id", "left"))
            except Exception as error:
                book.enter(own, error)
                failed = error
    if failed is not None and not book.done() & {tuple(r[c] for c in PARAMETERS) for r in rows}:
        raise RuntimeError("every reduction of the grid has failed") from failed
    return _measured(trials, book, target)


def _measured(trials: DataFrame, book: Ledger, target: tuple[int, int]) -> DataFrame:
    return with_composite_score(trials.join(book.finished(), PARAMETERS), target)


class Ledger:
    """A folder with a row for every trial of a grid that is done or has failed; rows are only ever added."""

    MEASURES = {"n_clusters": "long", "noise_ratio": "double", "silhouette": "double", "diversity": "double", "coherence": "double"}

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path

    def enter(self, trials: DataFrame, error: Exception | None = None) -> None:
        """Add trials with their measures, null where a trial has too few topics, or with the error that ended them."""
        measures = [
            (F.col(c) if c in trials.columns else F.lit(None)).cast(kind).alias(c) for c, kind in self.MEASURES.items()
        ]
        told = F.lit(None).cast("string") if error is None else F.lit(f"{type(error).__name__}: {error}"[:1000])
        rows = trials.select(*PARAMETERS, F.current_timestamp().alias("entered"), told.alias("error"), *measures)
        rows.write.mode("append").parquet(self.path)

    def rows(self) -> DataFrame:
        try:
            return self.spark.read.parquet(self.path)
        except AnalysisException:  # nothing entered yet
            kinds = ["n_neighbors int", "n_components int", "min_dist double", "min_cluster_size int", "min_samples int"]
            kinds += ["cluster_method string", "entered timestamp", "error string", *(f"{c} {k}" for c, k in self.MEASURES.items())]
            return self.spark.createDataFrame([], ", ".join(kinds))

    def done(self) -> set[tuple]:
        """The parameters of the trials that need not run again: at most the grid."""
        return {tuple(r) for r in self.rows().where("error IS NULL").select(*PARAMETERS).distinct().collect()}

    def finished(self) -> DataFrame:
        """Parameters and measures of the trials with topics, each once."""
        rows = self.rows().where("error IS NULL AND n_clusters IS NOT NULL")
        latest = F.max_by(F.struct(*self.MEASURES), "entered").alias("m")
        return rows.groupBy(*PARAMETERS).agg(latest).select(*PARAMETERS, "m.*")

    def failures(self) -> DataFrame:
        """Parameters and error of the trials that have failed and not been finished since."""
        rows = self.rows()
        failed = rows.where("error IS NOT NULL").groupBy(*PARAMETERS).agg(F.max_by("error", "entered").alias("error"))
        return failed.join(rows.where("error IS NULL").select(*PARAMETERS).distinct(), PARAMETERS, "left_anti")


def trial_metrics(
    reduced: DataFrame,
    doc_topics: DataFrame,
    word_counts: DataFrame,
    word_sets: DataFrame,
    min_df: int | float = 5,
    max_df: int | float = 0.95,
) -> DataFrame:
    """(trial_id, n_clusters, noise_ratio, silhouette, diversity, coherence).

    Trials with fewer than two topics, or without a word left, are dropped.
    """
    by = ["trial_id"]
    counts = cluster_counts(doc_topics, by).where("n_clusters >= 2")
    kept = doc_topics.join(counts.select("trial_id"), "trial_id", "left_semi")
    scratch = Scratch(doc_topics.sparkSession, "trial_metrics")
    kind_of, alike = (scratch.table(df, "kinds") for df in documents_alike(kept))
    kinds = F.broadcast(kind_of) if Scratch.rows(kind_of) <= SHARED_SCORES else kind_of, alike
    words = trial_top_words(word_counts, kept, min_df, max_df, kinds=kinds)
    words = scratch.table(words, "words")  # read by two measures
    return (
        counts.join(noise_ratio(kept, by), by)
        .join(silhouette(reduced, kept, by), by)
        .join(topic_diversity(words, by=by), by)
        .join(topic_coherence(words, word_sets, by=by), by, "left")
        .fillna(0.0, ["coherence"])
    )

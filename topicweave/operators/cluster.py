"""Density clustering, topic labels and their measures."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from topicweave.operators import spanning
from topicweave.operators.blocks import BLOCK_ROWS
from topicweave.operators.hierarchy import (
    NOISE, cluster_members, clusters_of_runs, condensed_hierarchy, gather_cores,
)
from topicweave.operators.merging import groups
from topicweave.operators.neighbours import (
    CELL_ROWS, as_distance, assign_cells, collapse_copies, comparable, nearest_points,
)
from topicweave.operators.spanning import (
    OutsideSearch, core_distances, minimum_spanning_forest, mutual_reachability,
)
from topicweave.scratch import Scratch

# neighbours listed beyond min_samples, so that most lists outlast the first round
SPARE_NEIGHBOURS = 5


def cluster_grid(
    vectors: DataFrame,
    trials: Sequence[tuple[int, int, int, str]],
    metric: str = "euclidean",
    exact_tree: bool = True,
    cell_rows: int = CELL_ROWS,
    block_rows: int = BLOCK_ROWS,
    knn_method: str = "exact",
) -> DataFrame:
    """(trial, doc_id, topic) for trials ``(trial, min_cluster_size, min_samples, method)``.

    One neighbour graph serves all trials, one spanning tree all trials of a
    ``min_samples``, one hierarchy both selection methods.  With ``knn_method="ivf"``
    the lists hold most neighbours only, and core distances and tree follow the lists.
    """
    spark = vectors.sparkSession
    scratch = Scratch(spark, "cluster")
    points, members = collapse_copies(vectors, scratch)
    copies = points.select("id", "copies")
    cells = assign_cells(comparable(points.select("id", "vec"), metric), scratch, cell_rows)
    needed = sorted({t[2] for t in trials})
    k = needed[-1] + SPARE_NEIGHBOURS
    near = nearest_points(cells, k, scratch, knn_method, block_rows=block_rows)
    knn = scratch.table(near.withColumn("dist", as_distance(F.col("d2"), metric)), "knn")
    core = scratch.table(
        core_distances(knn, needed, copies if members is not None else None), "core"
    )
    reach = mutual_reachability(knn, core)
    search = None
    if exact_tree:
        complete = F.when(F.count(F.lit(1)) < k, F.lit(float("inf"))).otherwise(F.max("dist"))
        list_end = knn.groupBy(F.col("src").alias("id")).agg(complete.alias("list_end"))
        search = OutsideSearch(cells, core, list_end, scratch, block_rows)
    forest = minimum_spanning_forest(reach, scratch, search)

    settings = sorted({(t[1], t[2]) for t in trials})
    number = {s: i for i, s in enumerate(settings)}
    sizes = spark.createDataFrame(
        [(i, size, samples) for (size, samples), i in number.items()],
        "run int, min_cluster_size int, samples int",
    )
    per_run = F.broadcast(sizes.select("run", F.col("samples").alias("_s")))
    runs = lambda df: df.withColumnRenamed("run", "_s").join(per_run, "_s").drop("_s")
    weighted = runs(core.join(copies, "id")).select("run", "id", F.col("copies").alias("weight"), "core")
    methods: dict[int, list] = {i: [] for i in number.values()}
    for trial, size, samples, method in trials:
        methods[number[size, samples]].append((trial, method))
    # a run has the points of one core distance
    if Scratch.rows(core) <= spanning.TASK_ROWS * len(needed):
        clusters = clusters_of_runs(runs(forest), weighted, {i: size for (size, _), i in number.items()}, methods)
    else:
        gathered, links = gather_cores(
            runs(forest), weighted, sizes.select("run", "min_cluster_size"), scratch
        )
        nodes, placed = condensed_hierarchy(gathered, links, scratch)
        clusters = cluster_members(nodes, placed, methods, scratch)
    if members is not None:
        clusters = clusters.join(members, "id").select("trial", "doc_id", "cluster")
    else:
        clusters = clusters.withColumnRenamed("id", "doc_id")
    return scratch.table(assign_topics(clusters, vectors.select("doc_id"), [t[0] for t in trials]), "topics")


def hdbscan(
    vectors: DataFrame,
    min_cluster_size: int = 150,
    min_samples: int = 15,
    method: str = "eom",
    metric: str = "euclidean",
    exact_tree: bool = True,
    cell_rows: int = CELL_ROWS,
    block_rows: int = BLOCK_ROWS,
    knn_method: str = "exact",
) -> DataFrame:
    """(doc_id, topic): density clusters, -1 for noise, 0 for the largest."""
    trial = [(0, min_cluster_size, min_samples, method)]
    return cluster_grid(vectors, trial, metric, exact_tree, cell_rows, block_rows, knn_method).select("doc_id", "topic")


def assign_topics(clusters: DataFrame, docs: DataFrame, trials: Sequence[int] | None = None) -> DataFrame:
    """Topic per document: clusters numbered by falling size, -1 without cluster.

    ``clusters(doc_id, cluster)``; with ``trials`` also a ``trial`` column, and
    every document appears in every trial.  Equal sizes go to the smaller id.
    """
    by = [] if trials is None else ["trial"]
    sizes = clusters.where(F.col("cluster") != NOISE).groupBy(*by, "cluster").agg(
        F.count(F.lit(1)).alias("size"), F.min("doc_id").alias("first")
    )
    # topics, not documents
    order = Window.partitionBy(*by).orderBy(F.desc("size"), "first")
    numbered = sizes.select(*by, "cluster", (F.row_number().over(order) - 1).alias("topic"))
    named = clusters.join(numbered, [*by, "cluster"]).select(*by, "doc_id", "topic")
    everyone = docs.select("doc_id")
    if by:
        every = F.explode(F.array(*[F.lit(t) for t in trials])).alias("trial")
        everyone = everyone.select("doc_id", every)
    return everyone.join(named, [*by, "doc_id"], "left").select(
        *by, "doc_id", F.coalesce("topic", F.lit(NOISE)).alias("topic")
    )


def cluster_counts(doc_topics: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Topics without noise."""
    topic = F.when(F.col("topic") != NOISE, F.col("topic"))
    return doc_topics.groupBy(*by).agg(F.count_distinct(topic).alias("n_clusters"))


def noise_ratio(doc_topics: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Share of documents without topic."""
    return doc_topics.groupBy(*by).agg(
        F.avg(F.when(F.col("topic") == NOISE, 1.0).otherwise(0.0)).alias("noise_ratio")
    )


def reduce_topics(
    topic_vectors: DataFrame, doc_topics: DataFrame, nr_topics: int, block_rows: int = BLOCK_ROWS
) -> DataFrame:
    """Merge topics until ``nr_topics`` remain, by average linkage on cosine distance.

    Any number of topics; documents are relabelled by a join.  Topic -1 stays.
    """
    scratch = Scratch(doc_topics.sparkSession, "reduce")
    rows = topic_vectors.where(F.col("topic") != NOISE).select(
        F.col("topic").cast("long").alias("id"), F.col("vec").cast("array<double>").alias("vec")
    )
    merged = groups(rows, nr_topics, scratch, block_rows)
    names = merged.select(F.col("id").cast("int").alias("topic"), F.col("root").alias("cluster"))
    return assign_topics(doc_topics.join(names, "topic").select("doc_id", "cluster"), doc_topics)

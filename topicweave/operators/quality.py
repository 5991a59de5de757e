"""Topic quality: diversity, coherence, composite score, ranking of trials.

Tables of many trials carry a ``trial_id``; name it in ``by``.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from itertools import product

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from topicweave.operators.represent import MAIN, SHARED_SCORES, of_aspect, written
from topicweave.scratch import Scratch

# documents whose words a task packs into bits, the least number of such pieces, pieces that are met together,
# lists of words that meet them, and lists whose bits are held at once inside a task
PIECE_DOCS, LEAST_PIECES, MET_PIECES = 4096, 16, 8
SHARE_LISTS, STRIPE_LISTS = 8192, 256

# Weights of the composite score, the coherence that counts as
# full, and the scores of a topic count inside, near and far from the target.
WEIGHTS = {
    "silhouette": 0.25, "coverage": 0.20, "diversity": 0.25, "coherence": 0.15, "range": 0.15,
}
FULL_COHERENCE = 5.0
IN_RANGE, NEAR_RANGE, OUT_OF_RANGE = 1.0, 0.7, 0.3

# The default grid.
UMAP_GRID = {"n_neighbors": [10, 15, 20], "n_components": [5, 10, 15], "min_dist": [0.0, 0.05]}
HDBSCAN_GRID = {
    "min_cluster_size": [100, 150, 200, 250, 300],
    "min_samples": [10, 15, 20],
    "cluster_method": ["eom"],
}
PARAMETERS = [*UMAP_GRID, *HDBSCAN_GRID]
METRICS = ["noise_ratio", "silhouette", "diversity", "coherence", "composite"]


def topic_diversity(
    topic_words: DataFrame, top_n: int = 10, by: Sequence[str] = (), aspect: str = MAIN
) -> DataFrame:
    """Share of distinct words among all topics' top words; 0 for a single topic.

    Topic -1 gives no words but counts as a topic for the single-topic rule.  Of
    a table with several aspects only ``aspect`` counts.
    """
    topic_words = of_aspect(topic_words, aspect)
    inside = (F.col("topic") != -1) & (F.col("rank") <= top_n)
    word = F.when(inside, F.col("word"))
    share = F.count_distinct(word) / F.count(word)
    several = (F.count_distinct("topic") > 1) & (F.count(word) > 0)
    return topic_words.groupBy(*by).agg(
        F.when(several, share).otherwise(F.lit(0.0)).alias("diversity")
    )


def topic_coherence(
    topic_words: DataFrame,
    doc_word_sets: DataFrame,
    top_n: int = 10,
    by: Sequence[str] = (),
    aspect: str = MAIN,
) -> DataFrame:
    """Mean over topics of the mean of ln((d12 + 1) / (d1 d2 / n + 1)) over word pairs.

    d1, d2 and d12 count documents with the first, the second and both words; n
    counts all documents with words.  Pairs with a word no document holds, and
    topics without pairs, are left out.  Of a table with several aspects only
    ``aspect`` counts.

    A word's documents are bits, packed once for all topics; so there is no row for
    each document and topic that share a word.
    """
    by = list(by)
    top = of_aspect(topic_words, aspect).where((F.col("topic") != -1) & (F.col("rank") <= top_n)).select(
        *by, "topic", "rank", "word"
    )
    doc_word_sets = written(doc_word_sets, "word_sets")
    n_docs = F.lit(Scratch.rows(doc_word_sets))
    scratch = Scratch(doc_word_sets.sparkSession, "coherence")
    words = scratch.table(
        top.where(F.col("word").isNotNull()).select("word").distinct().withColumn("_w", F.monotonically_increasing_id()), "words"
    )
    listed = top.join(words, "word").groupBy(*by, "topic").agg(F.collect_list(F.struct("rank", "_w")).alias("_words"))
    # at most top_n words a list
    lists = scratch.table(listed.withColumn("_list", F.monotonically_increasing_id()), "lists")
    # r1 = r2 counts the documents of a single word
    together = lists.drop("_words").join(_documents_together(doc_word_sets, words, lists, scratch), "_list")
    single = together.where("r1 = r2").select(*by, "topic", F.col("r1").alias("rank"), "d")
    first = single.withColumnsRenamed({"rank": "r1", "d": "d1"})
    second = single.withColumnsRenamed({"rank": "r2", "d": "d2"})
    both = together.where("r1 < r2").withColumnRenamed("d", "d12")
    keys = [*by, "topic"]
    score = F.log(
        (F.coalesce("d12", F.lit(0)) + 1.0) / (F.col("d1").cast("double") * F.col("d2") / n_docs + 1.0)
    )
    per_topic = (
        first.join(second, keys)
        .where("r1 < r2")
        .join(both, [*keys, "r1", "r2"], "left")
        .groupBy(*keys)
        .agg(F.avg(score).alias("coherence"))
    )
    result = per_topic.groupBy(*by).agg(F.coalesce(F.avg("coherence"), F.lit(0.0)).alias("coherence"))
    if not by:
        return result
    return top.select(*by).distinct().join(result, by, "left").fillna(0.0, ["coherence"])


def _documents_together(doc_word_sets: DataFrame, words: DataFrame, lists: DataFrame, scratch: Scratch) -> DataFrame:
    """(_list, r1, r2, d): documents with the words of two ranks ``r1 <= r2`` of a list, without pairs in no document.

    A task packs the words of a bounded number of documents, or looks up a bounded number
    of lists in ``MET_PIECES`` such pieces.
    """
    pieces = max(LEAST_PIECES, -(-Scratch.rows(doc_word_sets) // PIECE_DOCS))
    shares = max(1, -(-Scratch.rows(lists) // SHARE_LISTS))
    asked = F.broadcast(words) if Scratch.rows(words) <= SHARED_SCORES else words
    held = doc_word_sets.select("doc_id", F.explode("words").alias("word")).join(asked, "word").select(
        F.pmod(F.xxhash64("doc_id"), F.lit(pieces)).cast("int").alias("_piece"), "doc_id", "_w"
    )

    def pack(rows: pa.Table) -> pa.Table:
        docs = rows.column("doc_id").combine_chunks().dictionary_encode(null_encoding="encode")
        doc = docs.indices.to_numpy()
        known, word = np.unique(rows.column("_w").to_numpy(), return_inverse=True)
        bits = np.zeros((len(known), -(-len(docs.dictionary) // 64) * 8), dtype=np.uint8)
        np.bitwise_or.at(bits, (word, doc >> 3), np.left_shift(1, doc & 7).astype(np.uint8))
        return pa.table({
            "_piece": rows.column("_piece").slice(0, 1),
            "known": pa.array([known.astype(np.int64).tobytes()], pa.binary()), "bits": pa.array([bits.tobytes()], pa.binary()),
        })

    def look_up(packed: pa.Table, wanted: pa.Table) -> pa.Table:
        number, rank, word = (wanted.column(n).to_numpy() for n in ("_list", "rank", "_w"))
        order = np.lexsort((rank, number))
        number, rank, word = number[order], rank[order], word[order]
        own, of = np.unique(number, return_inverse=True)
        width = int(rank.max(initial=0))
        total = np.zeros((len(own), width + 1, width + 1), dtype=np.int64)
        for row in range(packed.num_rows if len(own) else 0):
            known = np.frombuffer(packed.column("known")[row].as_py(), dtype=np.int64)
            bits = np.frombuffer(packed.column("bits")[row].as_py(), dtype=np.uint64).reshape(len(known), -1)
            place = np.minimum(np.searchsorted(known, word), len(known) - 1)
            here = np.flatnonzero(known[place] == word)
            for start in range(0, len(own), STRIPE_LISTS):
                some = here[slice(*np.searchsorted(of[here], [start, start + STRIPE_LISTS]))]
                if not len(some):
                    continue
                # words of one rank are one word that stands for any of them
                slot = (of[some] - start) * (width + 1) + rank[some]
                slots, first = np.unique(slot, return_index=True)
                docs = np.zeros((min(STRIPE_LISTS, len(own) - start), width + 1, bits.shape[1]), dtype=np.uint64)
                docs.reshape(-1, bits.shape[1])[slots] = np.bitwise_or.reduceat(bits[place[some]], first, axis=0)
                for r in range(1, width + 1):
                    both = np.bitwise_count(docs[:, r, None] & docs[:, r:]).sum(axis=2, dtype=np.int64)
                    total[start : start + len(docs), r, r:] += both
        i, r1, r2 = np.nonzero(total)
        return pa.table({
            "_list": pa.array(own[i].astype(np.int64)), "r1": pa.array(r1.astype(np.int32)), "r2": pa.array(r2.astype(np.int32)),
            "d": pa.array(total[i, r1, r2]),
        })

    packed = scratch.table(
        held.groupBy("_piece").applyInArrow(pack, "_piece int, known binary, bits binary"), "packed"
    )
    each = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    group = F.floor(F.col("_piece") / F.lit(MET_PIECES)).cast("int")
    sent = packed.select(group.alias("_group"), each(shares).alias("_share"), "known", "bits")
    rows = lists.select(
        "_list", F.pmod(F.xxhash64("_list"), F.lit(shares)).cast("int").alias("_share"), F.inline("_words")
    ).where(F.col("rank") >= 1).withColumn("rank", F.col("rank").cast("int"))
    groups = -(-pieces // MET_PIECES)
    keys = ["_group", "_share"]
    found = sent.groupBy(*keys).cogroup(rows.withColumn("_group", each(groups)).groupBy(*keys)).applyInArrow(
        look_up, "_list long, r1 int, r2 int, d long"
    )
    return scratch.table(found.groupBy("_list", "r1", "r2").agg(F.sum("d").alias("d")), "together")


def composite_score(target: tuple[int, int] = (20, 50)) -> Column:
    """Weighted score of a trial's metrics; low coherence has no floor."""
    low, high = target
    n = F.col("n_clusters")
    in_range = (
        F.when(n.between(low, high), IN_RANGE)
        .when((n >= low * 0.5) & (n <= high * 1.5), NEAR_RANGE)
        .otherwise(OUT_OF_RANGE)
    )
    return (
        WEIGHTS["silhouette"] * F.greatest("silhouette", F.lit(0.0))
        + WEIGHTS["coverage"] * (1 - F.col("noise_ratio"))
        + WEIGHTS["diversity"] * F.col("diversity")
        + WEIGHTS["coherence"] * F.least(F.col("coherence") / FULL_COHERENCE, F.lit(1.0))
        + WEIGHTS["range"] * in_range
    )


def with_composite_score(trial_metrics: DataFrame, target: tuple[int, int] = (20, 50)) -> DataFrame:
    return trial_metrics.withColumn("composite", composite_score(target))


def expand_grid(
    spark: SparkSession, umap: Mapping = UMAP_GRID, hdbscan: Mapping = HDBSCAN_GRID
) -> DataFrame:
    """(trial_id, parameters): every combination of the grid, UMAP settings outermost."""
    grid = {**umap, **hdbscan}
    rows = [
        (
            trial, row["n_neighbors"], row["n_components"], float(row["min_dist"]),
            row["min_cluster_size"], row["min_samples"], row["cluster_method"],
        )
        for trial, row in enumerate(dict(zip(grid, values)) for values in product(*grid.values()))
    ]
    return spark.createDataFrame(
        rows,
        "trial_id int, n_neighbors int, n_components int, min_dist double,"
        " min_cluster_size int, min_samples int, cluster_method string",
    )


def rank_trials(trial_metrics: DataFrame) -> DataFrame:
    """Metrics at four decimals, best composite first; ties by the parameters.

    NaN and missing scores come last.
    """
    rounded = trial_metrics.withColumns(
        {m: F.round(m, 4) for m in METRICS if m in trial_metrics.columns}
    )
    ties = [c for c in (*PARAMETERS, "trial_id") if c in trial_metrics.columns]
    known = F.when(~F.isnan("composite"), F.col("composite"))
    return rounded.orderBy(known.desc_nulls_last(), *ties)


def best_trial(trial_metrics: DataFrame) -> DataFrame:
    """The first row of the ranking."""
    return rank_trials(trial_metrics).limit(1)

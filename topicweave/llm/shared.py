"""Helpers that several operators of this package use."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from topicweave.scratch import Scratch


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def remainder(doc_id: Column | str, divisor: int) -> Column:
    """crc32 of the id as text, modulo ``divisor``; a null id counts as empty text."""
    text = F.coalesce((F.col(doc_id) if isinstance(doc_id, str) else doc_id).cast("string"), F.lit(""))
    return (F.crc32(text.cast("binary")) % divisor).cast("int")


def whole(column: str = "text") -> Column:
    """The text, empty where it is null."""
    return F.coalesce(F.col(column), F.lit(""))


def piece(most: int) -> Column:
    """The whole text for learning, or ``most`` characters of a longer one from a place that a hash of the id chooses."""
    at = F.pmod(F.xxhash64("doc_id", F.lit(11)), F.length(whole()) - most + 1) + 1
    return F.when(F.length(whole()) > most, F.substring(whole(), at.cast("int"), F.lit(most))).otherwise(whole())


def apply_batches(
    df: DataFrame, step: Callable[[pa.RecordBatch], pa.RecordBatch], schema: str
) -> DataFrame:
    """Send the rows through ``step``, one Arrow batch at a time."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                yield step(batch)

    return df.mapInArrow(run, schema)


def rank_within(df: DataFrame, keys: list[str], ties: list[str], name: str, rows: int) -> DataFrame:
    """Number the rows of each key from 0 without a gap, whatever the size of a key.

    Every key is split by a digest of ``ties`` into buckets of some 10,000 rows; a
    bucket is numbered on its own and starts at the rows of the buckets before
    it.  Only the counts of the buckets are ordered by key.  ``df`` is evaluated
    twice.  Rows equal in all of ``ties`` are interchangeable.
    """
    buckets = max(16, rows // 10_000)
    digest = F.md5(F.concat_ws("|", *[F.col(c).cast("string") for c in ties]).cast("binary"))
    number = F.conv(F.substring(digest, 1, 13), 16, 10).cast("long")
    salted = df.withColumn("_bucket", (number % buckets).cast("int"))
    before = Window.partitionBy(*keys).orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    starts = (
        salted.groupBy(*keys, "_bucket")
        .agg(F.count(F.lit(1)).alias("_n"))
        .withColumn("_start", F.coalesce(F.sum("_n").over(before), F.lit(0)))
        .drop("_n")
    )
    inside = Window.partitionBy(*keys, "_bucket").orderBy(*ties)
    ranked = salted.withColumn("_inside", F.row_number().over(inside) - 1)
    return (
        ranked.join(starts, [*keys, "_bucket"])
        .withColumn(name, (F.col("_start") + F.col("_inside")).cast("long"))
        .drop("_bucket", "_start", "_inside")
    )


def components(scratch: Scratch, edges: DataFrame) -> DataFrame:
    """``node`` and the smallest node reachable from it, for all ends of ``edges(src, dst)``.

    Each round takes the smallest label among the neighbours and then the label
    of the label, so paths halve; the labels are a written table of each round.
    Grouping takes partial minima first and both joins can be split by the
    planner, so hubs need no special case.  Nodes without edges are not listed.
    """
    both = edges.select("src", "dst").union(edges.select(F.col("dst").alias("src"), F.col("src").alias("dst")))
    both = scratch.table(both.where("src != dst"), "edges")
    labels = scratch.table(
        both.groupBy(F.col("src").alias("node")).agg(F.min("dst").alias("least")).select(
            "node", F.least("node", "least").alias("label")
        ),
        "labels",
    )
    while True:
        told = both.join(labels, both.dst == labels.node).groupBy("src").agg(F.min("label").alias("told"))
        lower = scratch.table(
            labels.join(told, labels.node == told.src, "left").select(
                "node", F.least("label", F.coalesce("told", "label")).alias("label"), F.col("label").alias("old")
            ),
            "lower",
        )
        root = lower.select(F.col("node").alias("_at"), F.col("label").alias("_root"))
        after = scratch.table(
            lower.join(root, lower.label == root._at).select("node", F.least("_root", "label").alias("label"), "old"),
            "labels",
            replaces=labels,
            watch=F.col("label") != F.col("old"),
        )
        scratch.drop(lower)
        labels = after.select("node", "label")
        if not Scratch.watched(after):
            scratch.drop(both)
            return labels.select("node", F.col("label").alias("component"))
        labels._scratch_path = after._scratch_path


def sample_rows(
    docs: DataFrame, by: str, per_key: int, columns: list[str]
) -> list[tuple]:
    """At most ``per_key`` rows of every value of ``by``, chosen by a hash of the id, as driver rows.

    Bound: ``per_key`` times the number of values.  The counts of the values set
    a threshold for the hash, so nearly all unwanted rows go before any shuffle.
    Null values of ``by`` are no class.
    """
    place = F.xxhash64("doc_id", F.lit(7))
    keyed = docs.where(F.col(by).isNotNull()).withColumn("_place", place)
    counts = keyed.groupBy(by).count().collect()
    wanted = None
    for value, n in counts:
        share = min(1.0, (per_key + 4 * per_key**0.5 + 10) / n)
        limit = int(-(2**63) + share * (2**64 - 1)) if share < 1 else 2**63 - 1
        test = (F.col(by) == F.lit(value)) & (F.col("_place") <= F.lit(limit))
        wanted = test if wanted is None else wanted | test
    if wanted is None:
        return []
    order = Window.partitionBy(by).orderBy("_place", "doc_id")
    rows = keyed.where(wanted).withColumn("_n", F.row_number().over(order)).where(F.col("_n") <= per_key)
    return [tuple(r) for r in rows.orderBy(by, "_n").select(*columns).collect()]


@lru_cache(maxsize=8)
def tokenizer_file(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def labelled_texts(
    docs: DataFrame, labels: DataFrame, label: str, per_class: int, max_chars: int, learn: Column
) -> tuple[list[tuple[str, int]], dict[int, int]]:
    """A bounded sample of labelled texts for fitting, and the labelled rows of each class.

    At most ``per_class`` labels of each value, from rows where ``learn`` holds and
    whose document exists; of a text over ``max_chars`` characters as :func:`piece`
    has it.  An id that repeats among the documents gives its largest text once;
    an id labelled with both values counts for both.
    """
    usable = labels.where(learn & F.col("doc_id").isNotNull()).select("doc_id", F.col(label).cast("int").alias("label"))
    usable = usable.where(F.col("label").isin(0, 1)).join(docs.select("doc_id"), "doc_id", "left_semi")
    counts = {int(k): n for k, n in usable.groupBy("label").count().collect()}
    chosen = sample_rows(usable, "label", per_class, ["doc_id", "label"])
    if not chosen:
        return [], counts
    spark = docs.sparkSession
    wanted = F.broadcast(spark.createDataFrame(chosen, "doc_id long, label int"))  # per_class rows a class
    texts = docs.select("doc_id", piece(max_chars).alias("text"))
    one = texts.join(F.broadcast(wanted.select("doc_id").distinct()), "doc_id").groupBy("doc_id").agg(F.max("text").alias("text"))
    rows = one.join(wanted, "doc_id").orderBy("doc_id", "label").select("text", "label").collect()
    return [(r[0], r[1]) for r in rows], counts

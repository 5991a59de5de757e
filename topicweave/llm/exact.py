"""Exact deduplication by a stateful stream.

A stream of (digest, document id, content locator) passes through a keyed
aggregation whose state lies in RocksDB and never expires: for each digest the
row that stays and the number of rows.  Partial aggregates come first, so a text
with a third of all rows costs one row per task.  The state is then read as a
table, and every row that hit an earlier one is compared with the bytes at the
state's content locator.  Rows whose bytes differ in spite of the digest are
grouped by the text itself.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from topicweave.scratch import Scratch

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: State in RocksDB; a batch adds its changes only, and no file takes room it does not use.
STORE = {
    "spark.sql.streaming.stateStore.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
    "spark.sql.streaming.stateStore.rocksdb.allowFAllocate": "false",
    "spark.sql.streaming.minBatchesToRetain": "2",
}


def normalised(text: Column) -> Column:
    """Null as empty; A-Z in lower case and nothing else changed."""
    return F.translate(F.coalesce(text, F.lit("")), UPPER, LOWER)


def sha256(text: Column) -> Column:
    return F.sha2(text.cast("binary"), 256)


def fold_stream(records: DataFrame) -> DataFrame:
    """The stateful step: of a stream of records, the row that stays and the rows of each digest."""
    return records.groupBy("digest").agg(F.max("row").alias("stays"), F.count(F.lit(1)).alias("rows"))


def run_stream(scratch: Scratch, records: DataFrame, batches: int) -> DataFrame:
    """Feed the files of the written ``records`` through :func:`fold_stream`; return the final state."""
    spark = scratch.spark
    files = max(1, len(records.inputFiles()))
    source = (
        spark.readStream.schema(records.schema)
        .option("maxFilesPerTrigger", -(-files // batches))
        .parquet(records._scratch_path)
    )
    checkpoint = f"{scratch.root}/state"
    before = {name: spark.conf.get(name, None) for name in STORE}
    for name, value in STORE.items():
        spark.conf.set(name, value)
    try:
        query = (
            fold_stream(source).writeStream.format("noop").outputMode("update")
            .option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
        )
        query.awaitTermination()
        state = spark.read.format("statestore").load(checkpoint)
        stays, rows = state.schema["value"].dataType.names[:2]
        return scratch.table(
            state.select("key.digest", F.col(f"value.`{stays}`").alias("stays"), F.col(f"value.`{rows}`").alias("rows")),
            "held",
        )
    finally:
        for name, value in before.items():
            if value is None:
                spark.conf.unset(name)
            else:
                spark.conf.set(name, value)


def deduplicate(
    docs: DataFrame, digest: Callable[[Column], Column] = sha256, batches: int = 4, place: str | None = None
) -> DataFrame:
    """For every row: ``doc_id, keep_id, group_size, kept, text_sha256`` and its ``_locator``.

    Of rows with equal normalised texts the one with the largest id stays; null
    ids are smaller than all others, and among rows of one id the later place
    in the files decides, so exactly one row of a group stays.  A null text is
    an empty text.  An empty table gives no rows.  ``docs`` should be read from
    files; their path and row number are the content locator.  Any other frame
    is written to the scratch folder first.  ``place`` names the column where
    :func:`located` has put the locators already; no other column is taken for one.
    """
    scratch = Scratch(docs.sparkSession, "exact")
    rows = narrow(scratch, docs, place)
    text = normalised(F.col("text"))
    row = F.struct("doc_id", "_locator")
    keyed = rows.select(row.alias("row"), sha256(text).alias("text_sha256"), digest(text).alias("digest"))
    records = scratch.table(keyed, "records")
    if not records.inputFiles():
        return records.select(
            F.col("row.doc_id").alias("doc_id"), F.col("row.doc_id").alias("keep_id"), F.lit(0).cast("long").alias("group_size"),
            F.lit(True).alias("kept"), "text_sha256", "row._locator",
        )
    held = run_stream(scratch, records, batches)
    hits = held.where("rows > 1")
    # the bytes of every row that hit, among them those at the content locators of the state
    hit = records.join(hits, "digest").select(F.col("row._locator").alias("_locator"), "digest", F.col("stays._locator").alias("_held"))
    texts = rows.select("_locator", text.alias("bytes")).join(hit, "_locator")
    texts = scratch.table(texts, "hits")
    content = texts.where(F.col("_locator") == F.col("_held")).select("digest", F.col("bytes").alias("held_bytes"))
    met = texts.join(content, "digest").where(F.col("bytes") != F.col("held_bytes"))
    differs = scratch.table(met.select("_locator", "digest", "bytes"), "differs")
    scratch.drop(texts)
    apart = records.join(differs, F.col("row._locator") == differs._locator, "left_semi").withColumn("_locator", F.col("row._locator"))
    apart = apart.join(differs.select("_locator", "bytes"), "_locator")
    groups = apart.groupBy("bytes").agg(F.max("row").alias("_stays"), F.count(F.lit(1)).alias("_rows"))
    apart = apart.select("_locator", "bytes").join(groups, "bytes").select("_locator", "_stays", "_rows")
    gone = differs.groupBy("digest").agg(F.count(F.lit(1)).alias("_gone"))
    out = records.join(held, "digest").join(gone, "digest", "left")
    out = out.withColumn("_locator", F.col("row._locator")).join(apart, "_locator", "left")
    stays = F.coalesce("_stays", "stays")
    return out.select(
        F.col("row.doc_id").alias("doc_id"),
        stays["doc_id"].alias("keep_id"),
        F.coalesce("_rows", F.col("rows") - F.coalesce("_gone", F.lit(0))).cast("long").alias("group_size"),
        (F.col("_locator") == stays["_locator"]).alias("kept"),
        "text_sha256",
        "_locator",
    )


def located(scratch: Scratch, docs: DataFrame) -> tuple[DataFrame, str]:
    """The rows with the file and row number they lie at in one more column, and its name, which is new in every call.

    Only rows read from files, and selected or filtered, have a place; any other frame is written first.
    """
    name = f"_place_{uuid.uuid4().hex}"

    def placed(rows: DataFrame) -> DataFrame:
        lies = rows.metadataColumn("_metadata")  # the hidden one, whatever the table's columns are called
        return rows.withColumn(name, F.struct(lies["file_path"].alias("file"), lies["row_index"].alias("at")))

    try:
        return placed(docs), name
    except AnalysisException:
        return placed(scratch.table(docs, "docs")), name


def narrow(scratch: Scratch, docs: DataFrame, place: str | None) -> DataFrame:
    """``doc_id, text, _locator`` and no other column, from rows whose locators are in ``place`` or in no column yet."""
    if place is None:
        docs, place = located(scratch, docs)
    return docs.select("doc_id", "text", F.col(place).alias("_locator"))


def without(rows: DataFrame, place: str, dropped: DataFrame) -> DataFrame:
    """The rows but for those whose locator is among the ``_locator`` of the ``dropped``."""
    return rows.join(dropped.select(F.col("_locator").alias(place)), place, "left_anti").drop(place)


def keep_one(docs: DataFrame) -> DataFrame:
    """The rows, unchanged, that :func:`deduplicate` keeps."""
    rows, place = located(Scratch(docs.sparkSession, "exact"), docs)
    return without(rows, place, deduplicate(rows, place=place).where("not kept"))

"""Corpus preparation: text column, filters, truncation, document ids."""

from __future__ import annotations

import warnings
from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from topicweave.functions.text import non_empty
from topicweave.scratch import Scratch

# Text column names tried in this order after the preferred one.
TEXT_COLUMNS = ("text", "abstract", "content", "본문")


def resolve_text_column(df: DataFrame, preferred: str = "text") -> str:
    """Name of the first known text column of ``df``."""
    for name in (preferred, *TEXT_COLUMNS):
        if name in df.columns:
            return name
    raise ValueError(f"no text column among {df.columns}")


def filter_verified(
    df: DataFrame, column: str | None, values: Sequence | None = None
) -> DataFrame:
    """Rows whose ``column`` is one of ``values``.

    No column, or one the table lacks, keeps every row.  A column without
    values keeps none.
    """
    if not column or column not in df.columns:
        return df
    if not values:
        warnings.warn(f"no accepted values for {column!r}: every row is dropped", stacklevel=2)
        return df.where(F.lit(False))
    return df.where(F.col(column).isin(list(values)))


def drop_empty_text(df: DataFrame, col: str = "text") -> DataFrame:
    return df.where(non_empty(F.col(col)))


def truncate_text(
    df: DataFrame, col: str = "text", max_chars: int = 2500, out: str = "text_for_embed"
) -> DataFrame:
    """Add the first ``max_chars`` characters as the encoder's input; the text stays whole."""
    return df.withColumn(out, F.substring(F.col(col), 1, max_chars))


def fill_missing_text(df: DataFrame, col: str = "text") -> DataFrame:
    return df.withColumn(col, F.coalesce(F.col(col).cast("string"), F.lit("")))


def missing_text_report(
    df: DataFrame,
    col: str = "text",
    verify_column: str | None = None,
    verify_values: Sequence | None = None,
) -> DataFrame:
    """One row: rows read, rows verified, rows with text, rows removed as empty."""
    verified = F.lit(True)
    if verify_column and verify_column in df.columns:
        verified = F.coalesce(F.col(verify_column).isin(list(verify_values or [])), F.lit(False))
    has_text = verified & non_empty(F.col(col))
    return df.agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.count_if(verified).alias("n_verified"),
        F.count_if(has_text).alias("n_with_text"),
        F.count_if(verified & ~non_empty(F.col(col))).alias("n_empty"),
    )


def with_doc_id(
    df: DataFrame,
    id_column: str | None = None,
    buckets: int | None = None,
    rows_per_task: int = 100_000,
) -> DataFrame:
    """Add ``doc_id``: the given column, or dense numbers in content order.

    The order is that of a digest of the whole row, so the numbers do not
    depend on how the input is split.  ``df`` is read twice and must then hold
    the same rows.  First only digests travel: equal rows are counted map-side,
    and the digests are numbered in equal stretches of their range, one for a
    million different rows unless ``buckets`` says otherwise (digests spread
    evenly, so no sample has to find the stretches).  Then each different row is
    shuffled once, to the first number of its digest, and its copies are written
    out; a row with more than ``rows_per_task`` copies is spread over tasks.  A
    ``doc_id`` that the table has already is kept, as a number.
    """
    if id_column is None and "doc_id" in df.columns:
        id_column = "doc_id"
    if id_column:
        return df.withColumn("doc_id", F.col(id_column).cast("long"))
    scratch = Scratch(df.sparkSession, "doc-id")
    nested = ("array", "map", "struct")
    # columns by name, in one struct: no name of the table can clash with those used here
    named = [F.col("`" + c.replace("`", "``") + "`") for c in df.columns]
    texts = [F.to_json(c) if t.startswith(nested) else c.cast("string") for c, (_, t) in zip(named, df.dtypes)]
    order = F.md5(F.concat_ws("\x1f", *[F.coalesce(t, F.lit("\x00")) for t in texts]))
    # lengths keep apart what only joins to the same text
    told = [F.coalesce(F.concat(F.octet_length(t).cast("string"), F.lit(":"), t), F.lit("-")) for t in texts]
    rows = df.select(
        F.struct(*named).alias("row"), order.alias("digest"), F.unhex(F.sha2(F.concat(*told), 256)).alias("identity")
    )
    copies = scratch.table(rows.groupBy("digest", "identity").agg(F.count(F.lit(1)).alias("n")), "copies")
    n = buckets or 1 + scratch.rows(copies) // 1_000_000
    stretch = F.shiftright(F.conv(F.substring("digest", 1, 8), 16, 10).cast("long") * n, 32)
    copies = copies.withColumn("stretch", stretch)
    # one row a stretch
    starts = copies.groupBy("stretch").agg(F.sum("n").alias("size")).select(
        "stretch", (F.sum("size").over(Window.orderBy("stretch")) - F.col("size")).alias("start")
    )
    within = (
        Window.partitionBy("stretch").orderBy("digest", "identity").rowsBetween(Window.unboundedPreceding, 0)
    )
    firsts = (
        copies.withColumn("before", F.sum("n").over(within) - F.col("n"))
        .join(F.broadcast(starts), "stretch")
        .select("digest", "identity", "n", (F.col("start") + F.col("before")).alias("first"))
    )
    different = rows.groupBy("digest", "identity").agg(F.first("row").alias("row"))
    numbered = scratch.table(
        different.join(firsts, ["digest", "identity"]).select("first", "n", "row"), "numbered"
    )
    scratch.drop(copies)
    few = numbered.where(F.col("n") <= rows_per_task).select(
        F.explode(F.sequence("first", F.col("first") + F.col("n") - 1)).alias("doc_id"), "row"
    )
    chunk = F.sequence(F.col("first"), F.col("first") + F.col("n") - 1, F.lit(rows_per_task))
    many = (
        numbered.where(F.col("n") > rows_per_task)
        .select(F.explode(chunk).alias("chunk"), (F.col("first") + F.col("n")).alias("end"), "row")
        .repartition("chunk")
        .select(
            F.explode(F.sequence("chunk", F.least(F.col("chunk") + rows_per_task, F.col("end")) - 1)).alias("doc_id"), "row"
        )
    )
    return few.unionByName(many).select("doc_id", "row.*")

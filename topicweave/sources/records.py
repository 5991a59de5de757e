"""Records of CSV files whose fields may hold line breaks, read by many tasks a file.

A split of a file does not know whether it begins inside a quoted field.  A first
pass tells for each split what state it ends in after either beginning; a running
composition over the splits of a file gives the state each one begins in; a second
pass joins the lines of a split to records.  Only records that cross the end of a
split travel: their pieces are put together by file.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

# possessive, so that a doubled quote is never read as an end of a field and a beginning
_FIELD = r'(?:"(?:[^"]++|"")*+"[^,]*+|(?!")[^,]*+)'
_FROM_OUTSIDE = re.compile(rf"{_FIELD}(?:,{_FIELD})*+")
_FROM_INSIDE = re.compile(rf'(?:[^"]++|"")*+"[^,]*+(?:,{_FIELD})*+')

WHOLE, OPENING, INNER, CLOSING = 0, 1, 2, 3


def ends_inside(line: str, inside: bool) -> bool:
    """Whether a quoted field is open after ``line``, which began inside of one or not."""
    if '"' not in line:
        return inside
    return not (_FROM_INSIDE if inside else _FROM_OUTSIDE).fullmatch(line)


def _lines(spark: SparkSession, path: str) -> DataFrame:
    """(path, start, line): the lines of each split in their order."""
    return spark.read.option("lineSep", "\n").text(path).select(
        F.col("_metadata.file_path").alias("path"),
        F.col("_metadata.file_block_start").alias("start"),
        F.col("value").alias("line"),
    )


def _split_ends(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(path, start, from_outside, from_inside): how a split ends after either beginning."""
    key, ends = None, None
    for batch in batches:
        for path, start, line in zip(*(batch.column(i).to_pylist() for i in range(3))):
            if (path, start) != key:
                if key:
                    yield _one_row(key, ends)
                key, ends = (path, start), [False, True]
            if line is not None:  # lines without a quote arrive as null: they change nothing
                ends = [ends_inside(line, e) for e in ends]
    if key:
        yield _one_row(key, ends)


def _one_row(key: tuple, ends: list) -> pa.RecordBatch:
    return pa.RecordBatch.from_pydict(
        {"path": [key[0]], "start": pa.array([key[1]], pa.int64()), "from_outside": [ends[0]], "from_inside": [ends[1]]}
    )


def _split_states(lines: DataFrame) -> DataFrame:
    """(path, start, inside, inside_after): one row a split.

    A split either fixes its end, keeps the state or turns it over; the state before a
    split is what the last fixing one left, turned over as often as splits since then do.
    """
    ends = lines.select("path", "start", F.when(F.contains("line", F.lit('"')), F.col("line")).alias("line")).mapInArrow(
        _split_ends, "path string, start long, from_outside boolean, from_inside boolean"
    )
    order = Window.partitionBy("path").orderBy("start")
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    turns = F.col("from_outside") & ~F.col("from_inside")
    turned = ends.withColumn("turned", F.sum(F.when(turns, 1).otherwise(0)).over(order))
    fixed = F.when(
        F.col("from_outside") == F.col("from_inside"),
        F.struct(F.col("from_outside").cast("int").alias("end"), F.col("turned").alias("at")),
    )
    last = turned.withColumn("last", F.last(fixed, ignorenulls=True).over(before)).withColumn(
        "turned", F.coalesce(F.max("turned").over(before), F.lit(0))
    )
    parity = F.coalesce("last.end", F.lit(0)) + F.col("turned") - F.coalesce("last.at", F.lit(0))
    inside = parity % 2 == 1
    return last.select(
        "path", "start", inside.alias("inside"), F.when(inside, F.col("from_inside")).otherwise(F.col("from_outside")).alias("inside_after")
    )


def _records(whole: bool):
    """A function of batches that gives the whole records, or the pieces of those cut by a split's ends."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, inside, begun_inside, first, held = None, False, False, False, []
        out: list[tuple] = []

        def close(kind_if_complete: int) -> None:
            nonlocal begun_inside, first
            kind = CLOSING if begun_inside else kind_if_complete
            text = "\n".join(held)
            # the first record of a file that is not empty is its header
            header = first and kind in (WHOLE, OPENING) and text not in ("", "\r", "﻿")
            if (kind == WHOLE) == whole:
                out.append((*key, kind, header, text))
            if header:
                first = False
            held.clear()
            begun_inside = False

        def leave() -> None:
            if held:
                kind = INNER if begun_inside else OPENING
                header = first and kind == OPENING
                if not whole:
                    out.append((*key, kind, header, "\n".join(held)))
                held.clear()

        for batch in batches:
            for path, start, line, begins_inside in zip(*(batch.column(i).to_pylist() for i in range(4))):
                if (path, start) != key:
                    leave()
                    key, inside, begun_inside, first = (path, start), begins_inside, begins_inside, start == 0
                if start == 0 and first and not held:
                    line = line.removeprefix("﻿")
                held.append(line)
                inside = ends_inside(line, inside)
                if not inside:
                    close(WHOLE)
            if out:
                yield _piece_batch(out)
                out = []
        leave()
        if out:
            yield _piece_batch(out)

    return run


def _piece_batch(rows: list[tuple]) -> pa.RecordBatch:
    path, start, kind, header, text = zip(*rows)
    return pa.RecordBatch.from_arrays(
        [pa.array(path, pa.string()), pa.array(start, pa.int64()), pa.array(kind, pa.int32()),
         pa.array(header, pa.bool_()), pa.array(text, pa.string())],
        ["path", "start", "kind", "header", "text"],
    )


def csv_records(spark: SparkSession, path: str) -> DataFrame:
    """(record): the text of each record but headers and empty lines, line breaks in quoted fields kept.

    A quote opens a field only at the field's beginning; quotes are doubled inside.
    Splits of both passes must be the same, or the job fails.  Sent to all tasks:
    one narrow row a split.  A file whose last field never closes ends in one record.
    """
    lines = _lines(spark, path)
    states = _split_states(lines)
    known = lines.join(F.broadcast(states), ["path", "start"], "left").withColumn(
        "inside", F.coalesce("inside", F.raise_error(F.lit("a split was not there in the first pass")).cast("boolean"))
    )
    pieces = "path string, start long, kind int, header boolean, text string"
    whole = known.select("path", "start", "line", "inside").mapInArrow(_records(True), pieces)
    # only splits with an open end can hold pieces
    cut = known.where(F.col("inside") | F.col("inside_after")).select("path", "start", "line", "inside")
    cut = cut.mapInArrow(_records(False), pieces)
    # a split's closing piece comes before its opening one
    place = F.struct("start", F.when(F.col("kind") == OPENING, 1).otherwise(0).alias("late"))
    order = Window.partitionBy("path").orderBy(place)
    joined = (
        cut.withColumn("record", F.last(F.when(F.col("kind") == OPENING, F.col("start")), ignorenulls=True).over(order))
        .groupBy("path", "record")
        .agg(F.bool_or("header").alias("header"), F.sort_array(F.collect_list(F.struct("start", "text"))).alias("parts"))
        .select("header", F.array_join("parts.text", "\n").alias("text"))
    )
    rows = whole.select("header", "text").unionByName(joined).where(~F.col("header"))
    return rows.select(F.regexp_replace("text", "\r$", "").alias("record")).where(F.col("record") != "")

"""How well topics are apart: the silhouette, from packed blocks of vectors.

Vectors of one topic are packed into blocks of bounded rows, one binary value
each, so a shuffle moves blocks and not rows.  The moments of the topics are a
table of blocks too: no task and no driver holds all of them.  Runs over the same
vectors share blocks, and a pair of vectors is compared once for all of them.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from topicweave.operators.blocks import (
    distance_stripes, distance_sums, distinct_rows, exact_squared, far_from_range, list_column, matrix, slack, squared_distances,
    values,
)
from topicweave.operators.hierarchy import NOISE
from topicweave.scratch import Scratch

# rows of a packed block of vectors, and topics of a packed block of moments
PACKED_ROWS = 1024
PACKED_TOPICS = 1024
# blocks of a topic that are met together, and shares of the blocks that meet them apart from each other
MET_PARTS = 16
SHARES = 16
# of runs that share blocks: groups of blocks that the rows are dealt to, blocks and bytes of a group, and topics
# of a block that are added up by a product
GROUPS = 24
GROUP_BLOCKS = (4, 32)
GROUP_BYTES = 16 << 20
PRODUCT_TOPICS = 64


def silhouette(
    vectors: DataFrame,
    doc_topics: DataFrame,
    by: Sequence[str] = (),
    block_rows: int = PACKED_ROWS,
    block_topics: int = PACKED_TOPICS,
) -> DataFrame:
    """Mean Euclidean silhouette of the documents with a topic; exact.

    0 unless such documents outnumber the topics.  A document needs its mean
    distance to its own topic and to the nearest other one.  The mean distance
    to a topic lies between the distance to the centroid and the root mean
    square distance, both known from the topic's moments, so only topics whose
    range reaches below the least upper end are summed up pair by pair.
    """
    spark = vectors.sparkSession
    scratch = Scratch(spark, "silhouette")
    by = list(by)
    keyed = doc_topics.where(F.col("topic") != NOISE)
    each = keyed.groupBy(*by).agg(F.count(F.lit(1)).alias("n"), F.count_distinct("topic").alias("n_topics"))
    number = Window.orderBy(*(by or [F.lit(0)]))  # one row a run
    runs = scratch.table(each.withColumn("run", F.row_number().over(number)), "runs")
    if by:
        keyed = keyed.join(runs.select("run", *by), by).select("run", "topic", "doc_id")
        sums = _sums_of_runs(vectors, keyed, runs, scratch, block_rows, block_topics)
    else:
        keyed = keyed.select(F.lit(1).alias("run"), "topic", "doc_id")
        sums = _sums(vectors, keyed, runs, scratch, block_rows, block_topics)

    per_topic = sums.groupBy("run", "id", "topic", "other").agg(F.sum("total").alias("total"), F.sum("n").alias("n"))
    own = F.col("topic") == F.col("other")
    scores = per_topic.groupBy("run", "id").agg(
        F.max(F.when(own & (F.col("n") > 1), F.col("total") / (F.col("n") - 1))).alias("a"),
        F.min(F.when(~own, F.col("total") / F.col("n"))).alias("b"),
    )
    largest = F.greatest("a", "b")
    score = F.when(F.col("a").isNull() | F.col("b").isNull() | (largest == 0), 0.0).otherwise(
        (F.col("b") - F.col("a")) / largest
    )
    means = scratch.table(scores.groupBy("run").agg(F.avg(score).alias("mean")), "means")
    scratch.keep(runs, means)
    valid = (F.col("n") > F.col("n_topics")) & (F.col("n_topics") > 1)
    result = runs.join(means, "run", "left").select(
        *by, F.when(valid, F.coalesce("mean", F.lit(0.0))).otherwise(0.0).alias("silhouette")
    )
    if by:
        return doc_topics.select(*by).distinct().join(result, by, "left").fillna(0.0, ["silhouette"])
    return result


def _sums(
    vectors: DataFrame, keyed: DataFrame, runs: DataFrame, scratch: Scratch, block_rows: int, block_topics: int
) -> DataFrame:
    """(run, id, topic, other, total, n): sums of the distances from a document to topics that can be nearest, and its own.

    Every block of documents meets every block of moments of its run; what it
    wants of a topic travels as one packed value to each group of ``MET_PARTS`` blocks
    of that topic, and these blocks travel to ``SHARES`` tasks, so a topic that holds a
    third of all documents is many tasks and no block is sent to each other one.
    """
    blocks = scratch.table(_packed(vectors, keyed, block_rows), "blocks")
    topics = scratch.table(_topic_blocks(blocks, runs.select("run", "n_topics"), block_topics), "moments")

    held = blocks.select("run", "topic", "part", "n", "vecs")
    least = held.join(topics, "run").mapInArrow(_upper_ends, "run int, topic int, part int, least binary")
    ends = least.groupBy("run", "topic", "part").agg(F.collect_list("least").alias("ends"))  # one a block of moments
    wanted = blocks.select("run", "topic", "part", "n", "ids", "vecs").join(ends, ["run", "topic", "part"]).join(topics, "run")
    requests = wanted.mapInArrow(_requests, "run int, topic int, place int, other int, parts int, ids binary, vecs binary")
    met_parts = F.lit(MET_PARTS)
    dealt = requests.withColumn("met", F.explode(F.sequence(F.lit(0), F.floor((F.col("parts") - 1) / met_parts).cast("int"))))
    dealt = dealt.withColumn("share", F.pmod(F.xxhash64("topic", "place"), F.lit(SHARES)).cast("int"))
    theirs = blocks.select(
        "run", F.col("topic").alias("other"), F.floor(F.col("part") / met_parts).cast("int").alias("met"),
        F.explode(F.sequence(F.lit(0), F.lit(SHARES - 1))).alias("share"),
        F.col("n").alias("n_other"), F.col("vecs").alias("others"),
    )
    # merged, what is sent comes once with the few blocks that it meets, one after the other
    met = dealt.join(theirs.hint("merge"), ["run", "other", "met", "share"])
    met = met.select("run", "topic", "place", "other", "met", "ids", "vecs", "n_other", "others")
    return met.mapInArrow(_distance_sums, "run int, id long, topic int, other int, total double, n long")


def _sums_of_runs(
    vectors: DataFrame, keyed: DataFrame, runs: DataFrame, scratch: Scratch, block_rows: int, block_topics: int
) -> DataFrame:
    """The sums of ``_sums`` for all runs from one comparison of each pair of vectors.

    Vectors in order of their topics in all runs are packed into blocks, these into groups
    of bounded bytes.  A task gets two groups, compares two blocks if one wants a topic that
    the other holds, and adds the distances up for both of them and for every run.
    """
    n_runs = scratch.rows(runs)
    again = Window.partitionBy("doc_id", "run").orderBy("topic")  # an id may come more than once in a run
    held = keyed.withColumn("again", F.row_number().over(again)).groupBy("doc_id", "again").agg(
        F.map_from_entries(F.collect_list(F.struct("run", F.col("topic").cast("int")))).alias("of")
    )
    labels = F.transform(
        F.sequence(F.lit(1), F.lit(max(n_runs, 1))), lambda r: F.coalesce(F.try_element_at("of", r), F.lit(NOISE))
    )
    rows = held.select("doc_id", labels.alias("labels")).join(
        vectors.select("doc_id", F.col("vec").cast("array<double>").alias("vec")), "doc_id"
    )
    first = vectors.select(F.size("vec").alias("n")).first()
    n_rows = runs.agg(F.max("n").alias("n")).first().n or 0
    most = GROUP_BYTES // (8 * block_rows * max(first.n if first else 1, 1))
    per_group = min(max(-(-n_rows // (GROUPS * block_rows)), GROUP_BLOCKS[0]), max(min(GROUP_BLOCKS[1], most), 1))
    n_groups = max(1, -(-n_rows // (per_group * block_rows)))
    order = ["labels", F.xxhash64("id")]
    dealt = rows.select(F.col("doc_id").cast("long").alias("id"), "labels", "vec").repartitionByRange(n_groups, *order)
    dealt = dealt.sortWithinPartitions(*order).withColumn("group", F.spark_partition_id())

    def pack(batches):
        rest, place = None, 0
        for batch in batches:
            new = pa.Table.from_batches([batch])
            rest = new if rest is None else pa.concat_tables([rest, new])
            while rest.num_rows >= block_rows:
                yield _shared_block(rest.slice(0, block_rows), place)
                rest, place = rest.slice(block_rows), place + 1
        if rest is not None and rest.num_rows:
            yield _shared_block(rest, place)

    packed = dealt.mapInArrow(pack, "group int, place int, n int, ids binary, labels binary, vecs binary")
    blocks = scratch.table(packed, "blocks")
    holds = scratch.table(
        blocks.mapInArrow(
            _moments, "group int, run int, topic int, code long, parts int, n int, mean array<double>, square double"
        ),
        "holds",
    )
    topics = scratch.table(_topic_blocks(holds, runs.select("run", "n_topics"), block_topics), "moments")

    block = ["group", "place"]
    least = blocks.crossJoin(topics).mapInArrow(_least_of_runs, "group int, place int, run int, least binary")
    ends = least.groupBy(*block, "run").agg(F.collect_list("least").alias("ends"))  # one a block of moments
    asked = blocks.join(ends, block).join(topics, "run")
    asked = scratch.table(asked.mapInArrow(_wants_of_runs, "group int, place int, code long, rows binary"), "wants")
    wants = asked.groupBy(*block).agg(F.collect_list(F.struct("code", "rows")).alias("wants"))
    blocks = scratch.table(blocks.join(wants, block), "asking", replaces=blocks)

    other = holds.select(F.col("group").alias("other"), "code").distinct()
    pairs = asked.select("group", "code").distinct().join(other, "code").select(
        F.least("group", "other").alias("a"), F.greatest("group", "other").alias("b")
    ).distinct()
    pairs = scratch.table(pairs, "pairs")
    sent = blocks.join(pairs, F.col("group") == F.col("a")).unionByName(
        blocks.join(pairs, (F.col("group") == F.col("b")) & (F.col("a") < F.col("b")))
    )
    codes = F.transform("wants", lambda w: w["code"]).alias("wants")
    sent = sent.select("a", "b", *block, "n", "labels", "vecs", codes).repartition(max(1, min(scratch.rows(pairs), 1024)), "a", "b")
    sums = sent.groupBy("a", "b").applyInArrow(_sums_of_groups, "group int, place int, code long, n long, total binary")
    return sums.groupBy(*block).cogroup(blocks.select(*block, "ids", "labels", "wants").groupBy(*block)).applyInArrow(
        _sums_of_rows, "run int, id long, topic int, other int, total double, n long"
    )


def _packed(vectors: DataFrame, keyed: DataFrame, block_rows: int) -> DataFrame:
    """Blocks ``(run, topic, part)`` of ids and vectors, with their mean and mean square."""
    count = F.count(F.lit(1)).cast("double")
    parts = keyed.groupBy("run", "topic").agg(F.ceil(count / block_rows).cast("int").alias("parts"))
    rows = keyed.join(vectors.select("doc_id", F.col("vec").cast("array<double>").alias("vec")), "doc_id")
    dealt = rows.join(parts, ["run", "topic"]).withColumn("part", F.pmod(F.xxhash64("doc_id"), F.col("parts")).cast("int"))

    def pack(table: pa.Table) -> pa.Table:
        x = matrix(table, "vec")
        one = {name: table.column(name).slice(0, 1) for name in ("run", "topic", "part", "parts")}
        return pa.table({
            **one,
            "n": pa.array([len(x)], pa.int32()),
            "ids": pa.array([values(table, "doc_id").astype(np.int64).tobytes()], pa.binary()),
            "vecs": pa.array([x.tobytes()], pa.binary()),
            "mean": list_column(x.mean(axis=0)[None]),
            "square": pa.array([float((x * x).sum(axis=1).mean())]),
        })

    typed = dealt.select("run", F.col("topic").cast("int").alias("topic"), "part", "parts", F.col("doc_id").cast("long").alias("doc_id"), "vec")
    return typed.groupBy("run", "topic", "part").applyInArrow(
        pack, "run int, topic int, part int, parts int, n int, ids binary, vecs binary, mean array<double>, square double"
    )


def _topic_blocks(blocks: DataFrame, runs: DataFrame, block_topics: int) -> DataFrame:
    """Blocks of topics of a run: names, parts, centres and mean square distances from them."""
    weight = F.col("n").cast("double")
    moments = blocks.groupBy("run", "topic").agg(
        F.max("parts").alias("parts"),
        vector_to_array(Summarizer.mean(array_to_vector("mean"), weight)).alias("center"),
        (F.sum(F.col("square") * weight) / F.sum(weight)).alias("square"),
    )
    of_run = F.ceil(F.col("n_topics") / block_topics)
    dealt = moments.join(runs, "run").withColumn("place", F.pmod(F.xxhash64("topic"), of_run))

    def pack(table: pa.Table) -> pa.Table:
        center = matrix(table, "center")
        spread = np.maximum(values(table, "square") - (center * center).sum(axis=1), 0.0)
        packed = {
            "names": values(table, "topic").astype(np.int32), "counts": values(table, "parts").astype(np.int32),
            "centers": center, "spreads": spread,
        }
        return pa.table({
            "run": table.column("run").slice(0, 1),
            **{name: pa.array([x.tobytes()], pa.binary()) for name, x in packed.items()},
        })

    return dealt.drop("n_topics").groupBy("run", "place").applyInArrow(
        pack, "run int, names binary, counts binary, centers binary, spreads binary"
    )


def _rows(held: bytes, n: int) -> np.ndarray:
    return np.frombuffer(held).reshape(n, -1)


def _ranges(row: dict) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, float]:
    """Names of a block's topics, the rows, the ends of each row's mean distance to them, and a margin for rounding."""
    names, spread = np.frombuffer(row["names"], dtype=np.int32), np.frombuffer(row["spreads"])
    x, centers = _rows(row["vecs"], row["n"]), _rows(row["centers"], len(names))
    square = np.maximum(squared_distances(x, centers), 0.0)
    return names, x, np.sqrt(square), np.sqrt(square + spread), 1e-6 + np.sqrt(slack(x, centers))


def _upper_ends(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """For each row of a block the least upper end of its range over the other topics of a block."""
    for batch in batches:
        for i in range(batch.num_rows):
            row = batch.slice(i, 1).to_pylist()[0]
            names, _, _, high, _ = _ranges(row)
            least = np.where(names == row["topic"], np.inf, high).min(axis=1)
            yield pa.RecordBatch.from_pydict({
                **{k: pa.array([row[k]], pa.int32()) for k in ("run", "topic", "part")},
                "least": pa.array([least.tobytes()], pa.binary()),
            })


def _requests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """What a block wants of a topic: the rows whose range for it reaches below the least upper end."""
    for batch in batches:
        for i in range(batch.num_rows):
            row = batch.slice(i, 1).to_pylist()[0]
            names, x, low, _, margin = _ranges(row)
            least = np.min([np.frombuffer(e) for e in row["ends"]], axis=0)
            wanted = (names == row["topic"]) | (low <= least[:, None] * (1 + 1e-6) + margin)
            ids, parts = np.frombuffer(row["ids"], dtype=np.int64), np.frombuffer(row["counts"], dtype=np.int32)
            for t in np.flatnonzero(wanted.any(axis=0)):
                rows = wanted[:, t]
                yield pa.RecordBatch.from_pydict({
                    "run": pa.array([row["run"]], pa.int32()),
                    "topic": pa.array([row["topic"]], pa.int32()),
                    "place": pa.array([row["part"]], pa.int32()),
                    "other": pa.array(names[t : t + 1]),
                    "parts": pa.array(parts[t : t + 1]),
                    "ids": pa.array([ids[rows].tobytes()], pa.binary()),
                    "vecs": pa.array([x[rows].tobytes()], pa.binary()),
                })


def _distance_sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Per wanting document: the sum of its distances to the vectors of blocks that follow each other."""

    def told(key: tuple, ids: np.ndarray, total: np.ndarray, n: int) -> pa.RecordBatch:
        run, topic, _, other, _ = key
        whole = lambda value, kind: pa.array(np.full(len(ids), value), kind)
        return pa.RecordBatch.from_pydict({
            "run": whole(run, pa.int32()), "id": pa.array(ids),
            "topic": whole(topic, pa.int32()), "other": whole(other, pa.int32()),
            "total": pa.array(total), "n": whole(n, pa.int64()),
        })

    now, ids, total, n = None, None, None, 0
    for batch in batches:
        for i in range(batch.num_rows):
            row = batch.slice(i, 1).to_pylist()[0]
            key = tuple(row[c] for c in ("run", "topic", "place", "other", "met"))
            mine = np.frombuffer(row["ids"], dtype=np.int64)
            # keys may come more than once: what follows is added up by the caller
            if key != now or len(mine) != len(ids) or (mine != ids).any():
                if now is not None:
                    yield told(now, ids, total, n)
                now, ids, total, n = key, mine, np.zeros(len(mine)), 0
            total += distance_sums(_rows(row["vecs"], len(mine)), _rows(row["others"], row["n_other"]))
            n += row["n_other"]
    if now is not None:
        yield told(now, ids, total, n)


def _code(run: int, topics: np.ndarray) -> np.ndarray:
    """Topics of a run as one number each."""
    return (np.int64(run) << 32) + topics.astype(np.int64) + (1 << 31)


def _run_and_topic(code: int) -> tuple[int, int]:
    return code >> 32, (code & 0xFFFFFFFF) - (1 << 31)


def _each(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
    for batch in batches:
        for i in range(batch.num_rows):
            yield batch.slice(i, 1).to_pylist()[0]


def _labels(row: dict) -> np.ndarray:
    return np.frombuffer(row["labels"], dtype=np.int32).reshape(row["n"], -1)


def _shared_block(table: pa.Table, place: int) -> pa.RecordBatch:
    x = matrix(table, "vec")
    packed = {"ids": values(table, "id").astype(np.int64), "labels": matrix(table, "labels").astype(np.int32), "vecs": x}
    return pa.RecordBatch.from_pydict({
        "group": pa.array([table.column("group")[0].as_py()], pa.int32()), "place": pa.array([place], pa.int32()),
        "n": pa.array([len(x)], pa.int32()), **{name: pa.array([v.tobytes()], pa.binary()) for name, v in packed.items()},
    })


def _moments(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The topics of each block in each run, with the mean and mean square of its rows."""
    for row in _each(batches):
        x = _rows(row["vecs"], row["n"])
        square = (x * x).sum(axis=1)
        for run, label in enumerate(_labels(row).T, 1):
            topics = np.unique(label[label != NOISE])
            if not len(topics):
                continue
            inside = [label == t for t in topics]
            whole = lambda value, kind: pa.array(np.full(len(topics), value), kind)
            yield pa.RecordBatch.from_pydict({
                "group": whole(row["group"], pa.int32()), "run": whole(run, pa.int32()), "topic": pa.array(topics),
                "code": pa.array(_code(run, topics)), "parts": whole(1, pa.int32()),
                "n": pa.array([int(i.sum()) for i in inside], pa.int32()),
                "mean": list_column(np.array([x[i].mean(axis=0) for i in inside])),
                "square": pa.array([float(square[i].mean()) for i in inside]),
            })


def _least_of_runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """``_upper_ends`` for the run of a block of moments."""
    for row in _each(batches):
        names, _, _, high, _ = _ranges(row)
        own = _labels(row)[:, row["run"] - 1]
        yield pa.RecordBatch.from_pydict({
            **{k: pa.array([row[k]], pa.int32()) for k in ("group", "place", "run")},
            "least": pa.array([np.where(names == own[:, None], np.inf, high).min(axis=1).tobytes()], pa.binary()),
        })


def _wants_of_runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """What a block wants of a block of moments: topics, with a bit for each row."""
    for row in _each(batches):
        names, _, low, _, margin = _ranges(row)
        own = _labels(row)[:, row["run"] - 1]
        least = np.min([np.frombuffer(e) for e in row["ends"]], axis=0)
        wanted = (names == own[:, None]) | (low <= least[:, None] * (1 + 1e-6) + margin)
        wanted &= (own != NOISE)[:, None]
        some = np.flatnonzero(wanted.any(axis=0))
        if len(some):
            whole = lambda value: pa.array(np.full(len(some), value), pa.int32())
            yield pa.RecordBatch.from_pydict({
                "group": whole(row["group"]), "place": whole(row["place"]), "code": pa.array(_code(row["run"], names[some])),
                "rows": pa.array([np.packbits(wanted[:, t]).tobytes() for t in some], pa.binary()),
            })


class _Shared:
    """A block of a task: its distinct rows, their topics in all runs, and the sums that it wants."""

    def __init__(self, row: dict):
        self.group, self.place = row["group"], row["place"]
        self.x, self.which, _ = distinct_rows(_rows(row["vecs"], row["n"]))
        labels = _labels(row)
        codes = np.stack([_code(run, label) for run, label in enumerate(labels.T, 1)], axis=1)
        known = labels != NOISE
        self.codes = np.unique(codes[known])
        i, run = np.nonzero(known)
        self.weight = np.zeros((len(self.x), len(self.codes)))
        np.add.at(self.weight, (self.which[i], np.searchsorted(self.codes, codes[i, run])), 1.0)
        self.wants = np.unique(np.array(row["wants"], dtype=np.int64))
        self.sums: dict[int, np.ndarray] = {}
        self.counts: dict[int, int] = {}

    def asks(self, other: _Shared) -> np.ndarray:
        """Which topics of the other block this one wants."""
        return np.flatnonzero(np.isin(other.codes, self.wants))

    def add(self, rows: slice, far: np.ndarray, codes: np.ndarray, weight: np.ndarray, finite: bool) -> None:
        """Add the distances ``far`` of ``rows`` to others, whose share in ``codes`` is ``weight``."""
        if len(codes) <= PRODUCT_TOPICS and finite:
            total = far @ weight
        else:  # topic by topic: a product would be long, or multiply by what is no number
            total = np.stack([far[:, w > 0] @ w[w > 0] for w in weight.T], axis=1)
        for code, column in zip(codes.tolist(), total.T):
            if code not in self.sums:
                self.sums[code] = np.zeros(len(self.x))
            self.sums[code][rows] += column

    def count(self, codes: np.ndarray, weight: np.ndarray) -> None:
        for code, n in zip(codes.tolist(), weight.sum(axis=0).tolist()):
            self.counts[code] = self.counts.get(code, 0) + int(n)


def _compare(one: _Shared, two: _Shared) -> None:
    """Distances between two blocks, once, for the sums of both."""
    here, there = one.asks(two), two.asks(one) if one is not two else np.zeros(0, dtype=np.int64)
    if not len(here) and not len(there):
        return
    wide = far_from_range(one.x, two.x)
    if wide:
        stripes = ((slice(i, i + 1), np.sqrt(exact_squared(row, two.x))[None]) for i, row in enumerate(one.x))
    else:
        stripes = distance_stripes(one.x, two.x)
    of_two, of_one = two.weight[:, here], one.weight[:, there]
    for rows, far in stripes:
        finite = not wide or bool(np.isfinite(far).all())  # coordinates within range have finite distances
        if len(here):
            one.add(rows, far, two.codes[here], of_two, finite)
        if len(there):
            two.add(slice(None), far.T, one.codes[there], of_one[rows], finite)
    one.count(two.codes[here], of_two)
    two.count(one.codes[there], of_one)


def _sums_of_groups(table: pa.Table) -> pa.Table:
    """Compare the blocks of two groups, or those of one among themselves."""
    rows = sorted(table.to_pylist(), key=lambda r: (r["group"], r["place"]))
    a, b = rows[0]["a"], rows[0]["b"]
    blocks = [_Shared(row) for row in rows]
    mine, theirs = [x for x in blocks if x.group == a], [x for x in blocks if x.group == b]
    for i, one in enumerate(mine):
        for two in theirs[i:] if a == b else theirs:
            _compare(one, two)
    told = [(x, code) for x in blocks for code in x.sums]
    return pa.table({
        "group": pa.array([x.group for x, _ in told], pa.int32()), "place": pa.array([x.place for x, _ in told], pa.int32()),
        "code": pa.array([code for _, code in told], pa.int64()),
        "n": pa.array([x.counts[code] for x, code in told], pa.int64()),
        "total": pa.array([x.sums[code][x.which].tobytes() for x, code in told], pa.binary()),
    })


def _sums_of_rows(sums: pa.Table, block: pa.Table) -> pa.Table:
    """The sums of a block's rows over all tasks, where a row wants them."""
    row = block.to_pylist()[0]
    ids = np.frombuffer(row["ids"], dtype=np.int64)
    labels = np.frombuffer(row["labels"], dtype=np.int32).reshape(len(ids), -1)
    total, n = {}, {}
    for code, count, part in zip(*(sums.column(c) for c in ("code", "n", "total"))):
        code = code.as_py()
        part = np.frombuffer(part.as_py())
        total[code] = total[code] + part if code in total else part
        n[code] = n.get(code, 0) + count.as_py()
    parts = {c: [] for c in ("run", "id", "topic", "other", "total", "n")}
    for want in row["wants"]:
        code = want["code"]
        run, other = _run_and_topic(code)
        wanted = np.unpackbits(np.frombuffer(want["rows"], dtype=np.uint8), count=len(ids)).astype(bool)
        whole = lambda value: np.full(int(wanted.sum()), value)
        for name, part in zip(parts, (
            whole(run), ids[wanted], labels[wanted, run - 1], whole(other), total[code][wanted], whole(n[code])
        )):
            parts[name].append(part)
    kinds = (pa.int32(), pa.int64(), pa.int32(), pa.int32(), pa.float64(), pa.int64())
    return pa.table({c: pa.array(np.concatenate(p) if p else [], kind) for (c, p), kind in zip(parts.items(), kinds)})

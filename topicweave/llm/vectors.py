"""Near-duplicate vectors by an epsilon grid order join.

Unit vectors at a cosine of t lie at most eps = sqrt(2 - 2t) apart.  They are
turned to their leading principal directions, sorted by grid cells of width eps
over those, and cut into blocks of consecutive rows.  Starting from the whole
sequence paired with itself, pairs of intervals of the sequence are split level by
level; a pair whose bounding boxes are more than eps apart is dropped, as no link
can lie in it.  The pairs of blocks that remain are joined: each is split further
in the same way, and what is left is multiplied out.

The components of double precision decide; products in single precision only
sort out what is far from the threshold.  Blocks are packed into one row each, so
a shuffle copies blocks, and a joined pair gives back the number of links of each
row and a spanning forest of the links, never the links themselves.  Equal
vectors are joined once with their number.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from topicweave.llm.shared import apply_batches, components
from topicweave.scratch import Scratch

#: Principal directions in the grid order and the boxes, rows of a block, and intervals an interval is split into.
LEADING, BLOCK, FAN = 12, 2048, 8
#: Rows below which an interval of a block is not split further, and slack for rounding.
LEAF, SLACK = 128, 1e-9
#: Products in single precision further than this from the threshold are decided.
NEARLY = 1e-4


def comparable() -> Column:
    """Whether a row has an id and a vector that is neither null, empty nor zero and is finite throughout."""
    v = F.col("embedding")
    finite = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))
    return F.coalesce(F.col("vec_id").isNotNull() & finite & F.exists(v, lambda x: x != 0), F.lit(False))


def matrix(column: pa.Array) -> np.ndarray:
    """A list column whose rows have one length as a matrix."""
    return column.flatten().to_numpy(zero_copy_only=False).astype(float).reshape(len(column), -1)


def unit(rows: np.ndarray) -> np.ndarray:
    """Rows scaled to length one, first by their largest part so that squares neither vanish nor overflow."""
    rows = rows / np.abs(rows).max(axis=1, keepdims=True)
    return rows / np.sqrt((rows * rows).sum(axis=1, keepdims=True))


def principal(reps: DataFrame, dim: int, leading: int) -> np.ndarray:
    """Leading principal directions: the sums of outer products of each partition, added up."""

    def moments(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((dim + 1, dim + 1))
        for batch in batches:
            if batch.num_rows:
                x = unit(matrix(batch["embedding"]))
                x = np.hstack([x, np.ones((len(x), 1))])
                total += x.T @ x
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.arange(total.size)), pa.array(total.ravel())], names=["at", "value"]
        )

    sums = reps.select("embedding").mapInArrow(moments, "at long, value double").groupBy("at").agg(F.sum("value")).collect()
    total = np.zeros((dim + 1) ** 2)
    for at, value in sums:
        total[at] = value
    total = total.reshape(dim + 1, dim + 1)
    n = max(total[-1, -1], 1)
    mean = total[-1, :-1] / n
    _, directions = np.linalg.eigh(total[:-1, :-1] / n - np.outer(mean, mean))
    return directions[:, ::-1][:, :leading].copy()


def link(vectors: DataFrame, threshold: float = 0.95, block: int = BLOCK) -> DataFrame:
    """``vec_id, n_links, component_id, kept`` for every row, at a cosine of ``threshold`` or more.

    Only vectors of the same dimension are compared.  A row that cannot be
    compared has no links and is its own component; a null id never links.
    Rows that repeat an id count as one vector each but share the id's component.
    An empty table gives no rows.  Other columns are not read.
    """
    scratch = Scratch(vectors.sparkSession, "grid")
    vectors = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), "embedding")
    same = F.sha2(F.concat_ws(",", F.transform("embedding", lambda x: x.cast("string"))), 256)
    rows = scratch.table(vectors.where(comparable()).select("vec_id", "embedding", same.alias("same")), "rows")
    reps = rows.groupBy("same").agg(
        F.min("vec_id").alias("rep"), F.count(F.lit(1)).alias("copies"), F.first("embedding").alias("embedding")
    )
    reps = scratch.table(reps.withColumn("dim", F.size("embedding")), "reps")
    told = reps.select("same", "rep", (F.col("copies") - 1).alias("n"))
    edges = reps.select(F.col("rep").alias("src"), F.col("rep").alias("dst")).limit(0)
    for dim, number in sorted(reps.groupBy("dim").count().collect()):
        own = reps.where(F.col("dim") == dim).select("same", "rep", "copies", "embedding")
        near, links = _join(scratch, own, dim, number, threshold, block)
        told, edges = told.union(near), edges.union(links)
    component = components(scratch, edges)
    links = told.groupBy("same", "rep").agg(F.sum("n").cast("long").alias("n_links"))
    links = links.join(component.withColumnRenamed("node", "rep"), "rep", "left").select(
        "same", "n_links", F.coalesce("component", "rep").alias("component_id")
    )
    out = rows.select("vec_id", "same").join(links, "same").select("vec_id", "n_links", "component_id")
    others = vectors.where(~comparable()).select("vec_id", F.lit(0).cast("long"), "vec_id")
    return out.union(others).withColumn("kept", F.col("vec_id").eqNullSafe(F.col("component_id")))


def _join(
    scratch: Scratch, reps: DataFrame, dim: int, number: int, threshold: float, block: int
) -> tuple[DataFrame, DataFrame]:
    """Links of the vectors by ``same`` and ``rep``, to be summed up, and a forest of links between ids."""
    spark = reps.sparkSession
    eps = math.sqrt(max(0.0, 2 - 2 * threshold))
    leading = min(LEADING, dim)
    axes = spark.sparkContext.broadcast(principal(reps, dim, leading))
    kind = reps.schema["embedding"].dataType.elementType.simpleString()
    held_as = np.float32 if kind == "float" else np.float64

    def turn(batch: pa.RecordBatch) -> pa.RecordBatch:
        cells = np.floor(unit(matrix(batch["embedding"])) @ axes.value / max(eps, 1e-6)).astype(np.int32)
        return pa.RecordBatch.from_arrays([*batch.columns, pa.array(list(cells))], names=[*batch.schema.names, "cell"])

    fields = f"same string, rep long, copies long, embedding array<{kind}>"
    turned = apply_batches(reps, turn, f"{fields}, cell array<int>")

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, seen = TaskContext.get().partitionId(), 0
        for batch in batches:
            at = np.arange(seen, seen + batch.num_rows)
            seen += batch.num_rows
            columns = [batch[c] for c in ("same", "rep", "copies", "embedding")]
            yield pa.RecordBatch.from_arrays(
                [*columns, pa.array(np.full(batch.num_rows, part, dtype=np.int32)), pa.array(at)],
                names=["same", "rep", "copies", "embedding", "part", "inside"],
            )

    # the sequence: sorted by range, numbered, and cut every ``block`` rows
    ordered = turned.repartitionByRange("cell", "same").sortWithinPartitions("cell", "same")
    ordered = scratch.table(ordered.mapInArrow(count, f"{fields}, part int, inside long"), "ordered")
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)  # one row for each task of the sort
    sizes = ordered.groupBy("part").agg(F.count(F.lit(1)).alias("_n"))
    starts = sizes.select("part", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("start"))
    numbered = ordered.join(F.broadcast(starts), "part").withColumn("row", F.col("start") + F.col("inside"))
    numbered = scratch.table(numbered.drop("part", "inside", "start"), "numbered", replaces=ordered)

    def pack(table: pa.Table) -> pa.Table:
        table = table.sort_by("row").combine_chunks()
        x = matrix(table["embedding"].combine_chunks())
        lead = unit(x) @ axes.value
        return pa.table({
            "at": [table["row"][0].as_py() // block],
            "rep": [table["rep"].to_pylist()],
            "copies": [table["copies"].to_pylist()],
            "vectors": [x.astype(held_as).tobytes()],
            "low": [lead.min(axis=0).tolist()],
            "high": [lead.max(axis=0).tolist()],
        })

    blocks = numbered.withColumn("at", F.floor(F.col("row") / block)).groupBy("at").applyInArrow(
        pack, "at long, rep array<long>, copies array<long>, vectors binary, low array<double>, high array<double>"
    )
    blocks = scratch.table(blocks, "blocks")
    pairs = _near_blocks(scratch, blocks.select("at", "low", "high"), -(-number // block), leading, eps)
    one, two = (
        blocks.select(F.col("at").alias(side), F.struct("rep", "copies", "vectors").alias(held))
        for side, held in (("left", "a"), ("right", "b"))
    )
    met = pairs.join(one, "left").join(two, "right").select("left", "right", "a", "b")

    def multiply(batch: pa.RecordBatch) -> pa.RecordBatch:
        out: list[list] = [[], [], [], []]
        for i in range(batch.num_rows):
            places = batch["left"][i].as_py(), batch["right"][i].as_py()
            both = []
            for side in ("a", "b"):
                held = batch[side][i].as_py()
                x = unit(np.frombuffer(held["vectors"], dtype=held_as).reshape(-1, dim).astype(float))
                both.append((x, x @ axes.value, np.array(held["rep"]), np.array(held["copies"])))
            *counts, forest = _links(*both, places[0] == places[1], threshold, eps)
            for place, own in zip(places, counts, strict=True):
                at = np.flatnonzero(own)
                out[0] += (at + place * block).tolist()
                out[1] += own[at].tolist()
                out[2] += [None] * len(at)
                out[3] += [None] * len(at)
            out[0] += [None] * len(forest)
            out[1] += [None] * len(forest)
            out[2] += [x for x, _ in forest]
            out[3] += [y for _, y in forest]
        return pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in out], names=["row", "n", "src", "dst"])

    found = scratch.table(apply_batches(met, multiply, "row long, n long, src long, dst long"), "found")
    near = found.where("row is not null").groupBy("row").agg(F.sum("n").alias("n"))
    near = near.join(numbered.select("row", "same", "rep"), "row").select("same", "rep", "n")
    return near, found.where("src is not null").select("src", "dst")


def _near_blocks(scratch: Scratch, boxes: DataFrame, blocks: int, leading: int, eps: float) -> DataFrame:
    """Pairs ``left <= right`` of blocks whose boxes are within eps, by joining intervals level by level."""
    levels = [boxes.withColumnRenamed("at", "node")]
    width = 1
    low = F.array(*[F.min(F.col("low")[i]) for i in range(leading)]).alias("low")
    high = F.array(*[F.max(F.col("high")[i]) for i in range(leading)]).alias("high")
    while width < blocks:
        width *= FAN
        above = F.floor(F.col("node") / FAN).alias("node")
        levels.append(scratch.table(levels[-1].groupBy(above).agg(low, high), "level"))
    pairs = levels[-1].select(F.col("node").alias("left"), F.col("node").alias("right"))
    gap = F.aggregate(
        F.zip_with(
            F.zip_with("al", "bh", lambda x, y: F.greatest(x - y, F.lit(0.0))),
            F.zip_with("bl", "ah", lambda x, y: F.greatest(x - y, F.lit(0.0))),
            lambda x, y: x * x + y * y,
        ),
        F.lit(0.0),
        lambda s, x: s + x,
    )
    for boxes_ in levels[-2::-1]:
        children = {c: F.explode(F.sequence(F.col(c) * FAN, F.col(c) * FAN + (FAN - 1))).alias(c) for c in ("left", "right")}
        split = pairs.select(children["left"], "right").select("left", children["right"])
        a = boxes_.select(F.col("node").alias("left"), F.col("low").alias("al"), F.col("high").alias("ah"))
        b = boxes_.select(F.col("node").alias("right"), F.col("low").alias("bl"), F.col("high").alias("bh"))
        near = split.where("left <= right").join(a, "left").join(b, "right").where(gap <= F.lit(eps * eps + SLACK))
        pairs = scratch.table(near.select("left", "right"), "pairs")
    return pairs


def _links(a: tuple, b: tuple, own: bool, threshold: float, eps: float):
    """Weighted links of the rows of two blocks, and a spanning forest of the links between their ids.

    A block is its unit vectors, their leading coordinates, ids and numbers of copies.
    """
    (va, la, ia, wa), (vb, lb, ib, wb) = a, b
    fa, fb = va.astype(np.float32), vb.astype(np.float32)
    counts_a, counts_b = np.zeros(len(va), dtype=np.int64), np.zeros(len(vb), dtype=np.int64)
    root: dict[int, int] = {}
    forest: list[tuple[int, int]] = []

    def find(x: int) -> int:
        while root.setdefault(x, x) != x:
            root[x] = x = root[root[x]]
        return x

    todo = [(0, len(va), 0, len(vb))]
    while todo:
        i0, i1, j0, j1 = todo.pop()
        if own and j1 <= i0:
            continue  # the mirror image of another interval
        gap = np.maximum(la[i0:i1].min(axis=0) - lb[j0:j1].max(axis=0), 0) + np.maximum(lb[j0:j1].min(axis=0) - la[i0:i1].max(axis=0), 0)
        if float((gap * gap).sum()) > eps * eps + SLACK:
            continue
        if max(i1 - i0, j1 - j0) > LEAF:
            mi, mj = (i0 + i1) // 2, (j0 + j1) // 2
            halves_i = [(i0, mi), (mi, i1)] if i1 - i0 > LEAF else [(i0, i1)]
            halves_j = [(j0, mj), (mj, j1)] if j1 - j0 > LEAF else [(j0, j1)]
            todo.extend((*x, *y) for x in halves_i for y in halves_j)
            continue
        product = fa[i0:i1] @ fb[j0:j1].T
        i, j = np.nonzero(product >= threshold - NEARLY)
        if not len(i):
            continue
        i, j = i + i0, j + j0
        if own:
            i, j = i[i < j], j[i < j]
        exact = np.einsum("ij,ij->i", va[i], vb[j])
        i, j = i[exact >= threshold], j[exact >= threshold]
        np.add.at(counts_a, i, wb[j])
        np.add.at(counts_b, j, wa[i])
        for x, y in zip(i.tolist(), j.tolist(), strict=True):
            p, q = find(int(ia[x])), find(int(ib[y]))
            if p != q:
                root[q] = p
                forest.append((int(ia[x]), int(ib[y])))
    return counts_a, counts_b, forest

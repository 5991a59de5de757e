"""Nearest neighbours by pivots: exact, or over the nearest cells only.

A hash-chosen sample of the points serves as pivots and every point belongs to
the cell of its nearest pivot.  The sample follows the density, so a crowded
region is cut into many cells.  Cells that lie near each other are packed into
blocks of bounded rows, and blocks travel, never a row for each cell it visits:
what a point wants of the cells of another block is a line of bits.  A first pass
searches each block by itself and gives each point a bound on its k-th distance;
the second pass visits every other cell that the triangle inequality does not rule
out, so nothing is lost.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from topicweave.operators.blocks import (
    BLOCK_ROWS,
    ENTRIES_AT_ONCE,
    exact_pairs,
    exact_squared,
    list_column,
    matrix,
    slack,
    slices,
    squared_distances,
    stripes,
    values,
)
from topicweave.scratch import Scratch

# Pivots are held by every task, so their number is bounded.
MAX_CELLS = 4096
CELL_ROWS = 2048
# Queries whose true neighbours decide how many cells are probed, and the recall asked for.
RECALL_QUERIES = 256
RECALL = 0.9
# blocks that are met together, and the least shares of the blocks that meet them apart from each other
MET_BLOCKS = 8
SHARES = 16
# pairs asked for as a share of all, below which cells are compared one by one
SPARSE = 0.2
# error of products in single precision as a share of the usual bound, up to which they tell the candidates
ROUGH = 1e-3


def collapse_copies(vectors: DataFrame, scratch: Scratch) -> tuple[DataFrame, DataFrame | None]:
    """Distinct vectors ``(id, vec, copies)`` and, if any vector repeats, ``(doc_id, id)``.

    The id is the smallest ``doc_id`` of the copies.  Copies are counted
    map-side, so a vector that a third of all documents share is one group of
    partial counts.
    """
    vectors = vectors.select("doc_id", "vec")
    points = scratch.table(
        vectors.groupBy("vec").agg(
            F.min("doc_id").alias("id"), F.count(F.lit(1)).alias("copies")
        ).select("id", "vec", "copies"),
        "points",
        watch=F.col("copies") > 1,
    )
    if not scratch.watched(points):
        return points, None
    # one row per vector on the right: AQE splits a hot key on the left
    return points, vectors.join(points.select("vec", "id"), "vec").select("doc_id", "id")


def comparable(points: DataFrame, metric: str) -> DataFrame:
    """Vectors whose Euclidean order is that of ``metric``.

    For the cosine they get length one.  An extra coordinate marks zero
    vectors: they are at distance 0 from each other and 1 from all others.
    """
    if metric == "euclidean":
        return points.withColumn("vec", F.col("vec").cast("array<double>"))
    if metric != "cosine":
        raise ValueError(f"unknown metric {metric!r}")

    def prepare(batches):
        for batch in batches:
            table = pa.Table.from_batches([batch])
            rows = matrix(table, "vec") if batch.num_rows else np.zeros((0, 1))
            length = np.sqrt((rows * rows).sum(axis=1))
            zero = (length == 0.0).astype(float)
            rows = np.hstack([rows / (length + zero)[:, None], zero[:, None]])
            yield table.set_column(
                table.schema.get_field_index("vec"), "vec", list_column(rows)
            ).combine_chunks().to_batches()[0] if batch.num_rows else batch
    schema = points.withColumn("vec", F.col("vec").cast("array<double>")).schema
    return points.withColumn("vec", F.col("vec").cast("array<double>")).mapInArrow(prepare, schema)


def as_distance(squared, metric: str):
    """A squared distance of comparable vectors as a distance of ``metric``."""
    return squared / 2.0 if metric == "cosine" else F.sqrt(squared)


@dataclass
class Cells:
    """Points with their cell, and what every task knows about the cells."""

    points: DataFrame  # id, vec, ..., cell, reach
    pivots: np.ndarray
    pivot_ids: np.ndarray
    radius: np.ndarray
    size: np.ndarray


def assign_cells(points: DataFrame, scratch: Scratch, cell_rows: int = CELL_ROWS) -> Cells:
    """Put every point into the cell of its nearest pivot."""
    n = points.count()
    n_cells = int(min(MAX_CELLS, max(1, -(-n // cell_rows))))
    chosen = points.select("id", "vec").orderBy(F.xxhash64("id"), "id").limit(n_cells).collect()
    pivots = np.array([row.vec for row in chosen], dtype=float).reshape(len(chosen), -1)

    def assign(batches):
        for batch in batches:
            for table in slices(batch, len(pivots)):
                rows = matrix(table, "vec")
                squared = squared_distances(rows, pivots)
                cell = squared.argmin(axis=1)
                reach = np.sqrt(exact_squared(rows, pivots[cell]))
                table = table.append_column("cell", pa.array(cell.astype(np.int32)))
                table = table.append_column("reach", pa.array(reach))
                yield from table.to_batches()

    placed = scratch.table(
        points.mapInArrow(assign, f"{_ddl(points)}, cell int, reach double"), "cells"
    )
    radius, size = np.zeros(len(pivots)), np.zeros(len(pivots), dtype=np.int64)
    for row in placed.groupBy("cell").agg(F.max("reach").alias("r"), F.count(F.lit(1)).alias("n")).collect():
        radius[row.cell], size[row.cell] = row.r, row.n
    return Cells(placed, pivots, np.array([row.id for row in chosen]), radius, size)


def _ddl(df: DataFrame) -> str:
    return ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema.fields)


def reachable(
    rows: np.ndarray, own: np.ndarray, bound: np.ndarray, pivots: np.ndarray, radius: np.ndarray
) -> np.ndarray:
    """Which cells may hold a point within ``bound`` of each row.

    ``own`` is the row's own cell.  A cell is ruled out when all of it lies
    farther away by its radius, or by the plane between the two pivots.
    """
    to_pivot = np.sqrt(np.maximum(squared_distances(rows, pivots), 0.0))
    margin = 1e-5 * (1.0 + to_pivot)
    near = to_pivot - radius[None, :] <= bound[:, None] + margin
    cells, which = np.unique(own, return_inverse=True)
    between = np.sqrt(np.maximum(squared_distances(pivots[cells], pivots), 0.0))[which]
    mine = to_pivot[np.arange(len(rows)), own]
    gap = to_pivot**2 - mine[:, None] ** 2
    reach = np.where(np.isfinite(bound), bound, np.finfo(float).max / 1e9)
    plane = gap <= 2.0 * between * (reach[:, None] + margin) + 1e-9
    return near & plane


@dataclass
class Blocks:
    """Points packed into blocks of whole cells; a cell of more rows than a block has is cut into several."""

    packed: DataFrame  # block, ids, cells, vecs
    first: np.ndarray  # by cell: its first block, and how many it has
    pieces: np.ndarray
    count: int

    def group_cells(self) -> list[np.ndarray]:
        """The cells of each group of blocks that are met together, in rising order."""
        low, high = self.first // MET_BLOCKS, (self.first + self.pieces - 1) // MET_BLOCKS
        return [np.flatnonzero((low <= g) & (g <= high)) for g in range(-(-self.count // MET_BLOCKS))]


def _near_each_other(pivots: np.ndarray) -> list[int]:
    """The pivots in an order of halves by their widest coordinate."""
    order, todo = [], [np.arange(len(pivots))]
    while todo:
        part = todo.pop()
        if len(part) < 2:
            order += part.tolist()
            continue
        widest = int(np.argmax(pivots[part].var(axis=0)))
        part = part[np.argsort(pivots[part, widest], kind="stable")]
        todo += [part[len(part) // 2 :], part[: len(part) // 2]]
    return order


def pack_blocks(cells: Cells, scratch: Scratch, block_rows: int = BLOCK_ROWS) -> Blocks:
    """Pack the points of cells that lie near each other into blocks of about ``block_rows``."""
    first, pieces = np.zeros(len(cells.size), dtype=np.int64), np.ones(len(cells.size), dtype=np.int64)
    block, held = 0, 0
    for cell in _near_each_other(cells.pivots):
        size = int(cells.size[cell])
        if held and held + size > block_rows:
            block, held = block + 1, 0
        first[cell], pieces[cell] = block, max(1, -(-size // block_rows))
        held += size
        if pieces[cell] > 1:
            block, held = block + int(pieces[cell]), 0
    places = list(zip(range(len(first)), first.tolist(), pieces.tolist()))  # one row a cell
    spark = cells.points.sparkSession
    places = F.broadcast(spark.createDataFrame(places, "cell int, _first int, _pieces int"))
    dealt = cells.points.select("id", "vec", "cell").join(places, "cell").select(
        (F.col("_first") + F.pmod(F.xxhash64("id"), F.col("_pieces"))).cast("int").alias("block"), "id", "cell", "vec"
    )

    def pack(table: pa.Table) -> pa.Table:
        ids, cell = values(table, "id"), values(table, "cell")
        order = np.lexsort((ids, cell))
        held = {"ids": ids[order].astype(np.int64), "cells": cell[order].astype(np.int32), "vecs": matrix(table, "vec")[order]}
        return pa.table({
            "block": table.column("block").slice(0, 1), **{name: pa.array([x.tobytes()], pa.binary()) for name, x in held.items()},
        })

    packed = dealt.groupBy("block").applyInArrow(pack, "block int, ids binary, cells binary, vecs binary")
    return Blocks(scratch.table(packed, "blocks"), first, pieces, block + 1)


def _block_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
    for batch in batches:
        for i in range(batch.num_rows):
            yield batch.slice(i, 1).to_pylist()[0]


def _unpacked(row: dict, ids: str = "ids", vecs: str = "vecs") -> tuple[np.ndarray, np.ndarray]:
    held = np.frombuffer(row[ids], dtype=np.int64)
    return held, np.frombuffer(row[vecs]).reshape(len(held), -1)


def rough_slack(left: np.ndarray, qq: np.ndarray, cc: np.ndarray) -> float:
    """More than the error of squared distances from products in single precision; infinite where its range may not do."""
    largest = qq.max(initial=0.0) + cc.max(initial=0.0)
    return (left.shape[1] + 8) * 2.0**-22 * largest if 1e-20 < largest < 1e30 else np.inf


class Nearest:
    """The nearest candidates so far of some points, none beyond a point's bound (squared)."""

    def __init__(self, ids: np.ndarray, rows: np.ndarray, k: int, bound: np.ndarray | None = None):
        self.ids, self.rows = ids, rows
        self.bound = np.full(len(ids), np.inf) if bound is None else bound
        self.far = np.full((len(ids), k), np.inf)
        self.other = np.full((len(ids), k), -1, dtype=np.int64)

    def look(self, c_ids: np.ndarray, c: np.ndarray) -> None:
        """Compare all points with all candidates."""
        self._compare(np.arange(len(self.ids)), c_ids, c)

    def look_into(self, c_ids: np.ndarray, c: np.ndarray, cell: np.ndarray, wanted: np.ndarray) -> None:
        """Compare with candidates in order of ``cell``, each point with those in cells ``wanted``, points by cells."""
        here, rows = np.unique(cell, return_counts=True)
        here, rows = here[wanted[:, here].any(axis=0)], rows[wanted[:, here].any(axis=0)]
        some = np.flatnonzero(wanted[:, here].any(axis=1))
        if not len(some):
            return
        asked = wanted[some][:, here]
        if asked.mean(axis=0) @ rows < SPARSE * rows.sum():
            for one, column in enumerate(here):  # most of the product would be for nothing
                of = slice(*np.searchsorted(cell, [column, column + 1]))
                self._compare(some[asked[:, one]], c_ids[of], c[of])
            return
        place = np.minimum(np.searchsorted(here, cell), len(here) - 1)
        of = here[place] == cell
        self._compare(some, c_ids[of], c[of], None if asked.all() else asked, place[of])

    def _compare(self, some, c_ids, c, asked=None, place=None) -> None:
        """Points ``some`` with candidates, as far as ``asked``, points by places, holds at a candidate's ``place``."""
        k = self.far.shape[1]
        q, bound = self.rows[some], np.minimum(self.bound[some], self.far[some, -1])
        eps = slack(q, c)
        ones = lambda x: np.ones((len(x), 1))
        qq, cc = (q * q).sum(axis=1), (c * c).sum(axis=1)
        left = np.hstack([-2.0 * q, qq[:, None], ones(q)])
        right = np.hstack([c, ones(c), cc[:, None]]).T.copy()
        rough = rough_slack(left, qq, cc)
        if rough <= ROUGH * np.median(bound) < np.inf:  # false for what is no number
            left, right, eps = left.astype(np.float32), right.astype(np.float32), rough
        for rows, fast, below in stripes(left, right):
            start = rows.start
            limit = bound[rows] * (1 + 1e-12) + eps
            unbound = np.flatnonzero(np.isinf(limit))
            if len(unbound) and len(c) > k + 1:
                open_ = fast[unbound].astype(float)
                if asked is not None:
                    open_[~asked[start + unbound][:, place]] = np.inf
                # one more than k, since the query may be its own candidate
                limit[unbound] = np.partition(open_, k, axis=1)[:, k] + 2 * eps
            limit = np.minimum(limit, np.finfo(fast.dtype).max).astype(fast.dtype)
            i, j = below(np.nextafter(limit, fast.dtype.type(np.inf)) if fast.dtype == np.float32 else limit)
            i += start
            meant = self.ids[some[i]] != c_ids[j]
            if asked is not None:
                meant &= asked[i, place[j]]
            i, j = i[meant], j[meant]
            if len(i):
                self._take(some[i], c_ids[j], exact_pairs(q, c, i, j))

    def _take(self, i: np.ndarray, other: np.ndarray, d: np.ndarray) -> None:
        k, touched = self.far.shape[1], np.unique(i)
        i = np.concatenate([i, np.repeat(touched, k)])
        d = np.concatenate([d, self.far[touched].ravel()])
        other = np.concatenate([other, self.other[touched].ravel()])
        order = np.lexsort((other, d, i))
        i, d, other = i[order], d[order], other[order]
        place = np.arange(len(i)) - np.searchsorted(i, i)
        kept = place < k
        self.far[i[kept], place[kept]], self.other[i[kept], place[kept]] = d[kept], other[kept]

    def found(self) -> pa.RecordBatch:
        i, j = np.nonzero(np.isfinite(self.far))
        return pa.RecordBatch.from_pydict({
            "src": pa.array(self.ids[i]), "dst": pa.array(self.other[i, j]), "d2": pa.array(self.far[i, j])
        })


def probes_for(cells: Cells, k: int, recall: float = RECALL, queries: int = RECALL_QUERIES) -> int:
    """The fewest nearest cells that hold the share ``recall`` of the k nearest points.

    Measured by brute force: a hash-chosen sample of ``queries`` points is compared
    with all points.  The sample's share less two standard errors has to reach
    ``recall``, so the number grows with the cells as far as the data need it.
    """
    pivots = cells.pivots
    # another hash than that of the pivots, which have cells of their own
    chosen = cells.points.select("id", "vec").orderBy(F.xxhash64("id", F.lit(1)), "id").limit(queries).collect()
    q_id = np.array([row.id for row in chosen], dtype=np.int64)
    q = np.array([row.vec for row in chosen], dtype=float).reshape(len(chosen), -1)

    def compare(batches):
        for batch in batches:
            if not batch.num_rows:
                continue
            table = pa.Table.from_batches([batch])
            rows, ids, cell = matrix(table, "vec"), values(table, "id"), values(table, "cell")
            squared = squared_distances(q, rows)
            squared[q_id[:, None] == ids[None, :]] = np.inf
            take = np.argsort(squared, axis=1, kind="stable")[:, :k]
            i, j = np.repeat(np.arange(len(q)), take.shape[1]), take.ravel()
            other = q_id[i] != ids[j]
            i, j = i[other], j[other]
            yield pa.RecordBatch.from_arrays(
                [pa.array(q_id[i]), pa.array(ids[j]), pa.array(exact_squared(q[i], rows[j])), pa.array(cell[j].astype(np.int32))],
                names=["src", "dst", "d2", "cell"],
            )

    found = cells.points.select("id", "vec", "cell").mapInArrow(compare, "src long, dst long, d2 double, cell int")
    place = np.argsort(np.argsort(squared_distances(q, pivots), axis=1, kind="stable"), axis=1)
    row_of = {one: i for i, one in enumerate(q_id.tolist())}
    reached = np.zeros((len(q), len(pivots)))  # by query: neighbours in the cell of each place
    for row in _best(found, k).select("src", "cell").collect():  # at most k a query
        i = row_of[row.src]
        reached[i, place[i, row.cell]] += 1
    total = reached.sum(axis=1)
    share = np.cumsum(reached[total > 0], axis=1) / total[total > 0, None]
    if len(share) < 2:
        return len(pivots)
    sure = share.mean(axis=0) - 2 * share.std(axis=0, ddof=1) / np.sqrt(len(share))
    return int(np.argmax(sure >= recall)) + 1  # all cells reach a share of 1


def _best(found: DataFrame, k: int) -> DataFrame:
    nearest = Window.partitionBy("src").orderBy("d2", "dst")
    return found.withColumn("rank", F.row_number().over(nearest)).where(F.col("rank") <= k)


def nearest_points(
    cells: Cells,
    k: int,
    scratch: Scratch,
    method: str = "exact",
    nprobe: int | None = None,
    block_rows: int = BLOCK_ROWS,
) -> DataFrame:
    """(src, dst, rank, d2) over distinct points; ties fall to the smaller id.

    What a block wants of a group of ``MET_BLOCKS`` blocks is sent once, with a bit for each
    point and cell; these blocks are sent to ``SHARES`` tasks, and to more where a share would be
    more than ``MET_BLOCKS`` blocks.  So a task holds that many blocks that ask and that many that
    they meet, each once, whatever the number of points.
    """
    pivots, radius, size = cells.pivots, cells.radius, cells.size
    blocks = pack_blocks(cells, scratch, block_rows)
    first, pieces, group_cells = blocks.first, blocks.pieces, blocks.group_cells()
    shares = max(SHARES, len(group_cells))
    exact = method == "exact"
    least = 0 if exact else probes_for(cells, k) if nprobe is None else nprobe

    def alone(batches):
        """Each block searched by itself: bounds for the other blocks, and what was found."""
        for row in _block_rows(batches):
            near = Nearest(*_unpacked(row), k)
            near.look(near.ids, near.rows)
            held = {"bounds": near.far[:, -1], "far": near.far, "others": near.other}
            yield pa.RecordBatch.from_pydict({
                "block": pa.array([row["block"]], pa.int32()),
                **{name: pa.array([row[name]], pa.binary()) for name in ("ids", "cells", "vecs")},
                **{name: pa.array([np.ascontiguousarray(x).tobytes()], pa.binary()) for name, x in held.items()},
            })

    def listed(batches):
        for row in _block_rows(batches):
            near = Nearest(np.frombuffer(row["ids"], dtype=np.int64), np.zeros((0, 0)), k)
            near.far = np.frombuffer(row["far"]).reshape(-1, k)
            near.other = np.frombuffer(row["others"], dtype=np.int64).reshape(-1, k)
            yield near.found()

    def probed(rows: np.ndarray, own: np.ndarray) -> np.ndarray:
        """Which cells each row looks into: the nearest ones, enough for k neighbours besides the point itself."""
        order = np.argsort(squared_distances(rows, pivots), axis=1, kind="stable")
        seen = np.cumsum(size[order], axis=1)
        n = np.minimum(np.maximum(1 + (seen < k + 1).sum(axis=1), least), len(pivots))
        looked = np.zeros(order.shape, dtype=bool)
        np.put_along_axis(looked, order, np.arange(order.shape[1])[None, :] < n[:, None], axis=1)
        # the point's own cell comes first even if two pivots tie
        looked[np.arange(len(rows)), own] = True
        return looked

    def requests(batches):
        for row in _block_rows(batches):
            ids, rows = _unpacked(row)
            own = np.frombuffer(row["cells"], dtype=np.int32)
            bound = np.frombuffer(row["bounds"]) if exact else np.full(len(ids), np.inf)
            wanted = np.ones((len(ids), len(pivots)), dtype=bool)
            step = max(1, ENTRIES_AT_ONCE // len(pivots))
            for start in range(0, len(ids), step):
                some = slice(start, start + step)
                if exact:
                    wanted[some] = reachable(rows[some], own[some], np.sqrt(bound[some]), pivots, radius)
                elif len(pivots) > least:
                    wanted[some] = probed(rows[some], own[some])
            if exact:  # cells that lie in this block as a whole have been searched
                wanted[:, (first == row["block"]) & (pieces == 1)] = False
            wanted[:, size == 0] = False
            for group, of in enumerate(group_cells):
                here = wanted[:, of]
                asks = here.any(axis=1)
                if not asks.any():
                    continue
                held = {
                    "ids": ids[asks], "vecs": rows[asks], "bounds": bound[asks],
                    "wanted": np.packbits(here[asks], axis=1), "of": of.astype(np.int32),
                }
                yield pa.RecordBatch.from_pydict({
                    "block": pa.array([row["block"]], pa.int32()), "met": pa.array([group], pa.int32()),
                    "share": pa.array([row["block"] % shares], pa.int32()),
                    **{name: pa.array([np.ascontiguousarray(x).tobytes()], pa.binary()) for name, x in held.items()},
                })

    def search(asking: pa.Table, met: pa.Table) -> pa.Table:
        theirs = [
            (block.as_py(), *_unpacked({"ids": i.as_py(), "vecs": v.as_py()}), np.frombuffer(cells.as_py(), dtype=np.int32))
            for block, i, cells, v in zip(*(met.column(c) for c in ("c_block", "ids", "cells", "vecs")))
        ] if asking.num_rows else []
        found = []
        for row in (row for batch in asking.to_batches() for row in _block_rows([batch])):
            ids, rows = _unpacked(row)
            near = Nearest(ids, rows, k, np.frombuffer(row["bounds"]))
            of = np.frombuffer(row["of"], dtype=np.int32)
            bits = np.frombuffer(row["wanted"], dtype=np.uint8).reshape(len(ids), -1)
            wanted = np.unpackbits(bits, axis=1, count=len(of)).astype(bool)
            for block, c_ids, c, c_cells in theirs:
                if not exact or block != row["block"]:
                    near.look_into(c_ids, c, np.searchsorted(of, c_cells), wanted)
            found.append(near.found())
        return pa.Table.from_batches(found) if found else pa.table({
            "src": pa.array([], pa.int64()), "dst": pa.array([], pa.int64()), "d2": pa.array([], pa.float64())
        })

    schema = "src long, dst long, d2 double"
    packed = "block int, ids binary, cells binary, vecs binary"
    asking = blocks.packed
    if exact:
        asking = scratch.table(
            asking.mapInArrow(alone, f"{packed}, bounds binary, far binary, others binary"), "alone"
        )
    sent = asking.select("block", "ids", "cells", "vecs", *["bounds"] * exact).mapInArrow(
        requests,
        "block int, met int, share int, ids binary, vecs binary, bounds binary, wanted binary, of binary",
    )
    theirs = blocks.packed.select(
        F.floor(F.col("block") / F.lit(MET_BLOCKS)).cast("int").alias("met"),
        F.explode(F.sequence(F.lit(0), F.lit(shares - 1))).alias("share"),
        F.col("block").alias("c_block"), "ids", "cells", "vecs",
    )
    keys = ["met", "share"]
    found = sent.groupBy(*keys).cogroup(theirs.groupBy(*keys)).applyInArrow(search, schema)
    if exact:
        found = asking.select("ids", "far", "others").mapInArrow(listed, schema).unionByName(found)
    best = scratch.table(_best(found, k), "nearest")
    scratch.drop(blocks.packed)
    if exact:
        scratch.drop(asking)
    return best


def knn_graph(
    vectors: DataFrame,
    k: int,
    metric: str = "cosine",
    method: str = "exact",
    nprobe: int | None = None,
    cell_rows: int = CELL_ROWS,
    block_rows: int = BLOCK_ROWS,
) -> DataFrame:
    """(src, dst, rank, dist): the k nearest other documents, ties to the smaller id.

    ``exact`` visits every cell that may hold a neighbour; ``ivf`` only the
    ``nprobe`` nearest cells, by default as many as a recall of 0.9 takes, measured
    on a sample (``probes_for``).  Equal vectors are searched once: k + 1 of the
    smallest ids stand for all copies, and no list needs more.
    """
    scratch = Scratch(vectors.sparkSession, "knn")
    points, members = collapse_copies(vectors, scratch)
    cells = assign_cells(comparable(points.select("id", "vec"), metric), scratch, cell_rows)
    near = nearest_points(cells, k, scratch, method, nprobe, block_rows).withColumn(
        "dist", as_distance(F.col("d2"), metric)
    )
    if members is None:
        return near.select("src", "dst", "rank", "dist")

    members = scratch.table(members, "members")
    smallest = Window.partitionBy("id").orderBy("doc_id")
    heads = members.withColumn("_n", F.row_number().over(smallest)).where(F.col("_n") <= k + 1)
    zero = points.select(F.col("id").alias("src"), F.col("id").alias("dst"), F.lit(0.0).alias("dist"))
    reached = near.select("src", "dst", "dist").unionByName(zero).join(
        heads.select(F.col("id").alias("dst"), "doc_id"), "dst"
    )
    best_first = Window.partitionBy("src").orderBy("dist", "doc_id")
    lists = (
        reached.withColumn("_n", F.row_number().over(best_first))
        .where(F.col("_n") <= k + 1)
        .groupBy("src")
        .agg(F.array_sort(F.collect_list(F.struct("dist", "doc_id"))).alias("near"))
    )
    others = F.slice(F.filter("near", lambda x: x["doc_id"] != F.col("doc_id")), 1, k)
    return (
        members.join(lists, members.id == lists.src)
        .select(F.col("doc_id").alias("src"), F.posexplode(others).alias("pos", "n"))
        .select("src", F.col("n.doc_id").alias("dst"), (F.col("pos") + 1).alias("rank"), F.col("n.dist").alias("dist"))
    )

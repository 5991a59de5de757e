"""Merging of topics by average linkage on cosine distance.

The mean distance between the members of two groups is one minus the product of the
groups' mean unit vectors, so a group is kept as the sum of its unit vectors and no
table of pairs is needed: nearest groups are found by products of blocks.  Two groups
that are each other's nearest are merged at once, many a round.  Such a merge is one that
merging the closest pair again and again makes as well, as no other group can come
nearer to the merged one than to its parts.  A group looks for its nearest again only
if it or the one it had found has been merged.

Merges are found in another order than their distance, so rounds go on until enough
of them lie below all distances that are left; the closest ones are then taken.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from topicweave.operators.blocks import BLOCK_ROWS, block_join, matrix, values
from topicweave.operators.dendrogram import in_order
from topicweave.operators.spanning import find_roots
from topicweave.scratch import Scratch

#: Decimal places to which distances count.
PLACES = 12


def groups(vectors: DataFrame, n_groups: int, scratch: Scratch, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """``(id, root)`` for ``vectors(id, vec)``: the smallest id of each one's group when ``n_groups`` are left.

    Equal distances go to the smaller ids.  A zero vector is at distance 1 from all.
    """
    norm = F.greatest(F.sqrt(F.aggregate("vec", F.lit(0.0), lambda t, x: t + x * x)), F.lit(1e-12))
    unit = F.transform("vec", lambda x: x / norm)
    live = scratch.table(vectors.select("id", unit.alias("total"), F.lit(1.0).alias("size"), F.lit(-1.0).alias("height")), "live")
    wanted = Scratch.rows(live) - max(n_groups, 1)
    start = live
    names = start.select("id")
    if wanted <= 0:
        return scratch.table(names.select("id", F.col("id").alias("root")), "groups")
    near, merges, step = None, None, 0
    while Scratch.rows(live) > 1:
        near = _nearest(live, near, scratch, block_rows)
        if merges is not None:
            left = near.agg(F.min("d")).first()[0]
            if merges.where(F.col("height") <= left).count() >= wanted:
                break
        pairs = near.groupBy("lo", "hi").agg(F.count(F.lit(1)).alias("n"), F.min("d").alias("d")).where("n = 2").select("lo", "hi", "d")
        merged = scratch.table(_heights(pairs, live, step), "merged")
        if not Scratch.rows(merged):  # rounding has made a ring of nearest groups
            pairs = near.groupBy("lo", "hi").agg(F.min("d").alias("d")).orderBy("d", "lo", "hi").limit(1)
            merged = scratch.table(_heights(pairs, live, step), "merged")
        merges = merged if merges is None else merges.unionByName(merged)
        gone = scratch.table(merged.select(F.explode(F.array("lo", "hi")).alias("id")), "gone")
        sums = lambda end: live.select(F.col("id").alias(end), F.col("total").alias(f"total_{end}"), F.col("size").alias(f"size_{end}"))
        new = merged.join(sums("lo"), "lo").join(sums("hi"), "hi").select(
            F.col("lo").alias("id"),
            F.zip_with("total_lo", "total_hi", lambda a, b: a + b).alias("total"),
            (F.col("size_lo") + F.col("size_hi")).alias("size"),
            "height",
        )
        live = scratch.table(live.join(gone, "id", "left_anti").unionByName(new), "live", replaces=None if live is start else live)
        ends = lambda end: gone.select(F.col("id").alias(end))
        near = near.join(ends("lo"), "lo", "left_anti").join(ends("hi"), "hi", "left_anti").select("id", "d", "lo", "hi")
        step += 1
    ordered, bounds = in_order(merges, ["height", "step", "lo", "hi"], scratch)
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    starts = bounds.select("part", "start", F.coalesce(F.sum("rows").over(before), F.lit(0)).alias("before"))  # one row a partition
    place = F.col("at") - F.col("start") + F.col("before")
    kept = ordered.join(F.broadcast(starts), F.shiftright("at", 33) == F.col("part")).where(place < wanted)
    parent = names.join(kept.select(F.col("hi").alias("id"), "lo"), "id", "left")
    run = F.lit(0).alias("run")
    roots = find_roots(parent.select(run, F.col("id").alias("v"), F.coalesce("lo", "id").alias("p")), scratch)
    return roots.select(F.col("v").alias("id"), F.col("p").alias("root"))


def _heights(pairs: DataFrame, live: DataFrame, step: int) -> DataFrame:
    """The pairs with a height that is no less than those of their parts, and the step."""
    of = lambda end: live.select(F.col("id").alias(end), F.col("height").alias(f"height_{end}"))
    height = F.greatest("d", "height_lo", "height_hi")
    return pairs.join(of("lo"), "lo").join(of("hi"), "hi").select("lo", "hi", height.alias("height"), F.lit(step).alias("step"))


def _nearest(live: DataFrame, known: DataFrame | None, scratch: Scratch, block_rows: int) -> DataFrame:
    """``(id, d, lo, hi)``: the distance of each group to its nearest and both ids in order."""
    one = F.lit(0).alias("cell")
    asking = live if known is None else live.join(known.select("id"), "id", "left_anti")
    queries = asking.select(one, F.col("id").alias("q_id"), F.col("total").alias("q_total"), F.col("size").alias("q_size"))
    candidates = live.select(one, F.col("id").alias("c_id"), F.col("total").alias("c_total"), F.col("size").alias("c_size"))
    found = block_join(queries, candidates, _closest, "id long, d double, lo long, hi long", block_rows=block_rows)
    best = found.groupBy("id").agg(F.min(F.struct("d", "lo", "hi")).alias("m")).select("id", "m.d", "m.lo", "m.hi")
    return scratch.table(best if known is None else best.unionByName(known), "near")


def _closest(chunk: pa.Table, block: pa.Table) -> pa.Table:
    """Per query: the nearest other group of the block, by distance and then by smaller id."""
    out = {"id": [], "d": [], "lo": [], "hi": []}
    if chunk.num_rows and block.num_rows:
        order = np.argsort(values(block, "c_id"), kind="stable")
        q, c = values(chunk, "q_id"), values(block, "c_id")[order]
        mine = matrix(chunk, "q_total") / values(chunk, "q_size")[:, None]
        theirs = (matrix(block, "c_total") / values(block, "c_size")[:, None])[order]
        d = np.round(1.0 - mine @ theirs.T, PLACES)
        d[q[:, None] == c[None, :]] = np.inf
        at = d.argmin(axis=1)
        least = d[np.arange(len(q)), at]
        some = np.isfinite(least)
        q, other, least = q[some], c[at[some]], least[some]
        out = {"id": q, "d": least, "lo": np.minimum(q, other), "hi": np.maximum(q, other)}
    return pa.table({k: pa.array(v, pa.float64() if k == "d" else pa.int64()) for k, v in out.items()})

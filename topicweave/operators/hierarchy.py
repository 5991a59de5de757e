"""Density hierarchy of a spanning tree, and the clusters chosen from it.

The single-linkage tree of n points is never built.  Only merges of two parts
of at least ``min_cluster_size`` documents matter, and there are fewer than
n / min_cluster_size of them.  The points are therefore gathered into *cores*,
the places where a part first reaches that size, in rounds that at least halve
the number of open parts.  For each point the rounds record the edge at which
it joins a part of that size.  The result equals the full tree's.

The tree of cores is a table of nodes as well, for all runs of a grid at once: it is
built, climbed and folded in rounds of joins, and nothing of it reaches the driver.

Those rounds are some hundred small jobs, whatever the size.  Spanning trees of a bounded
number of edges are walked by one task a run instead, in the order of their edges, which
gives the same nodes and points (``clusters_of_runs``).
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from topicweave.operators.blocks import values
from topicweave.operators.dendrogram import fold_up, jumps, last_below, merge_tree, topmost
from topicweave.operators.spanning import EDGE, find_roots
from topicweave.scratch import Scratch

NOISE = -1
# edges of a tree that are held as Python numbers at once
EDGES_AT_ONCE = 1 << 16


def _edge(*names: str):
    return F.struct(*[F.col(n).alias(c) for n, c in zip(names, EDGE)])


def gather_cores(
    forest: DataFrame,
    points: DataFrame,
    sizes: DataFrame,
    scratch: Scratch,
    max_rounds: int = 64,
) -> tuple[DataFrame, DataFrame]:
    """Gather points into cores.

    ``forest(run, src, dst, w)``, ``points(run, id, weight, core)``,
    ``sizes(run, min_cluster_size)``.  Gives ``(run, id, weight, part, e)``, the
    edge ``e`` at which the point joins a part of full size, without the points
    that never do; and the edges ``(run, a, b, w, src, dst)`` between cores.

    Why a round may take a whole chain of parts at once: a part hangs on the
    other end of its least edge, so edges get smaller towards the root of the
    chain, and a part's own edge is the largest on its way there.
    """
    largest = sizes.agg(F.max("min_cluster_size")).first()[0]
    # `a`: the edge at which a point joins the root of its open part
    start = F.struct(F.col("core").alias("w"), F.lit(-1).cast("long").alias("src"), F.lit(-1).cast("long").alias("dst"))
    open_ = scratch.table(
        points.select("run", "id", "weight", start.alias("a"), F.col("id").alias("part")), "open"
    )
    edges = scratch.table(
        forest.select("run", F.col("src").alias("a"), F.col("dst").alias("b"), F.lit(False).alias("a_full"), F.lit(False).alias("b_full"), *EDGE),
        "links",
    )
    joined: list[DataFrame] = []
    sizes = F.broadcast(sizes)
    for _ in range(max_rounds):
        # where each open part reaches full size: the first few points decide
        nearest = Window.partitionBy("run", "part").orderBy("a", "id")
        heads = (
            open_.withColumn("rn", F.row_number().over(nearest))
            .where(F.col("rn") <= largest)
            .withColumn("reached", F.sum("weight").over(nearest))
            .join(sizes, "run")
        )
        full_at = heads.groupBy("run", F.col("part").alias("v")).agg(
            F.min(F.when(F.col("reached") >= F.col("min_cluster_size"), F.col("a"))).alias("full_at")
        )
        ends = edges.select("run", F.col("a").alias("v"), F.col("b").alias("o"), F.col("a_full").alias("v_full"), F.col("b_full").alias("o_full"), *EDGE).unionByName(
            edges.select("run", F.col("b").alias("v"), F.col("a").alias("o"), F.col("b_full").alias("v_full"), F.col("a_full").alias("o_full"), *EDGE)
        )
        way_out = (
            ends.where(~F.col("v_full"))
            .groupBy("run", "v")
            .agg(F.min(F.struct(*EDGE, "o", "o_full")).alias("m"))
            .select("run", "v", _edge("m.w", "m.src", "m.dst").alias("out"), F.col("m.o").alias("o"), F.col("m.o_full").alias("o_full"))
        )
        full = F.col("full_at").isNotNull() & (F.col("out").isNull() | (F.col("full_at") < F.col("out")))
        parts = scratch.table(
            full_at.join(way_out, ["run", "v"], "left").withColumn("full", full), "parts"
        )
        other = parts.select("run", F.col("v").alias("o"), F.col("full").alias("other_full"), F.col("o").alias("back"))
        stays = F.col("full") | F.col("o").isNull()
        mutual = (~F.col("other_full")) & (F.col("back") == F.col("v")) & (F.col("v") < F.col("o"))
        parent = parts.join(other, ["run", "o"], "left").select(
            "run", "v", F.when(stays | F.coalesce(mutual, F.lit(False)), F.col("v")).otherwise(F.col("o")).alias("p")
        )
        # cores of earlier rounds are roots as well
        earlier = parts.where(F.col("o_full") & ~F.col("full")).select("run", F.col("o").alias("v")).distinct()
        roots = find_roots(parent.unionByName(earlier.withColumn("p", F.col("v"))), scratch)
        root_full = parts.where("full").select("run", F.col("v").alias("p"), F.lit(True).alias("root_full")).unionByName(
            earlier.select("run", F.col("v").alias("p"), F.lit(True).alias("root_full"))
        )
        fate = scratch.table(
            parts.join(roots, ["run", "v"])
            .join(root_full, ["run", "p"], "left")
            .select(
                "run", F.col("v").alias("part"), F.col("p").alias("root"), "full", "full_at",
                F.when(F.col("p") != F.col("v"), F.col("out")).alias("out"),
                F.coalesce("root_full", F.lit(False)).alias("root_full"),
                (F.col("out").isNull() & ~F.col("full")).alias("dead"),
            ),
            "fate",
        )
        told = open_.join(fate, ["run", "part"]).withColumn(
            "a", F.greatest("a", F.when(F.col("full"), F.col("full_at")).otherwise(F.col("out")))
        )
        told = scratch.table(
            told.where(~F.col("dead")).select("run", "id", "weight", "a", F.col("root").alias("part"), "root_full"),
            "told",
            watch=~F.col("root_full"),
        )
        joined.append(told.where("root_full").select("run", "id", "weight", "part", F.col("a").alias("e")))
        side = fate.select("run", "part", "root", "root_full")
        left = side.withColumnsRenamed({"part": "a", "root": "ra", "root_full": "ra_full"})
        right = side.withColumnsRenamed({"part": "b", "root": "rb", "root_full": "rb_full"})
        edges = scratch.table(
            edges.join(left, ["run", "a"], "left")
            .join(right, ["run", "b"], "left")
            .select(
                "run",
                F.coalesce("ra", "a").alias("a"),
                F.coalesce("rb", "b").alias("b"),
                F.coalesce("ra_full", "a_full").alias("a_full"),
                F.coalesce("rb_full", "b_full").alias("b_full"),
                *EDGE,
            )
            .where("a <> b"),
            "links",
            replaces=edges,
        )
        open_ = told.where(~F.col("root_full")).select("run", "id", "weight", "a", "part")
        if not scratch.watched(told):
            break
    else:
        raise RuntimeError(f"parts still open after {max_rounds} rounds")
    gathered = joined[0]
    for part in joined[1:]:
        gathered = gathered.unionByName(part)
    return scratch.table(gathered, "gathered"), edges.select("run", "a", "b", *EDGE)


def density(edge):
    """1 / distance, infinite at distance 0; 0 where there is no edge."""
    w = edge.getField("w")
    return F.when(w.isNull(), 0.0).when(w == 0, float("inf")).otherwise(1 / F.when(w != 0, w))


def condensed_hierarchy(gathered: DataFrame, links: DataFrame, scratch: Scratch) -> tuple[DataFrame, DataFrame]:
    """The tree of cores as a table of nodes, and ``(run, id, weight, node, level)`` for every gathered point.

    ``nodes(run, node, e, up, birth)``: cores have numbers below that of noise and no edge ``e``;
    a merge has the edge that makes it; ``birth`` is the density at which the node
    becomes part of ``up``.  A point belongs to the last node on its core's way up
    that is there before the point's own edge.
    """
    part = gathered.select("run", "part").distinct()
    cores = scratch.table(part.withColumn("core", NOISE - 1 - F.monotonically_increasing_id()), "cores")
    end = lambda x: cores.select("run", F.col("part").alias(x), F.col("core").alias(f"core_{x}"))
    links = scratch.table(
        links.join(end("a"), ["run", "a"]).join(end("b"), ["run", "b"]).select(
            "run", F.monotonically_increasing_id().alias("id"), F.col("core_a").alias("a"), F.col("core_b").alias("b"), *EDGE
        ),
        "core_links",
    )
    points = gathered.join(cores, ["run", "part"]).select("run", "id", "weight", "core", "e")
    empty = F.lit(None)
    if Scratch.rows(links):
        merges, first = merge_tree(links, scratch)
        above = merges.select(F.col("id").alias("up"), F.col("e").alias("up_e"))
        nodes = merges.select("run", F.col("id").alias("node"), "e", "up").join(above, "up", "left")
        first = first.select("run", F.col("v").alias("core"), F.col("id").alias("at"), F.col("e").alias("at_e"))
        alone = cores.join(first, ["run", "core"], "left").select(
            "run", F.col("core").alias("node"), empty.cast(nodes.schema["e"].dataType).alias("e"), F.col("at").alias("up"), F.col("at_e").alias("up_e")
        )
        nodes = nodes.select("run", "node", "e", "up", "up_e").unionByName(alone)
        nodes = nodes.select("run", "node", "e", "up", density(F.col("up_e")).alias("birth"))
        met = points.join(first, ["run", "core"], "left")
        stays = F.col("at").isNull() | ~(F.col("at_e") < F.col("e"))
        here = met.where(stays).select("run", "id", "weight", "e", F.col("core").alias("node"))
        higher = last_below(met.where(~stays).select("run", "id", "weight", "e", "at"), jumps(merges, scratch), scratch)
        placed = here.unionByName(higher.withColumnRenamed("at", "node"))
    else:
        kind = points.schema["e"].dataType
        nodes = cores.select("run", F.col("core").alias("node"), empty.cast(kind).alias("e"), empty.cast("long").alias("up"), F.lit(0.0).alias("birth"))
        placed = points.withColumnRenamed("core", "node")
    placed = placed.select("run", "id", "weight", "node", density(F.col("e")).alias("level"))
    return scratch.table(nodes, "nodes"), scratch.table(placed, "placed")


def select_clusters(nodes: DataFrame, placed: DataFrame, scratch: Scratch) -> DataFrame:
    """``(method, node, cluster)`` for every node inside a chosen one, by excess of mass and by leaves.

    A node's stability is the density its points have beyond its birth.  From the
    leaves up a node is chosen if it is as stable as the best choice below it; of
    chosen nodes the highest counts.  The node that holds a whole run is no cluster.
    """
    sums = placed.groupBy("node").agg(
        F.sum("weight").cast("double").alias("weight"), F.sum(F.col("weight") * F.col("level")).alias("level")
    )
    kids = nodes.where("up IS NOT NULL").groupBy(F.col("up").alias("node")).agg(F.min("node").alias("c1"), F.max("node").alias("c2"))
    ends = nodes.where("up IS NULL").groupBy("run").agg((F.count(F.lit(1)) == 1).alias("one_end"))
    full = nodes.join(sums, "node", "left").join(kids, "node", "left").join(F.broadcast(ends), "run")  # one row a run
    full = scratch.table(
        full.select(
            "node", "up", "birth", density(F.col("e")).alias("own"), "c1", "c2", (F.col("up").isNull() & F.col("one_end")).alias("whole"),
            F.coalesce("weight", F.lit(0.0)).alias("weight"), F.coalesce("level", F.lit(0.0)).alias("level"),
        ),
        "tree",
    )
    none = F.lit(None).cast("double")
    total = fold_up(full.select("node", none.alias("low"), F.col("weight").alias("add"), "c1", "c2"), scratch)
    inside = F.col("value") - F.col("weight")
    stable = F.col("level") - F.col("weight") * F.col("birth")
    stable = F.when(F.col("c1").isNull(), stable).otherwise(stable + inside * (F.col("own") - F.col("birth")))
    full = scratch.table(
        full.join(total, "node").select("node", "up", "c1", "c2", "whole", F.when(F.isnan(stable), 0.0).otherwise(stable).alias("stable")),
        "stable",
        replaces=full,
    )
    leaf = F.col("c1").isNull()
    low = F.when(~F.col("whole"), F.col("stable"))
    best = fold_up(full.select("node", low.alias("low"), F.when(~leaf | F.col("whole"), 0.0).alias("add"), "c1", "c2"), scratch)
    of = lambda c: best.select(F.col("node").alias(c), F.col("value").alias(f"best_{c}"))
    judged = full.join(of("c1"), "c1", "left").join(of("c2"), "c2", "left")
    chosen = ~F.col("whole") & (leaf | ~(F.col("best_c1") + F.col("best_c2") > F.col("stable")))
    mass = topmost(judged, chosen, scratch).select(F.lit("eom").alias("method"), "node", F.col("top").alias("cluster"))
    leaves = full.where(~F.col("whole") & leaf).select(F.lit("leaf").alias("method"), "node", F.col("node").alias("cluster"))
    return mass.unionByName(leaves)


def cluster_members(
    nodes: DataFrame, placed: DataFrame, methods: dict[int, list[tuple[int, str]]], scratch: Scratch
) -> DataFrame:
    """(trial, id, cluster) for the points inside a selected cluster.

    ``methods`` names the trials of every run as ``(trial, method)``.
    """
    rows = [(trial, run, method) for run, trials in methods.items() for trial, method in trials]
    asked = F.broadcast(placed.sparkSession.createDataFrame(rows, "trial int, run int, method string"))  # the grid
    chosen = select_clusters(nodes, placed, scratch)
    return placed.join(chosen, "node").join(asked, ["run", "method"]).select("trial", "id", "cluster")


def clusters_of_runs(
    forest: DataFrame, points: DataFrame, sizes: dict[int, int], methods: dict[int, list[tuple[int, str]]]
) -> DataFrame:
    """(trial, id, cluster) of ``cluster_members``, from trees and points that one task a run can hold.

    ``forest(run, src, dst, w)``, ``points(run, id, weight, core)``; ``sizes`` has each run's ``min_cluster_size``.
    """

    def walk(forest: pa.Table, points: pa.Table) -> pa.Table:
        parts = []
        if points.num_rows:
            run = int(values(points, "run")[0])
            tree = CoreTree(sizes[run], *(values(points, c) for c in ("id", "weight", "core")), *(values(forest, c) for c in EDGE))
            for method in sorted({method for _, method in methods[run]}):
                ids, cluster = tree.members(method)
                for trial in (t for t, m in methods[run] if m == method):
                    parts.append(pa.table({
                        "trial": pa.array(np.full(len(ids), trial), pa.int32()),
                        "id": pa.array(ids, pa.int64()), "cluster": pa.array(cluster, pa.int64()),
                    }))
        return pa.concat_tables(parts) if parts else pa.table({
            "trial": pa.array([], pa.int32()), "id": pa.array([], pa.int64()), "cluster": pa.array([], pa.int64())
        })

    points = points.withColumn("run", F.col("run").alias("run"))  # both sides may come from one table of runs
    return forest.groupBy("run").cogroup(points.groupBy("run")).applyInArrow(walk, "trial int, id long, cluster long")


class CoreTree:
    """The tree of cores of one spanning forest, merged edge by edge.

    ``node`` and ``joins`` tell each point's node and the edge by which it joins it: -1 for the point's own
    core distance; ``node`` is -1 for points that join no part of full size.  Rows of one id are one point.
    """

    def __init__(self, full: int, ids, weight, core, w, src, dst):
        self.ids, rows, self.which = np.unique(ids, return_index=True, return_inverse=True)
        self.weight = np.zeros(len(self.ids), dtype=np.int64)
        np.add.at(self.weight, self.which, weight)
        ids = self.ids
        by_edge = np.lexsort((dst, src, w))
        self.w, a, b = w[by_edge], np.searchsorted(self.ids, src[by_edge]), np.searchsorted(self.ids, dst[by_edge])
        self.up, self.edge = [], []  # by node: the one above, and the edge that made it, -1 for cores
        root = list(range(len(ids)))
        ring = root.copy()  # points of an open part, one after the other
        held, joins, node = self.weight.tolist(), [-1] * len(ids), [-1] * len(ids)
        of = [-1] * len(ids)  # by root: the node of a part of full size

        def new(edge: int) -> int:
            self.up.append(-1)
            self.edge.append(edge)
            return len(self.up) - 1

        def join(first: int, to: int, edge: int) -> None:
            one = first
            while True:
                node[one], joins[one] = to, edge
                one = ring[one]
                if one == first:
                    return

        for i in np.flatnonzero(self.weight >= full).tolist():
            of[i] = node[i] = new(-1)
        for start in range(0, len(a), EDGES_AT_ONCE):
            some = slice(start, start + EDGES_AT_ONCE)
            for edge, (i, j) in enumerate(zip(a[some].tolist(), b[some].tolist()), start):
                while root[i] != i:
                    root[i] = root[root[i]]
                    i = root[i]
                while root[j] != j:
                    root[j] = root[root[j]]
                    j = root[j]
                if held[i] < held[j]:  # so a part of full size comes before an open one
                    i, j = j, i
                one, two = of[i], of[j]
                if one >= 0 and two >= 0:
                    of[i] = self.up[one] = self.up[two] = new(edge)
                elif one >= 0:
                    join(j, one, edge)
                else:
                    ring[i], ring[j] = ring[j], ring[i]
                    if held[i] + held[j] >= full:
                        of[i] = new(-1)
                        join(i, of[i], edge)
                root[j] = i
                held[i] += held[j]
        self.up, self.edge = np.array(self.up, dtype=np.int64), np.array(self.edge, dtype=np.int64)
        self.node, self.joins, self.core = np.array(node, dtype=np.int64), np.array(joins, dtype=np.int64), core[rows]

    def clusters(self, method: str) -> np.ndarray:
        """By node the chosen node that it lies in, -1 without one; as ``select_clusters`` does."""
        n = len(self.up)
        inside, top = self.up >= 0, np.full(n, -1)
        leaf = self.edge < 0
        whole = ~inside & (np.count_nonzero(~inside) == 1)
        if method == "leaf":
            return np.where(leaf & ~whole, np.arange(n), top)
        if method != "eom":
            return top
        with np.errstate(divide="ignore", invalid="ignore"):
            density = 1.0 / np.abs(np.append(self.w, 0.0))  # the last one is not used
            birth = np.where(inside, density[self.edge[self.up]], 0.0)
            own = density[self.edge]
            known = self.node >= 0
            at, weight = self.node[known], self.weight[known].astype(float)
            level = np.where(self.joins < 0, 1.0 / np.abs(self.core), density[self.joins])[known]
            mass = np.bincount(at, weight, minlength=n)
            levels = np.bincount(at, weight * level, minlength=n)
            total = mass.copy()
            for node in np.flatnonzero(inside).tolist():  # a node comes before the one above it
                total[self.up[node]] += total[node]
            stable = levels - mass * birth
            stable = np.where(leaf, stable, stable + (total - mass) * (own - birth))
            stable = np.where(np.isnan(stable), 0.0, stable)
        below = np.zeros(n)
        chosen = np.zeros(n, dtype=bool)
        for node in range(n):
            if leaf[node]:
                chosen[node], best = not whole[node], 0.0 if whole[node] else stable[node]
            else:
                chosen[node] = not whole[node] and not below[node] > stable[node]
                best = below[node] if whole[node] else max(stable[node], below[node])
            if inside[node]:
                below[self.up[node]] += best
        for node in range(n - 1, -1, -1):
            above = top[self.up[node]] if inside[node] else -1
            top[node] = above if above >= 0 else node if chosen[node] else -1
        return top

    def members(self, method: str) -> tuple[np.ndarray, np.ndarray]:
        """Ids of the points inside a chosen node, and the node."""
        cluster = np.append(self.clusters(method), -1)[self.node][self.which]
        inside = cluster >= 0
        return self.ids[self.which][inside], cluster[inside]

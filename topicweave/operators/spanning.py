"""Mutual reachability and minimum spanning trees.

Tables carry a ``run`` column: one loop serves every setting of a parameter
grid.  Edges have ``src < dst`` and are ordered by ``(w, src, dst)``, so the tree
is unique.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from topicweave.operators.blocks import (
    BLOCK_ROWS,
    STRIPE_ROWS,
    block_join,
    exact_pairs,
    matrix,
    slack,
    slices,
    squared_distances,
    values,
)
from topicweave.operators.neighbours import Cells, reachable
from topicweave.scratch import Scratch

EDGE = ["w", "src", "dst"]

# rows by cells that may be visited, each with its vector, held at once inside a task
ROUTED_AT_ONCE = 1 << 17
# steps towards the root between two tables; the way shrinks by HOPS + 1 each time
HOPS = 3
# rows of a graph or tree, all runs together, up to which a task takes the whole of a run; beyond, rounds of joins do
TASK_ROWS = 1 << 20


def core_distance(knn: DataFrame, min_samples: int) -> DataFrame:
    """(id, core): distance to the ``min_samples``-th neighbour."""
    return knn.where(F.col("rank") == min_samples).select(
        F.col("src").alias("id"), F.col("dist").alias("core")
    )


def core_distances(knn: DataFrame, min_samples: list[int], copies: DataFrame | None = None) -> DataFrame:
    """(run, id, core) for several settings at once; ``run`` is the setting.

    With ``copies(id, copies)`` a neighbour counts as often as its vector
    occurs, and so do the point's own copies.
    """
    runs = F.explode(F.array(*[F.lit(m) for m in sorted(set(min_samples))])).alias("run")
    if copies is None:
        return knn.select("*", runs).where("rank = run").select(
            "run", F.col("src").alias("id"), F.col("dist").alias("core")
        )
    weighted = knn.join(copies.select(F.col("id").alias("dst"), "copies"), "dst")
    in_order = Window.partitionBy("src").orderBy("rank")
    reached = weighted.withColumn("seen", F.sum("copies").over(in_order)).groupBy("src").agg(
        F.sort_array(F.collect_list(F.struct("seen", "dist"))).alias("near")
    )
    # a single distinct point has no list at all
    joined = copies.select("id", "copies", runs).join(
        reached.withColumnRenamed("src", "id"), "id", "left"
    )
    enough = F.filter("near", lambda x: x["seen"] + F.col("copies") - 1 >= F.col("run"))
    return joined.select(
        "run",
        "id",
        F.when(F.col("copies") > F.col("run"), 0.0).otherwise(F.get(enough, F.lit(0))["dist"]).alias("core"),
    ).where(F.col("core").isNotNull())


def mutual_reachability(knn: DataFrame, core: DataFrame) -> DataFrame:
    """(src, dst, w) with src < dst and w = greatest(core(src), core(dst), dist).

    A ``run`` column of ``core`` is kept.
    """
    keys = [c for c in ("run",) if c in core.columns]
    pairs = knn.groupBy(F.least("src", "dst").alias("src"), F.greatest("src", "dst").alias("dst")).agg(
        F.min("dist").alias("dist")
    )
    first = core.select(*keys, F.col("id").alias("src"), F.col("core").alias("core_src"))
    second = core.select(*keys, F.col("id").alias("dst"), F.col("core").alias("core_dst"))
    return (
        pairs.join(first, "src")
        .join(second, [*keys, "dst"])
        .select(*keys, "src", "dst", F.greatest("core_src", "core_dst", "dist").alias("w"))
    )


def find_roots(parent: DataFrame, scratch: Scratch) -> DataFrame:
    """(run, v, p) with p the root of v; roots are their own parents."""
    parent = scratch.table(parent, "parent")
    while True:
        up = parent.select("run", F.col("v").alias("p"), F.col("p").alias("pp"))
        step = parent
        for _ in range(HOPS):
            step = step.select("run", "v", "p").join(up, ["run", "p"]).select(
                "run", "v", F.col("pp").alias("p"), (F.col("pp") != F.col("p")).alias("moved")
            )
        parent = scratch.table(step, "roots", replaces=parent, watch=F.col("moved"))
        if not scratch.watched(parent):
            return parent.drop("moved")


def both_ways(edges: DataFrame, a: str, b: str, *more: str) -> DataFrame:
    """Every edge seen from either end as (run, v, o, w, src, dst, ...)."""
    return edges.select("run", F.col(a).alias("v"), F.col(b).alias("o"), *EDGE, *more).unionByName(
        edges.select("run", F.col(b).alias("v"), F.col(a).alias("o"), *EDGE, *more)
    )


def least_edges(seen: DataFrame) -> DataFrame:
    """(run, v, o, w, src, dst): the least edge of every vertex, reduced map-side."""
    return (
        seen.groupBy("run", "v").agg(F.min(F.struct(*EDGE, "o")).alias("e")).select("run", "v", "e.o", *[f"e.{c}" for c in EDGE])
    )


def hooks(best: DataFrame) -> DataFrame:
    """(run, v, p): each vertex hangs on the other end of its least edge."""
    other = best.select("run", F.col("v").alias("o"), F.col("o").alias("back"))
    mutual = (F.col("back") == F.col("v")) & (F.col("v") < F.col("o"))
    return best.join(other, ["run", "o"], "left").select(
        "run", "v", F.when(mutual, F.col("v")).otherwise(F.col("o")).alias("p")
    )


def minimum_spanning_forest(
    edges: DataFrame,
    scratch: Scratch | None = None,
    search: "OutsideSearch | None" = None,
    max_rounds: int = 64,
) -> DataFrame:
    """Minimum spanning forest of ``edges(src, dst, w)`` by Boruvka rounds.

    Each round joins every component to the one across its least edge and
    contracts the graph, so at most half of the components are left.  With
    ``search`` a component also considers edges that are not listed.  A graph of at most
    ``TASK_ROWS`` edges is contracted by one task a run, as far as the lists tell
    its least edges for certain; only the search for others is a round of its own then.
    """
    scratch = scratch or Scratch(edges.sparkSession, "forest")
    with_run = "run" in edges.columns
    if not with_run:
        edges = edges.withColumn("run", F.lit(0))
    edges = edges.where("src <> dst").select(
        "run", F.least("src", "dst").alias("src"), F.greatest("src", "dst").alias("dst"), "w"
    )
    live = scratch.table(edges.withColumns({"a": F.col("src"), "b": F.col("dst")}), "live")
    tree = []
    searched = None  # edges from outside the lists; with them the least edge of every component is known
    for _ in range(max_rounds):
        if scratch.rows(live) <= TASK_ROWS:
            told = scratch.table(contracted(live, searched, search), "contracted", watch=F.col("kind") == "live")
            tree.append(told.where("kind = 'tree'").select("run", *EDGE))
            if search is None:
                break
            search.relabel(told.where("kind = 'root'").select("run", F.col("a").alias("v"), F.col("b").alias("p")))
            live = told.where("kind = 'live'").select("run", "a", "b", *EDGE)
            live._counts = {"rows": scratch.watched(told)}
            listed = scratch.table(least_edges(both_ways(live, "a", "b")), "listed")
            extra = search.outside_edges(listed)
            if not scratch.rows(listed) and (extra is None or not scratch.rows(extra)):
                break
            searched = listed if extra is None else extra
            continue
        seen = both_ways(live, "a", "b")
        if search is not None:
            listed = scratch.table(least_edges(seen), "listed")
            extra = search.outside_edges(listed)
            best = listed
            if extra is not None or search.resting:
                rows = listed if extra is None else least_edges(listed.unionByName(extra))
                best = scratch.table(search.moving(rows), "best")
        else:
            best = scratch.table(least_edges(seen), "best")
        if not scratch.rows(best):
            break
        tree.append(best.select("run", *EDGE).distinct())
        parent = hooks(best)
        if search is not None and search.resting:
            parent = parent.unionByName(search.resting_roots())
        roots = find_roots(parent, scratch)
        if search is not None:
            search.relabel(roots)
        a = roots.select("run", F.col("v").alias("a"), F.col("p").alias("ra"))
        b = roots.select("run", F.col("v").alias("b"), F.col("p").alias("rb"))
        # of parallel edges only the least can matter
        joined = (
            live.join(a, ["run", "a"])
            .join(b, ["run", "b"])
            .where("ra <> rb")
            .groupBy("run", F.least("ra", "rb").alias("a"), F.greatest("ra", "rb").alias("b"))
            .agg(F.min(F.struct(*EDGE)).alias("e"))
            .select("run", "a", "b", "e.*")
        )
        live = scratch.table(joined, "live", replaces=live)
        if search is None and not scratch.rows(live):
            break
    else:
        raise RuntimeError(f"no spanning forest after {max_rounds} rounds")
    if not tree:
        forest = live.select("run", *EDGE)
    else:
        forest = tree[0]
        for part in tree[1:]:
            forest = forest.unionByName(part)
    columns = ["run"] if with_run else []
    return scratch.table(forest.select(*columns, "src", "dst", "w"), "forest")


def contracted(live: DataFrame, searched: DataFrame | None, search: OutsideSearch | None) -> DataFrame:
    """Rows ``(run, kind, a, b, w, src, dst)`` of a graph that is contracted by one task a run.

    ``tree`` rows are edges of the forest, ``root`` rows tell the root ``b`` of each component ``a``,
    ``live`` rows are the edges between roots that are left.  A component joins the one across
    its least edge if all lists of its points reach beyond that; with ``searched``, the edges found
    outside the lists, every component that was searched does so once.  Others wait for the next search.
    """
    edges = live.select("run", "a", "b", *EDGE)
    if searched is not None:
        edges = edges.unionByName(searched.select("run", F.col("v").alias("a"), F.col("o").alias("b"), *EDGE))
    if search is None:
        ends = live.sparkSession.createDataFrame([], "run int, comp long, list_end double")
    else:
        met = edges.select("run", F.col("a").alias("comp")).union(edges.select("run", "b")).distinct()
        ends = search.labels.join(met, ["run", "comp"], "left_semi").groupBy("run", "comp").agg(F.min("list_end").alias("list_end"))
    known, resting = searched is not None, dict(search.resting) if search is not None else {}

    def contract(edges: pa.Table, ends: pa.Table) -> pa.Table:
        if not edges.num_rows:
            return _told({})
        run = int(values(edges, "run")[0])
        w, src, dst = (values(edges, c) for c in EDGE)
        order = np.lexsort((dst, src, w))  # from here on the number of an edge is its place in the order
        w, src, dst = w[order], src[order], dst[order]
        new = np.ones(len(w), dtype=bool)
        new[1:] = (w[1:] != w[:-1]) | (src[1:] != src[:-1]) | (dst[1:] != dst[:-1])
        w, src, dst, order = w[new], src[new], dst[new], order[new]
        names, place = np.unique(np.concatenate([values(edges, "a"), values(edges, "b")]), return_inverse=True)
        a, b = place[: edges.num_rows][order], place[edges.num_rows :][order]
        reach = np.full(len(names), np.inf)
        if ends.num_rows:
            reach[np.searchsorted(names, values(ends, "comp"))] = values(ends, "list_end")
        root, left, taken, sure = np.arange(len(names)), np.arange(len(w)), [], known
        while True:
            left = left[a[left] != b[left]]
            least = np.full(len(names), len(w))
            np.minimum.at(least, a[left], left)
            np.minimum.at(least, b[left], left)
            comps = np.flatnonzero(least < len(w))
            told = w[least[comps]] < reach[comps]
            comps = comps[told | (names[comps] != resting.get(run)) if sure else told]
            if not len(comps):
                break
            sure, edge = False, least[comps]
            taken.append(np.unique(edge))
            up = np.arange(len(names))
            up[comps] = a[edge] + b[edge] - comps
            back = comps[(up[up[comps]] == comps) & (comps < up[comps])]
            up[back] = back
            while (up[up] != up).any():
                up = up[up]
            np.minimum.at(reach, up, reach.copy())
            root, a, b = up[root], up[a], up[b]
        tree = np.concatenate(taken) if taken else np.zeros(0, dtype=np.int64)
        # of parallel edges the least comes first
        low, high = np.minimum(a[left], b[left]), np.maximum(a[left], b[left])
        left = left[np.unique(low * len(names) + high, return_index=True)[1]]
        return _told({
            "tree": (run, src[tree], dst[tree], w[tree], src[tree], dst[tree]),
            "root": (run, names, names[root], np.zeros(len(names)), names, names),
            "live": (run, names[a[left]], names[b[left]], w[left], src[left], dst[left]),
        })

    schema = "run int, kind string, a long, b long, w double, src long, dst long"
    return edges.groupBy("run").cogroup(ends.groupBy("run")).applyInArrow(contract, schema)


def _told(parts: dict[str, tuple]) -> pa.Table:
    names = ("a", "b", "w", "src", "dst")
    kinds = (pa.int64(), pa.int64(), pa.float64(), pa.int64(), pa.int64())
    out = [
        pa.table({
            "run": pa.array(np.full(len(columns[0]), run), pa.int32()), "kind": pa.array([kind] * len(columns[0]), pa.string()),
            **{name: pa.array(x, t) for name, x, t in zip(names, columns, kinds)},
        })
        for kind, (run, *columns) in parts.items()
    ]
    return pa.concat_tables(out) if out else _told({"tree": (0, *[np.zeros(0)] * 5)})


class OutsideSearch:
    """Exact search for edges that the neighbour lists do not hold.

    A point's list ends at some distance; every point beyond it is at least
    that far away.  So only points whose list ends before the best listed edge
    of their component can have a better one, and they look no farther than
    that edge.

    A component of more than half of a run's points rests: the others join it or each other by
    their own least edges, so it needs none in that round, and its points need not be searched.
    """

    def __init__(
        self,
        cells: Cells,
        core: DataFrame,
        list_end: DataFrame,
        scratch: Scratch,
        block_rows: int = BLOCK_ROWS,
    ):
        self.cells, self.scratch, self.block_rows = cells, scratch, block_rows
        self.moved: list[int] = []  # candidates whose vectors were sent, by search
        self.resting: dict[int, int] = {}  # by run: the component that was left out of the last search
        points = cells.points.select("id", "cell").join(core, "id").join(list_end, "id", "left")
        self.labels = scratch.table(
            points.select("run", "id", "cell", "core", F.coalesce("list_end", F.lit(0.0)).alias("list_end"), F.col("id").alias("comp")),
            "labels",
        )

    def relabel(self, roots: DataFrame) -> None:
        moved = self.labels.join(
            roots.select("run", F.col("v").alias("comp"), F.col("p").alias("root")), ["run", "comp"], "left"
        )
        self.labels = self.scratch.table(
            moved.select("run", "id", "cell", "core", "list_end", F.coalesce("root", "comp").alias("comp")),
            "labels",
            replaces=self.labels,
        )

    def _rests(self, component: str):
        rests = F.lit(False)
        for run, comp in self.resting.items():
            rests = rests | ((F.col("run") == run) & (F.col(component) == comp))
        return rests

    def moving(self, best: DataFrame) -> DataFrame:
        """The least edges of the components that do not rest."""
        return best.where(~self._rests("v"))

    def resting_roots(self) -> DataFrame:
        """(run, v, p): components that rest are roots."""
        return self.scratch.spark.createDataFrame([(r, c, c) for r, c in self.resting.items()], "run int, v long, p long")

    def outside_edges(self, listed: DataFrame) -> DataFrame | None:
        """(run, v, o, w, src, dst): a least unlisted edge per component, where one may be better."""
        scratch, cells = self.scratch, self.cells
        pivots, radius, size = cells.pivots, cells.radius, cells.size
        # runs that are down to one component have nothing outside
        parts = self.labels.groupBy("run", "comp").agg(F.count(F.lit(1)).alias("n")).groupBy("run").agg(
            F.count(F.lit(1)).alias("parts"), F.sum("n").alias("points"), F.max(F.struct("n", "comp")).alias("most")
        )
        several = [row for row in parts.collect() if row.parts > 1]
        split = [row.run for row in several]
        self.resting = {row.run: row.most.comp for row in several if 2 * row.most.n > row.points}
        if not split:
            return None
        best = listed.select("run", F.col("v").alias("comp"), F.col("w").alias("bound"))
        open_points = scratch.table(
            self.labels.where(F.col("run").isin(split) & ~self._rests("comp"))
            .join(best, ["run", "comp"], "left")
            .withColumn("bound", F.coalesce("bound", F.lit(float("inf"))))
            .where(F.col("list_end") <= F.col("bound")),
            "open",
        )
        if not scratch.rows(open_points):
            return None
        vectors = cells.points.select("id", "vec", F.col("cell").alias("at"))

        def of_cells(rows: DataFrame) -> DataFrame:
            """Vectors of the cells that ``rows`` name; the others do not move."""
            some = F.broadcast(rows.select(F.col("cell").alias("at")).distinct())  # at most one row a cell
            return vectors.join(some, "at", "left_semi").drop("at")

        # the pivots are points: the nearest one outside bounds the best edge
        pivot_ids = cells.pivot_ids.tolist()
        runs: dict[int, dict[int, tuple[int, float]]] = {}
        for row in self.labels.where(F.col("id").isin(pivot_ids)).select("run", "id", "comp", "core").collect():
            runs.setdefault(row.run, {})[row.id] = (row.comp, row.core)
        pivot_comp = {r: np.array([v.get(i, (-1, np.inf))[0] for i in pivot_ids]) for r, v in runs.items()}
        pivot_core = {r: np.array([v.get(i, (-1, np.inf))[1] for i in pivot_ids]) for r, v in runs.items()}
        # a cell whose points share one component holds nothing for that component
        whole = {}
        one = self.labels.groupBy("run", "cell").agg(F.min("comp").alias("lo"), F.max("comp").alias("hi"))
        for row in one.where("lo = hi").collect():
            whole.setdefault(row.run, np.full(len(pivots), -1))[row.cell] = row.lo

        def by_pivot(batches):
            for table in (part for batch in batches for part in slices(batch, len(pivots))):
                rows, run, comp = matrix(table, "vec"), values(table, "run"), values(table, "comp")
                core, bound = values(table, "core"), values(table, "bound").copy()
                far = np.sqrt(np.maximum(squared_distances(rows, pivots), 0.0)) * (1 + 1e-9) + 1e-9
                for r in np.unique(run):
                    mine = np.nonzero(run == r)[0]
                    if r not in pivot_comp:
                        continue
                    w = np.maximum(np.maximum(far[mine], pivot_core[r][None, :]), core[mine, None])
                    w[pivot_comp[r][None, :] == comp[mine, None]] = np.inf
                    bound[mine] = np.minimum(bound[mine], w.min(axis=1))
                yield from table.select(["run", "comp"]).append_column("bound", pa.array(bound)).to_batches()

        placed = open_points.join(of_cells(open_points), "id").select("run", "id", "cell", "core", "comp", "bound", "vec")
        bounds = (
            placed.select("run", "comp", "core", "bound", "vec")
            .mapInArrow(by_pivot, "run int, comp long, bound double")
            .groupBy("run", "comp")
            .agg(F.min("bound").alias("bound"))
        )

        def route(batches):
            # a row may look into all cells: rows are taken for few entries at once
            for table in (part for batch in batches for part in slices(batch, len(pivots), ROUTED_AT_ONCE)):
                rows, own, bound = matrix(table, "vec"), values(table, "own"), values(table, "bound")
                wanted = reachable(rows, own, bound, pivots, radius) & (size > 0)[None, :]
                run, comp = values(table, "run"), values(table, "q_comp")
                for r in np.unique(run):
                    if r in whole:
                        mine = np.nonzero(run == r)[0]
                        wanted[mine] &= whole[r][None, :] != comp[mine, None]
                i, cell = np.nonzero(wanted)
                out = table.drop_columns(["own"]).take(pa.array(i)).rename_columns(
                    ["run", "q_id", "q_core", "q_comp", "bound", "q_vec"]
                )
                yield from out.append_column("cell", pa.array(cell.astype(np.int32))).to_batches()

        queries = (
            placed.drop("bound")
            .join(bounds, ["run", "comp"])
            .where(F.col("core") <= F.col("bound"))
            .select("run", F.col("id").alias("q_id"), F.col("core").alias("q_core"), F.col("comp").alias("q_comp"), "bound", "vec", F.col("cell").alias("own"))
            .mapInArrow(
                route,
                "run int, q_id long, q_core double, q_comp long, bound double, q_vec array<double>, cell int",
            )
        )
        queries = scratch.table(queries, "queries")
        # of a cell that is looked into, points whose own distance is beyond all bounds cannot be reached;
        # one row a run and cell
        visited = queries.groupBy("run", "cell").agg(F.max("bound").alias("farthest"))
        wanted = scratch.table(
            self.labels.join(F.broadcast(visited), ["run", "cell"]).where(F.col("core") <= F.col("farthest")).select(
                "run", "cell", F.col("id"), F.col("core").alias("c_core"), F.col("comp").alias("c_comp")
            ),
            "wanted",
        )
        self.moved.append(scratch.rows(wanted))
        candidates = wanted.join(of_cells(wanted), "id").withColumnsRenamed({"id": "c_id", "vec": "c_vec"})
        found = block_join(
            queries, candidates, _outside_kernel, "run int, v long, o long, w double, src long, dst long",
            cell=("run", "cell"), block_rows=self.block_rows,
        )
        outside = scratch.table(least_edges(found), "outside", replaces=queries)
        scratch.drop(wanted)
        scratch.drop(open_points)
        return outside


def _outside_kernel(chunk: pa.Table, block: pa.Table) -> pa.Table:
    """Per component of the chunk: the least edge into another component of the block."""
    parts = []
    if chunk.num_rows and block.num_rows:
        q, c = matrix(chunk, "q_vec"), matrix(block, "c_vec")
        q_id, q_core, q_comp = (values(chunk, n) for n in ("q_id", "q_core", "q_comp"))
        c_id, c_core, c_comp = (values(block, n) for n in ("c_id", "c_core", "c_comp"))
        bound = values(chunk, "bound")
        run = int(values(chunk, "run")[0])
        eps = np.sqrt(slack(q, c))
        for start in range(0, len(q), STRIPE_ROWS):
            rows = slice(start, start + STRIPE_ROWS)
            w = np.sqrt(np.maximum(squared_distances(q[rows], c), 0.0))
            np.maximum(w, q_core[rows, None], out=w)
            np.maximum(w, c_core[None, :], out=w)
            w[q_comp[rows, None] == c_comp[None, :]] = np.inf
            comps, which = np.unique(q_comp[rows], return_inverse=True)
            least = np.full(len(comps), np.inf)
            np.minimum.at(least, which, w.min(axis=1))
            limit = np.minimum(least[which], bound[rows]) + 2 * eps
            i, j = np.nonzero(w <= limit[:, None])
            i += start
            if not len(i):
                continue
            d = np.sqrt(exact_pairs(q, c, i, j))
            exact = np.maximum(np.maximum(d, q_core[i]), c_core[j])
            src, dst = np.minimum(q_id[i], c_id[j]), np.maximum(q_id[i], c_id[j])
            order = np.lexsort((dst, src, exact, q_comp[i]))
            first = order[np.unique(q_comp[i][order], return_index=True)[1]]
            parts.append((q_comp[i[first]], c_comp[j[first]], exact[first], src[first], dst[first]))
    v, o, w, src, dst = (
        (np.concatenate(p) for p in zip(*parts)) if parts else (np.zeros(0),) * 5
    )
    n = len(v)
    return pa.table({
        "run": pa.array(np.full(n, run if n else 0), pa.int32()),
        "v": pa.array(v.astype(np.int64)), "o": pa.array(o.astype(np.int64)),
        "w": pa.array(w.astype(np.float64)),
        "src": pa.array(src.astype(np.int64)), "dst": pa.array(dst.astype(np.int64)),
    })

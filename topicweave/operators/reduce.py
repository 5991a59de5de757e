"""Dimension reduction: fuzzy neighbour graph and force layout."""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.ml.feature import PCA
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from topicweave.operators.blocks import list_column, matrix, values
from topicweave.operators.neighbours import (
    CELL_ROWS,
    as_distance,
    assign_cells,
    collapse_copies,
    comparable,
    nearest_points,
)
from topicweave.scratch import Scratch

# Fixed values of the layout method: bisection steps and tolerance, smallest
# bandwidth as a share of the mean distance, negative samples per edge,
# gradient clip, spread of the starting positions.
BISECTION_STEPS, TOLERANCE, MIN_SCALE = 64, 1e-5, 1e-3
NEGATIVE_SAMPLES, CLIP, START_EXTENT = 5, 4.0, 10.0
# and the share of it in components that the vectors do not have
FLAT_SHARE = 0.01

# points per layout bucket
BUCKET_ROWS = 4096


def bandwidths(near: pd.Series, rho: pd.Series, mean_all: pd.Series, n_neighbors: int) -> np.ndarray:
    """Per point: sigma with sum(exp(-max(0, d - rho) / sigma)) = log2(n_neighbors)."""
    width = max((len(row) for row in near), default=1)
    gap = np.full((len(near), width), np.inf)
    for i, row in enumerate(near):
        gap[i, : len(row)] = row
    count = np.isfinite(gap).sum(axis=1)
    mean = np.where(np.isfinite(gap), gap, 0.0).sum(axis=1) / (count + 1)
    gap = np.maximum(gap - rho.to_numpy()[:, None], 0.0)
    target = np.log2(n_neighbors)
    low, high, mid = np.zeros(len(gap)), np.full(len(gap), np.inf), np.ones(len(gap))
    open_ = np.ones(len(gap), dtype=bool)
    for _ in range(BISECTION_STEPS):
        total = np.exp(-gap / mid[:, None]).sum(axis=1)
        open_ &= np.abs(total - target) >= TOLERANCE
        above, below = open_ & (total > target), open_ & (total <= target)
        high[above], low[below] = mid[above], mid[below]
        grown = np.where(np.isinf(high), mid * 2.0, (low + high) / 2.0)
        mid = np.where(open_, grown, mid)
    floor = MIN_SCALE * np.where(rho.to_numpy() > 0, mean, mean_all.to_numpy())
    return np.maximum(mid, floor)


def fuzzy_strengths(knn: DataFrame, n_neighbors: int) -> DataFrame:
    """(src, dst, rho, sigma, strength): directed edge strengths.

    ``n_neighbors`` counts the point itself; ranks beyond it are not used.
    """
    near = knn.where(F.col("rank") < n_neighbors).select("src", "dst", "dist")
    mean_all = near.agg(F.avg("dist")).scalar() * ((n_neighbors - 1.0) / n_neighbors)

    @F.pandas_udf("double")
    def sigma(d: pd.Series, rho: pd.Series, mean: pd.Series) -> pd.Series:
        return pd.Series(bandwidths(d, rho, mean, n_neighbors))

    # at most n_neighbors - 1 entries per list
    lists = near.groupBy("src").agg(
        F.collect_list(F.struct("dst", "dist")).alias("near"),
        F.coalesce(F.min(F.when(F.col("dist") > 0, F.col("dist"))), F.lit(0.0)).alias("rho"),
    )
    lists = lists.withColumn("sigma", sigma(F.array_sort("near.dist"), "rho", mean_all))
    gap = F.greatest(F.col("dist") - F.col("rho"), F.lit(0.0))
    return lists.select("src", "rho", "sigma", F.inline("near")).select(
        "src", "dst", "rho", "sigma",
        F.when(F.col("sigma") > 0, F.exp(-gap / F.col("sigma"))).otherwise(F.lit(1.0)).alias("strength"),
    )


def fuzzy_union(strengths: DataFrame) -> DataFrame:
    """(src, dst, w) with src < dst: a + b - ab of the two directed strengths."""
    a, b = F.max("strength"), F.min("strength")
    return (
        strengths.groupBy(F.least("src", "dst").alias("src"), F.greatest("src", "dst").alias("dst"))
        .agg(F.when(F.count(F.lit(1)) > 1, a + b - a * b).otherwise(a).alias("w"))
    )


def fuzzy_graph(knn: DataFrame, n_neighbors: int) -> DataFrame:
    """(src, dst, w) with src < dst: undirected edge strengths in (0, 1]."""
    return fuzzy_union(fuzzy_strengths(knn, n_neighbors))


def layout_curve(min_dist: float, spread: float = 1.0) -> tuple[float, float]:
    """(a, b) so that 1 / (1 + a x^(2b)) fits the wanted fall-off; Gauss-Newton."""
    x = np.linspace(0.0, 3.0 * spread, 300)[1:]
    want = np.where(x < min_dist, 1.0, np.exp(-(x - min_dist) / spread))
    p = np.array([0.0, 0.0])  # logs of a and b
    damp = 1e-2

    def residual(p):
        a, b = np.exp(p)
        return 1.0 / (1.0 + a * x ** (2 * b)) - want

    r = residual(p)
    for _ in range(200):
        a, b = np.exp(p)
        power = a * x ** (2 * b)
        slope = -power / (1.0 + power) ** 2
        jac = np.stack([slope, slope * 2 * b * np.log(x)], axis=1)
        hess = jac.T @ jac
        step = np.linalg.solve(hess + damp * np.diag(np.diag(hess)), -jac.T @ r)
        trial = residual(p + step)
        if (trial @ trial) < (r @ r):
            p, r, damp = p + step, trial, damp / 3
        else:
            damp *= 3
    a, b = np.exp(p)
    return float(a), float(b)


def principal_components(vectors: DataFrame, n_components: int) -> DataFrame:
    """(id, vec): projection on the first principal components, 0 for those beyond the coordinates."""
    first = vectors.select(F.size("vec").alias("n")).first()
    known = min(n_components, first.n if first else n_components)
    rows = vectors.select("id", array_to_vector("vec").alias("_v"))
    model = PCA(k=known, inputCol="_v", outputCol="_p").fit(rows)
    beyond = F.array_repeat(F.lit(0.0), n_components - known)
    return model.transform(rows).select("id", F.concat(vector_to_array("_p"), beyond).alias("vec"))


def _layout_kernel(a, b, seed, round_no, epochs, first_epoch, n_epochs):
    """Move the points of one bucket for some epochs; their outside neighbours stand still."""

    def kernel(places: pa.Table, edges: pa.Table) -> pa.Table:
        own = values(places, "own")
        ids, y = values(places, "id"), matrix(places, "vec").copy()
        order = np.lexsort((ids, ~own))
        ids, y, own = ids[order], y[order], own[order]
        n_own = int(own.sum())
        src, dst, w = values(edges, "src"), values(edges, "dst"), values(edges, "w")
        by_edge = np.lexsort((dst, src))
        src, dst, w = src[by_edge], dst[by_edge], w[by_edge]
        place = np.argsort(ids, kind="stable")
        head = place[np.searchsorted(ids, src, sorter=place)]
        tail = place[np.searchsorted(ids, dst, sorter=place)]
        bucket = int(values(places, "bucket")[0])
        rng = np.random.default_rng([seed, round_no, bucket])
        for epoch in range(first_epoch, first_epoch + epochs):
            rate = 1.0 - epoch / n_epochs
            fired = np.nonzero(rng.random(len(w)) < w)[0]
            rng.shuffle(fired)
            # about one edge per point at a time
            steps = max(1, -(-len(fired) // max(n_own, 1)))
            for part in np.array_split(fired, steps):
                i, j = head[part], tail[part]
                diff = y[i] - y[j]
                d2 = (diff * diff).sum(axis=1)
                pull = np.zeros(len(d2))
                far = d2 > 0
                pull[far] = -2.0 * a * b * d2[far] ** (b - 1.0) / (1.0 + a * d2[far] ** b)
                move = np.clip(pull[:, None] * diff, -CLIP, CLIP)
                other = rng.integers(0, len(y), size=(len(i), NEGATIVE_SAMPLES))
                diff = y[i][:, None, :] - y[other]
                d2 = np.einsum("ijk,ijk->ij", diff, diff)
                push = 2.0 * b / ((0.001 + d2) * (1.0 + a * d2**b))
                push[other == i[:, None]] = 0.0
                # only heads move, so half a push keeps the balance of pull and push
                diff *= push[:, :, None]
                move += 0.5 * np.clip(diff, -CLIP, CLIP, out=diff).sum(axis=1)
                np.add.at(y, i, rate * move)
        return pa.table({
            "id": pa.array(ids[:n_own], pa.int64()),
            "vec": list_column(y[:n_own]),
        })

    return kernel


def layout(
    start: DataFrame,
    graph: DataFrame,
    min_dist: float,
    scratch: Scratch,
    seed: int = 42,
    n_epochs: int = 200,
    rounds: int = 10,
    bucket_rows: int = BUCKET_ROWS,
) -> DataFrame:
    """Force layout of ``graph`` from the positions ``start(id, vec)``.

    Points live in buckets by hash.  In a round each bucket runs some epochs on
    its own points while the neighbours outside stand still; then all positions
    are exchanged.  A bucket sees its points, their edges and those neighbours,
    never the whole table.
    """
    a, b = layout_curve(min_dist)
    n = start.count()
    n_buckets = max(1, -(-n // bucket_rows))
    bucket_of = lambda c: F.pmod(F.xxhash64(c), F.lit(n_buckets)).cast("int")
    strongest = graph.agg(F.max("w")).scalar()
    edges = scratch.table(
        graph.select("src", "dst", "w")
        .unionByName(graph.select(F.col("dst").alias("src"), F.col("src").alias("dst"), "w"))
        .withColumn("w", F.col("w") / strongest)
        .where(F.col("w") * n_epochs >= 1.0)
        .withColumn("bucket", bucket_of("src")),
        "edges",
    )
    # which bucket needs which position; fixed over all rounds
    own = start.select(bucket_of("id").alias("bucket"), "id")
    halo = edges.select("bucket", F.col("dst").alias("id")).where(bucket_of("id") != F.col("bucket"))
    needs = scratch.table(
        own.withColumn("own", F.lit(True)).unionByName(halo.distinct().withColumn("own", F.lit(False))),
        "needs",
    )
    parts = max(n_buckets, 1)
    edges = edges.repartition(parts, "bucket").persist()
    needs = needs.repartition(parts, "id").persist()
    places = start
    rounds = min(rounds, max(1, n_epochs))
    marks = [n_epochs * r // rounds for r in range(rounds + 1)]  # the epochs before each round; all of them run
    for r in range(rounds):
        kernel = _layout_kernel(a, b, seed, r, marks[r + 1] - marks[r], marks[r], n_epochs)
        sent = needs.join(places, "id").select("bucket", "id", "own", "vec")
        moved = (
            sent.groupBy("bucket")
            .cogroup(edges.groupBy("bucket"))
            .applyInArrow(kernel, "id long, vec array<double>")
        )
        places = scratch.table(moved, "places", replaces=places)
    edges.unpersist()
    needs.unpersist()
    return places


def reduce_points(
    points: DataFrame,
    knn: DataFrame,
    scratch: Scratch,
    n_components: int = 10,
    n_neighbors: int = 15,
    min_dist: float = 0.0,
    seed: int = 42,
    n_epochs: int = 200,
    rounds: int = 10,
    bucket_rows: int = BUCKET_ROWS,
) -> DataFrame:
    """(id, vec): distinct points laid out from their neighbour lists."""
    graph = scratch.table(fuzzy_graph(knn, n_neighbors), "graph")
    start = scratch.table(principal_components(points, n_components), "components")
    extent = start.agg(*[F.max(F.abs(F.col("vec")[j])).alias(str(j)) for j in range(n_components)]).first()
    widest = max((e or 0.0 for e in extent), default=0.0) or 1.0
    # forces act along differences only, so a component that all points share would never be used:
    # it starts from small places that a hash of the id chooses
    flat = F.array(*[F.lit(round((e or 0.0) * (START_EXTENT / widest), 6) == 0) for e in extent])
    chosen = lambda j: F.round((F.pmod(F.xxhash64("id", j), F.lit(2001)) / 1000.0 - 1) * (START_EXTENT * FLAT_SHARE), 6)
    # rounding removes what the order of summation leaves in the last bits
    start = start.withColumn(
        "vec",
        F.transform(
            "vec", lambda x, j: F.when(F.get(flat, j), chosen(j)).otherwise(F.round(x * (START_EXTENT / widest), 6))
        ),
    )
    return layout(start, graph, min_dist, scratch, seed, n_epochs, rounds, bucket_rows)


def reduce_dimensions(
    vectors: DataFrame,
    n_components: int = 10,
    n_neighbors: int = 15,
    min_dist: float = 0.0,
    metric: str = "cosine",
    seed: int = 42,
    method: str = "umap",
    knn_method: str = "exact",
    n_epochs: int = 200,
    rounds: int = 10,
    cell_rows: int = CELL_ROWS,
    bucket_rows: int = BUCKET_ROWS,
) -> DataFrame:
    """(doc_id, vec): low-dimensional positions; equal vectors get equal positions.

    ``umap`` lays out the fuzzy neighbour graph from a principal-component start,
    with the objective of the published method but epochs in rounds of buckets,
    so coordinates are its own.  ``pca`` stops at the principal components.
    """
    scratch = Scratch(vectors.sparkSession, "reduce")
    points, members = collapse_copies(vectors, scratch)
    points = points.select("id", "vec")
    if method == "pca":
        placed = principal_components(points.withColumn("vec", F.col("vec").cast("array<double>")), n_components)
    elif method == "umap":
        same = comparable(points, metric)
        cells = assign_cells(same, scratch, cell_rows)
        knn = nearest_points(cells, n_neighbors - 1, scratch, knn_method).withColumn(
            "dist", as_distance(F.col("d2"), metric)
        )
        placed = reduce_points(
            cells.points.select("id", "vec"), knn, scratch, n_components, n_neighbors, min_dist,
            seed, n_epochs, rounds, bucket_rows,
        )
    else:
        raise ValueError(f"unknown method {method!r}")
    if members is None:
        return placed.withColumnRenamed("id", "doc_id")
    return members.join(placed, "id").select("doc_id", "vec")

import random

import pytest
from pyspark.sql import functions as F

from topicweave.operators import dendrogram, hierarchy
from topicweave.scratch import Scratch


def forest(rng, n, shape):
    """Edges (a, b, w) of trees over 0..n-1, with weights that rise along paths, tie, or are free."""
    edges = []
    for v in range(1, n):
        if shape == "path":
            edges.append((v - 1, v, float(v)))
        elif shape == "star":
            edges.append((0, v, float(n - v)))
        elif shape == "zigzag":
            edges.append((v - 1, v, float(v if v % 2 else 2 * n - v)))
        elif rng.random() < 0.95:
            edges.append((rng.randrange(v), v, float(rng.randrange(6))))
    return edges


def plain_tree(edges):
    """Next merge of each merge, and first merge of each vertex."""
    head, node, first, up = {}, {}, {}, {}

    def find(x):
        while head.get(x, x) != x:
            x = head[x]
        return x

    for a, b, w in sorted(edges, key=lambda e: (e[2], e[0], e[1])):
        me = (w, a, b)
        up[me] = None
        for v in (a, b):
            first.setdefault(v, me)
            if find(v) in node:
                up[node[find(v)]] = me
        head[find(b)] = find(a)
        node[find(a)] = me
    return up, first


@pytest.fixture(scope="module")
def built(spark):
    """Several runs at once, as links and as plain trees."""
    rng = random.Random(5)
    runs = {r: forest(rng, n, shape) for r, (n, shape) in enumerate([(40, "path"), (30, "star"), (41, "zigzag"), (90, "free"), (2, "path"), (60, "free")])}
    rows = [(r, i * 10 + r, -1 - (a * 10 + r), -1 - (b * 10 + r), w, a, b) for r, edges in runs.items() for i, (a, b, w) in enumerate(edges)]
    links = spark.createDataFrame(rows, "run int, id long, a long, b long, w double, src long, dst long")
    return runs, links


def test_merge_tree_is_that_of_merging_one_by_one(spark, built):
    runs, links = built
    scratch = Scratch(spark, "test")
    merges, first = dendrogram.merge_tree(links, scratch)
    rows = merges.collect()
    edge = {r.id: tuple(r.e) for r in rows}
    found = first.collect()
    for run, edges in runs.items():
        up, begin = plain_tree(edges)
        assert {tuple(r.e): edge.get(r.up) for r in rows if r.run == run} == up
        assert {(-1 - r.v) // 10: tuple(r.e) for r in found if r.run == run} == begin


def test_last_merge_below_a_limit(spark, built):
    runs, links = built
    scratch = Scratch(spark, "test")
    merges, first = dendrogram.merge_tree(links, scratch)
    limit = F.struct(F.col("w").alias("w"), F.lit(5).cast("long").alias("src"), F.lit(0).cast("long").alias("dst"))
    asked = first.crossJoin(spark.createDataFrame([(0.0,), (2.0,), (3.5,), (7.0,), (99.0,)], "w double"))
    asked = asked.select("run", "v", limit.alias("e"), F.col("id").alias("at"), F.col("e").alias("from")).where(F.col("from") < limit)
    got = dendrogram.last_below(asked.drop("from"), dendrogram.jumps(merges, scratch), scratch)
    edge = {r.id: tuple(r.e) for r in merges.collect()}
    trees = {run: plain_tree(edges) for run, edges in runs.items()}
    rows = got.collect()
    assert len(rows) > 200
    for r in rows:
        up, begin = trees[r.run]
        at = begin[(-1 - r.v) // 10]
        while up[at] is not None and up[at] < tuple(r.e):
            at = up[at]
        assert edge[r.at] == at


def test_folding_and_topmost(spark):
    rng = random.Random(8)
    nodes, n = {}, 0

    def grow(size, slant):
        nonlocal n
        me, n = n, n + 1
        left = 1 if slant else rng.randrange(1, size) if size > 1 else 0
        kids = [grow(left, slant), grow(size - left, slant)] if size > 1 else [None, None]
        nodes[me] = (rng.choice([None, rng.random() * 3]), rng.random(), *kids)
        return me

    ends = [grow(40, True), grow(60, False), grow(1, False)]

    def value(v):
        low, add, a, b = nodes[v]
        total = add + sum(value(c) for c in (a, b) if c is not None)
        return total if low is None else max(low, total)

    scratch = Scratch(spark, "test")
    df = spark.createDataFrame([(v, *x) for v, x in nodes.items()], "node long, low double, add double, c1 long, c2 long")
    got = {r.node: r.value for r in dendrogram.fold_up(df, scratch).collect()}
    assert got == pytest.approx({v: value(v) for v in nodes})
    up = {c: v for v, x in nodes.items() for c in x[2:] if c is not None}
    assert set(ends) == {v for v in nodes if v not in up}
    tree = spark.createDataFrame([(v, up.get(v)) for v in nodes], "node long, up long")
    want = {}
    for v in nodes:
        at = v
        while at is not None:
            if at % 7 == 0:
                want[v] = at
            at = up.get(at)
    assert {r.node: r.top for r in dendrogram.topmost(tree, F.col("node") % 7 == 0, scratch).collect()} == want


def test_no_rows_reach_the_driver():
    """Neither the tree nor the choice collects anything."""
    for module in (dendrogram, hierarchy):
        with open(module.__file__) as f:
            text = f.read()
        assert "collect()" not in text.replace("gather", "") and "toPandas" not in text

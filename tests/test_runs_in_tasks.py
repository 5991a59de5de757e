"""Bounded graphs and trees of a grid are taken by one task a run."""

import numpy as np
import pytest

from tests import brute
from topicweave.operators import cluster, hierarchy, spanning, tuning
from topicweave.scratch import Scratch

TRIALS = [(0, 5, 3, "eom"), (1, 5, 3, "leaf"), (2, 9, 2, "eom"), (3, 40, 4, "eom")]


def blobs(seed, copies):
    rng = np.random.default_rng(seed)
    x = np.vstack([rng.normal(c, s, size=(n, 2)) for c, s, n in ((0, 0.3, 40), (4, 0.5, 50), (9, 0.2, 25), (-5, 2.0, 30))])
    return np.vstack([x, np.repeat(x[:3], copies, axis=0)])


def frame(spark, x):
    return spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "doc_id long, vec array<double>")


def labels(spark, x):
    got = cluster.cluster_grid(frame(spark, x), TRIALS, cell_rows=12, block_rows=64).toPandas()
    return {t: rows.sort_values("doc_id").topic.tolist() for t, rows in got.groupby("trial")}


@pytest.mark.parametrize("seed, copies", [(1, 0), (2, 6)])
def test_one_task_a_run_gives_the_clusters_of_the_rounds(spark, monkeypatch, seed, copies):
    x = blobs(seed, copies)
    got = labels(spark, x)
    assert got == {t: brute.hdbscan(x, size, samples, method).tolist() for t, size, samples, method in TRIALS}
    if copies:  # the rounds themselves, which larger tables take
        monkeypatch.setattr(spanning, "TASK_ROWS", -1)
        assert labels(spark, x) == got


def test_a_bounded_clustering_writes_few_tables(spark, monkeypatch):
    names, write = [], Scratch.table
    monkeypatch.setattr(Scratch, "table", lambda self, df, name="t", *a, **b: names.append(name) or write(self, df, name, *a, **b))
    labels(spark, blobs(3, 0))
    assert not {"roots", "told", "first", "fold", "top"} & set(names)
    assert len(names) < 60


@pytest.mark.parametrize("bound", [-1, 40, 1 << 20])
def test_forest_is_that_of_all_edges(spark, monkeypatch, bound):
    """By rounds, by rounds and then one task, and by one task; with equal lengths and more than one part."""
    monkeypatch.setattr(spanning, "TASK_ROWS", bound)
    rng = np.random.default_rng(7)
    ends = {tuple(sorted(p)) for p in rng.integers(0, 30, size=(70, 2)).tolist() if p[0] != p[1]}
    rows = [(run, a + 40 * part, b + 40 * part, float(rng.integers(1, 6))) for run in (1, 2) for part in (0, 1) for a, b in sorted(ends)]
    got = spanning.minimum_spanning_forest(spark.createDataFrame(rows, "run int, src long, dst long, w double")).collect()
    for run in (1, 2):
        root, want = {}, []

        def find(v):
            while root.get(v, v) != v:
                v = root[v]
            return v

        for w, a, b in sorted((w, a, b) for r, a, b, w in rows if r == run):
            if find(a) != find(b):
                root[find(a)] = find(b)
                want.append((w, a, b))
        assert sorted((r.w, r.src, r.dst) for r in got if r.run == run) == want


def test_core_tree_counts_copies_and_leaves_small_parts_out():
    ids, weight, core = np.arange(6), np.array([5, 1, 1, 1, 1, 1]), np.array([0.0, 1.0, 1.0, 1.0, 1.0, 1.0])
    w, src, dst = np.array([1.0, 1.0, 2.0, 1.5]), np.array([0, 2, 1, 4]), np.array([1, 3, 2, 5])
    tree = hierarchy.CoreTree(4, ids, weight, core, w, src, dst)
    assert tree.node.tolist() == [0, 0, 0, 0, -1, -1] and tree.joins.tolist() == [-1, 0, 3, 3, -1, -1]
    assert tree.members("eom")[0].tolist() == []  # the one node holds the whole run


@pytest.mark.parametrize("bound", [-1, 1 << 20])
def test_a_component_of_most_points_is_not_searched(spark, monkeypatch, bound):
    """Far from a large component lie others that it would search all its points for."""
    monkeypatch.setattr(spanning, "TASK_ROWS", bound)
    rng = np.random.default_rng(11)
    x = np.vstack([rng.normal(size=(160, 2)), rng.normal((60, 0), 1, size=(25, 2)), rng.normal((0, 90), 1, size=(25, 2))])
    opened, write = [], Scratch.table

    def table(self, df, name="t", *a, **b):
        out = write(self, df, name, *a, **b)
        if name == "open":
            opened.extend(r.id for r in out.select("id").collect())
        return out

    monkeypatch.setattr(Scratch, "table", table)
    vectors = frame(spark, x)
    scratch = Scratch(spark, "test")
    cells = cluster.assign_cells(vectors.withColumnRenamed("doc_id", "id"), scratch, 20)
    knn = scratch.table(cluster.nearest_points(cells, 8, scratch).withColumn("dist", cluster.F.sqrt("d2")), "knn")
    core = scratch.table(cluster.core_distances(knn, [3]), "core")
    ends = knn.groupBy(cluster.F.col("src").alias("id")).agg(cluster.F.max("dist").alias("list_end"))
    search = spanning.OutsideSearch(cells, core, ends, scratch)
    got = spanning.minimum_spanning_forest(cluster.mutual_reachability(knn, core), scratch, search).collect()
    far = np.sqrt(((x[:, None] - x[None]) ** 2).sum(axis=2))
    own = np.sort(far, axis=1)[:, 3]
    reach = np.maximum(np.maximum(far, own[:, None]), own[None])
    inside, least, total = np.zeros(len(x), dtype=bool), reach[0].copy(), []
    inside[0] = True
    for _ in range(len(x) - 1):
        new = np.where(inside, np.inf, least).argmin()
        total.append(least[new])
        inside[new], least = True, np.minimum(least, reach[new])
    assert sorted(r.w for r in got) == pytest.approx(sorted(total))
    assert opened and not set(range(160)) <= set(opened)


def test_words_are_summed_once_for_documents_of_the_same_topics(spark, monkeypatch):
    """Forty documents, most of two kinds: a row a kind and word, and the scores of plain counting."""
    words = [(d, w, 1 + d % 3) for d in range(40) for w in ("a", "b", f"own{d % 4}")]
    counts = spark.createDataFrame(words + [(None, "a", 9)], "doc_id long, word string, n long")
    topic = {0: lambda d: d % 2, 1: lambda d: d % 2 + 5, 2: lambda d: 7 - d % 2}
    topics = [(t, d, f(d)) for t, f in topic.items() for d in range(40) if t < 2 or d > 1]
    rows, write = {}, Scratch.table

    def table(self, df, name="t", *a, **b):
        out = write(self, df, name, *a, **b)
        rows[name] = Scratch.rows(out)
        return out

    monkeypatch.setattr(Scratch, "table", table)
    labelled = spark.createDataFrame(topics + [(0, None, 1)], "trial_id int, doc_id long, topic int")
    got = tuning.trial_top_words(counts, labelled, 1, 1.0, 3).collect()
    assert rows["counts"] == 2 * 4 + 2 * 3  # two kinds, and two documents that only two trials have
    for t in topic:
        n = {}
        for d, w, k in words:
            for trial, doc, label in topics:
                if (trial, doc) == (t, d):
                    n[label, w] = n.get((label, w), 0) + k
        inside, all_ = {}, {}
        for (label, w), k in n.items():
            inside[label], all_[w] = inside.get(label, 0) + k, all_.get(w, 0) + k
        mean = sum(inside.values()) // len(inside)
        want = {}
        for label in inside:
            scored = sorted((-k / inside[label] * np.log(1 + mean / all_[w]), w) for (at, w), k in n.items() if at == label)
            want |= {(label, r + 1): (w, pytest.approx(-s)) for r, (s, w) in enumerate(scored[:3])}
        assert {(r.topic, r["rank"]): (r.word, r.score) for r in got if r.trial_id == t} == want

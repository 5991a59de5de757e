import numpy as np
import pytest
from pyspark.sql import functions as F

from catalog import inputs as given
from catalog import queries
from tests import brute
from topicweave.operators import blocks, cluster, encode, merging, neighbours, reduce, separation, spanning
from topicweave.scratch import Scratch


def frame(spark, x):
    rows = [(i, [float(v) for v in row]) for i, row in enumerate(x)]
    return spark.createDataFrame(rows, "doc_id long, vec array<double>")


@pytest.fixture(scope="module")
def planted():
    """Four groups of different density, some noise."""
    rng = np.random.default_rng(7)
    centers = rng.normal(size=(4, 5)) * 4
    inside = [centers[i % 4] + rng.normal(size=5) * (0.3 + 0.2 * (i % 4)) for i in range(160)]
    return np.vstack([inside, rng.uniform(-8, 8, size=(16, 5))])


@pytest.fixture(scope="module")
def crowded(planted):
    """A third of all rows are copies of one vector."""
    return np.vstack([planted, np.repeat(planted[3:4], 80, axis=0), planted[10:20]])


@pytest.mark.parametrize("metric", ["cosine", "euclidean"])
@pytest.mark.parametrize("sizes", [(2048, 4096), (24, 16)])
def test_knn_is_exact_with_copies(spark, crowded, metric, sizes):
    x = crowded.copy()
    if metric == "euclidean":
        x[[1, 2]] = 0.0
    got = {}
    knn = neighbours.knn_graph(frame(spark, x), 6, metric, cell_rows=sizes[0], block_rows=sizes[1])
    for r in knn.collect():
        got.setdefault(r.src, []).append((r.rank, r.dst))
    assert [[d for _, d in sorted(got[i])] for i in range(len(x))] == brute.knn(x, 6, metric)


def test_zero_vectors_under_cosine(spark):
    x = [[0, 0], [0, 0], [1, 0], [1, 1e-3]]
    knn = neighbours.knn_graph(frame(spark, x), 3).collect()
    dist = {(r.src, r.dst): r.dist for r in knn}
    assert dist[0, 1] == 0 and dist[0, 2] == pytest.approx(1) and dist[2, 0] == pytest.approx(1)


def test_fewer_points_than_neighbours(spark):
    assert neighbours.knn_graph(frame(spark, [[1, 0], [0, 1], [1, 1]]), 9).count() == 6


def test_probing_finds_most_neighbours(spark, planted):
    df = frame(spark, planted)
    exact = neighbours.knn_graph(df, 5).select("src", "dst")
    near = neighbours.knn_graph(df, 5, method="ivf", nprobe=3, cell_rows=24).select("src", "dst")
    assert exact.intersect(near).count() > 0.8 * exact.count()


def test_probed_query_has_its_recall_without_groups(spark, monkeypatch):
    x = np.random.default_rng(3).normal(size=(1200, 16))
    monkeypatch.setattr(given, "vectors", lambda spark, sf: frame(spark, x))
    got, want = {}, brute.knn(x, 15, "cosine")
    for r in queries.knn_probed(spark, "").collect():
        got.setdefault(r.src, set()).add(r.dst)
    assert sum(len(got[i] & set(want[i])) for i in range(len(x))) >= 0.9 * 15 * len(x)


@pytest.mark.parametrize("method", ["exact", "ivf"])
def test_search_sends_blocks_not_a_row_for_each_cell(spark, monkeypatch, method):
    """Points without groups look into nearly all cells; a block is sent once for each group of blocks."""
    x = np.random.default_rng(9).normal(size=(900, 12))
    sent = []
    plain = Scratch.table

    def recorded(self, df, name="t", *args, **more):
        out = plain(self, df, name, *args, **more)
        sent.append((name, self.rows(out)))
        return out

    monkeypatch.setattr(Scratch, "table", recorded)
    knn = neighbours.knn_graph(frame(spark, x), 4, "euclidean", method, 100, cell_rows=9, block_rows=30)
    got = {}
    for r in knn.collect():
        got.setdefault(r.src, []).append((r.rank, r.dst))
    assert [[d for _, d in sorted(got[i])] for i in range(len(x))] == brute.knn(x, 4, "euclidean")
    # 100 cells; rows of a point and a cell were 40,000 and more
    assert max(n for name, n in sent if name not in ("nearest", "points")) <= 900


def test_one_wide_and_many_narrow_requests(monkeypatch):
    """Cells compared one by one, or all at once, give the same."""
    rng = np.random.default_rng(5)
    c, cell = rng.normal(size=(400, 6)), np.sort(rng.integers(0, 20, 400))
    q, wanted = rng.normal(size=(70, 6)), rng.random((70, 20)) < 0.15
    for share in (0.0, 1.0):
        monkeypatch.setattr(neighbours, "SPARSE", share)
        near = neighbours.Nearest(np.arange(1000, 1070), q, 5)
        for part in (slice(0, 150), slice(150, 400)):
            near.look_into(np.arange(400)[part], c[part], cell[part], wanted)
        for i in range(70):
            far = ((c - q[i]) ** 2).sum(axis=1)
            want = [j for _, j in sorted((far[j], j) for j in range(400) if wanted[i, cell[j]])][:5]
            assert [j for j in near.other[i].tolist() if j >= 0] == want


def test_fuzzy_graph(spark, planted):
    knn = neighbours.knn_graph(frame(spark, planted), 9).persist()
    one = reduce.fuzzy_strengths(knn, 10)
    for r in one.groupBy("src").agg(F.sum("strength").alias("s"), F.min("sigma").alias("sigma")).collect():
        assert r.sigma > 0
        assert r.s == pytest.approx(np.log2(10), abs=1e-3)
    graph = reduce.fuzzy_union(one).collect()
    assert all(r.src < r.dst and 0 < r.w <= 1 for r in graph)
    assert len({(r.src, r.dst) for r in graph}) == len(graph)


def test_layout_curve():
    assert reduce.layout_curve(0.1) == pytest.approx((1.577, 0.895), abs=1e-3)
    assert reduce.layout_curve(0.0) == pytest.approx((1.932, 0.790), abs=2e-3)


def test_reduction_keeps_groups_and_ignores_partitions(spark, crowded):
    options = dict(n_components=3, n_neighbors=10, n_epochs=60, rounds=3, bucket_rows=64)
    df = frame(spark, crowded)
    one = reduce.reduce_dimensions(df.repartition(1), **options).toPandas().sort_values("doc_id")
    many = reduce.reduce_dimensions(df.repartition(7), **options).toPandas().sort_values("doc_id")
    y = np.stack(one.vec)
    assert np.allclose(y, np.stack(many.vec))
    assert len(y) == len(crowded) and (y[3] == y[176:256]).all()
    group = np.arange(160) % 4
    centers = np.array([y[:160][group == g].mean(axis=0) for g in range(4)])
    nearest = ((y[:160, None] - centers[None]) ** 2).sum(axis=2).argmin(axis=1)
    assert (nearest == group).mean() > 0.95


def test_linear_reduction(spark, planted):
    y = np.stack(reduce.reduce_dimensions(frame(spark, planted), 2, method="pca").toPandas().sort_values("doc_id").vec)
    spread = np.linalg.svd(planted - planted.mean(axis=0), compute_uv=False)[:2] ** 2
    assert ((y - y.mean(axis=0)) ** 2).sum(axis=0) == pytest.approx(spread)
    with pytest.raises(ValueError):
        reduce.reduce_dimensions(frame(spark, planted), method="other")


@pytest.mark.parametrize("metric", ["euclidean", "cosine"])
def test_more_components_than_coordinates(spark, planted, metric):
    df = frame(spark, planted[:120, :3])
    got = reduce.reduce_dimensions(df, 6, 8, metric=metric, n_epochs=20, rounds=2).toPandas().sort_values("doc_id")
    y = np.stack(got.vec)
    assert y.shape == (120, 6) and np.isfinite(y).all() and (y.std(axis=0) > 0).all()
    flat = np.stack(reduce.reduce_dimensions(df, 5, method="pca").toPandas().sort_values("doc_id").vec)
    assert flat.shape == (120, 5) and not flat[:, 3:].any() and flat[:, :3].any(axis=0).all()


def test_spanning_forest(spark):
    edges = [(1, 2, 1.0), (2, 3, 1.0), (1, 3, 1.0), (3, 4, 2.0), (4, 5, 0.5), (7, 8, 3.0), (2, 2, 0.0), (5, 1, 2.0)]
    df = spark.createDataFrame(edges, "src long, dst long, w double")
    got = sorted((r.w, r.src, r.dst) for r in spanning.minimum_spanning_forest(df).collect())
    plain = [(w, min(a, b), max(a, b)) for a, b, w in edges]
    assert got == sorted(brute.spanning_tree(9, plain))


def test_long_chain(spark):
    """A path with rising weights: every part hangs on the one before."""
    edges = [(i, i + 1, float(i)) for i in range(60)]
    df = spark.createDataFrame(edges, "src long, dst long, w double")
    assert spanning.minimum_spanning_forest(df).count() == 60


@pytest.mark.parametrize("case", ["crowded", "ties"])
def test_clusters_equal_full_tree(spark, planted, crowded, case):
    x = {"planted": planted, "crowded": crowded, "ties": np.round(planted)}[case]
    trials = [(0, 15, 5, "eom"), (1, 15, 5, "leaf"), (2, 8, 3, "eom"), (3, 5, 3, "leaf")]
    cell_rows = 2048 if case == "planted" else 40
    got = cluster.cluster_grid(frame(spark, x), trials, cell_rows=cell_rows, block_rows=64).toPandas()
    for trial, size, samples, method in trials:
        label = got[got.trial == trial].sort_values("doc_id").topic.to_numpy()
        assert label.tolist() == brute.hdbscan(x, size, samples, method).tolist()


def test_outside_search_moves_only_vectors_that_may_be_met(spark, monkeypatch):
    rng = np.random.default_rng(3)
    centers = np.array([[0, 0], [30, 0], [0, 30], [30, 30], [300, 300]])
    x = np.vstack([c + rng.normal(size=(60, 2)) for c in centers])
    searches = []

    class Recorded(spanning.OutsideSearch):
        def __init__(self, *args):
            super().__init__(*args)
            searches.append(self)

    monkeypatch.setattr(cluster, "OutsideSearch", Recorded)
    got = cluster.cluster_grid(frame(spark, x), [(0, 10, 3, "eom")], cell_rows=12, block_rows=64).toPandas()
    assert got.sort_values("doc_id").topic.tolist() == brute.hdbscan(x, 10, 3, "eom").tolist()
    moved = searches[0].moved
    # all searches together send fewer vectors than one search of everything would
    assert len(moved) >= 2 and sum(moved) < len(x)


def test_no_cluster(spark):
    got = cluster.hdbscan(frame(spark, np.random.default_rng(0).normal(size=(12, 3))), 10, 2)
    assert [r.topic for r in got.collect()] == [-1] * 12


def test_silhouette(spark, planted):
    label = np.where(np.arange(len(planted)) < 160, np.arange(len(planted)) % 4, -1)
    label[5] = 9  # alone
    rows = [(i, int(v)) for i, v in enumerate(label)]
    topics = spark.createDataFrame(rows, "doc_id long, topic int")
    value = separation.silhouette(frame(spark, planted), topics, block_rows=16, block_topics=2).first().silhouette
    assert value == pytest.approx(brute.silhouette(planted, label))
    pair = spark.createDataFrame([(0, 0), (1, 1), (2, -1)], "doc_id long, topic int")
    assert separation.silhouette(frame(spark, planted), pair).first().silhouette == 0.0
    noise = spark.createDataFrame([(0, -1)], "doc_id long, topic int")
    assert separation.silhouette(frame(spark, planted), noise).first().silhouette == 0.0


def test_silhouette_of_runs(spark, planted):
    """Runs by two columns, one of them with a topic of most rows and many small ones."""
    rng = np.random.default_rng(4)
    labels = {
        ("a", 1): np.where(np.arange(len(planted)) % 3 > 0, 0, rng.integers(1, 12, len(planted))),
        ("a", 2): np.arange(len(planted)) % 2,
        ("b", 1): np.full(len(planted), 3),
    }
    rows = [(*key, i, int(v)) for key, label in labels.items() for i, v in enumerate(label)]
    topics = spark.createDataFrame([*rows, ("c", 1, 0, -1)], "name string, trial int, doc_id long, topic int")
    got = separation.silhouette(frame(spark, planted), topics, ["name", "trial"], block_rows=16, block_topics=5)
    found = {(r.name, r.trial): r.silhouette for r in got.collect()}
    assert found.pop(("b", 1)) == 0.0 and found.pop(("c", 1)) == 0.0
    assert found == pytest.approx({key: brute.silhouette(planted, labels[key]) for key in found}) and len(found) == 2


def test_distance_sums_with_copies_and_far_origin():
    rng = np.random.default_rng(6)
    for shift in (0.0, 1e6):
        c = np.vstack([rng.normal(size=(300, 7)), np.zeros((400, 7)), rng.normal(size=(9, 7)) * 1e-7]) + shift
        q = np.vstack([c[::5], c[:1] + 30])
        want = np.array([np.sqrt(((c - row) ** 2).sum(axis=1)).sum() for row in q])
        assert blocks.distance_sums(q, c) == pytest.approx(want, rel=1e-9)
    assert np.isinf(blocks.distance_sums(np.array([[np.inf, 0.0]]), np.zeros((3, 2)))).all()


def test_silhouette_sends_blocks_to_shares_not_to_every_block(spark, monkeypatch):
    """What a block wants of a topic is sent once for all blocks of it, and gives one sum a document."""
    x = np.random.default_rng(2).normal(size=(600, 3))
    topics = spark.createDataFrame([(i, i % 2) for i in range(600)], "doc_id long, topic int")
    met = []
    frames = type(topics)
    plain = frames.mapInArrow

    def recorded(self, kernel, schema, *args):
        if kernel is separation._distance_sums:
            met.append((self.select("run", "topic", "place", "other", "met").distinct().count(), plain(self, kernel, schema).count()))
        return plain(self, kernel, schema, *args)

    monkeypatch.setattr(frames, "mapInArrow", recorded)
    got = separation.silhouette(frame(spark, x), topics, block_rows=32).first().silhouette
    assert got == pytest.approx(brute.silhouette(x, np.arange(600) % 2))
    # 20 blocks that want 2 topics of 10 blocks each: 40 sendings, 2 sums a document, where there were 400 and 20
    assert met == [(40, 1200)]


def test_topics_are_numbered_by_size(spark):
    df = spark.createDataFrame([(1, 7), (2, 7), (3, 4), (4, 4), (5, 9), (6, -1)], "doc_id long, cluster int")
    docs = spark.range(1, 8).withColumnRenamed("id", "doc_id")
    got = {r.doc_id: r.topic for r in cluster.assign_topics(df, docs).collect()}
    assert got == {1: 0, 2: 0, 3: 1, 4: 1, 5: 2, 6: -1, 7: -1}


def test_average_linkage():
    x = np.array([[1, 0], [1, 0.1], [0, 1], [0.1, 1], [-1, 0]])
    groups = brute.average_linkage(x, 3)
    assert groups.tolist() == [0, 0, 2, 2, 4]
    assert brute.average_linkage(x, 9).tolist() == list(range(5))


@pytest.mark.parametrize("left", [1, 9])
def test_merging_in_rounds_is_merging_one_by_one(spark, left):
    rng = np.random.default_rng(12)
    x = rng.normal(size=(32, 5))
    x[7], x[30] = x[20], 0  # equal vectors, and one without direction
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "id long, vec array<double>")
    got = {r.id: r.root for r in merging.groups(df, left, Scratch(spark, "test"), block_rows=16).collect()}
    assert [got[i] for i in range(32)] == brute.average_linkage(x, left).tolist()


def test_chain_of_topics_merges_from_its_close_end(spark):
    """Each topic is nearest to the one before: one pair a round."""
    angle = np.cumsum(0.01 * 1.3 ** np.arange(14))
    x = np.stack([np.cos(angle), np.sin(angle)], axis=1)
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "id long, vec array<double>")
    got = {r.id: r.root for r in merging.groups(df, 3, Scratch(spark, "test")).collect()}
    assert [got[i] for i in range(14)] == brute.average_linkage(x, 3).tolist()


def test_encoders(spark):
    df = spark.createDataFrame([(1, "a b a"), (2, ""), (3, None)], "doc_id long, text string")
    load = lambda: lambda texts: [[len(t), 1.0] for t in texts]
    got = {r.doc_id: r.vec for r in encode.encode_documents(df, load, max_chars=3, normalize=False).collect()}
    assert got == {1: [3.0, 1.0], 2: [0.0, 1.0], 3: [0.0, 1.0]}
    vec = {r.doc_id: np.array(r.vec) for r in encode.hash_documents(df, dim=16).collect()}
    assert np.linalg.norm(vec[1]) == pytest.approx(1) and not vec[2].any() and not vec[3].any()
    unit = encode.l2_normalize(spark.createDataFrame([([3.0, 4.0],), ([0.0, 0.0],)], "vec array<double>"))
    assert [r.vec for r in unit.collect()] == [[0.6, 0.8], [0.0, 0.0]]
    with pytest.raises(ValueError):
        encode.require_alignment(frame(spark, [[1], [2]]), df)
    ids = lambda *x: spark.createDataFrame([(i,) for i in x], "doc_id long")
    encode.require_alignment(ids(1, 2), ids(2, 1))
    with pytest.raises(ValueError):
        encode.require_alignment(ids(1, 1, 2), ids(1, 2))
    assert tuple(encode.check_alignment(ids(1, 1, 3, None), ids(1, 2, 2)).first()) == (2, 2, 1, 1)


def test_an_encoder_is_loaded_once_in_a_worker():
    loads = []
    load = lambda: loads.append(1) or (lambda texts: texts)
    for _ in range(3):
        encode.loaded_encoder("a", load)
    encode.loaded_encoder("b", load)
    assert len(loads) == 2


def test_topics_are_merged(spark):
    vectors = spark.createDataFrame([(0, [1.0, 0.0]), (1, [1.0, 0.1]), (2, [0.0, 1.0]), (-1, [1.0, 0.0])], "topic int, vec array<double>")
    topics = spark.createDataFrame([(1, 0), (2, 1), (3, 2), (4, -1), (5, 2), (6, 2)], "doc_id long, topic int")
    got = {r.doc_id: r.topic for r in cluster.reduce_topics(vectors, topics, 2).collect()}
    assert got == {1: 1, 2: 1, 3: 0, 5: 0, 6: 0, 4: -1}


def test_silhouette_compares_vectors_once_for_all_runs(monkeypatch):
    """Two groups of two blocks and three runs: four comparisons, with the sums of both sides and every run."""
    rng = np.random.default_rng(11)
    x = rng.normal(size=(4, 20, 3))
    x[1, 5:9] = x[0, 2]  # copies, within a block and across
    labels = rng.integers(0, 3, (4, 20, 3))
    labels[:, ::7, 1] = separation.NOISE
    wants = [int(c) for run in (1, 2, 3) for c in separation._code(run, np.arange(3))]
    table = separation.pa.Table.from_pylist([
        {"a": 0, "b": 1, "group": i // 2, "place": i % 2, "n": 20, "labels": labels[i].astype(np.int32).tobytes(),
         "vecs": x[i].tobytes(), "wants": wants}
        for i in range(4)
    ])
    compared = []
    plain = separation.distance_stripes
    monkeypatch.setattr(separation, "distance_stripes", lambda q, c: compared.append(1) or plain(q, c))
    got = separation._sums_of_groups(table).to_pylist()
    assert len(compared) == 4 and len(got) == 4 * 9
    for r in got:
        run, topic = separation._run_and_topic(r["code"])
        theirs = [i for i in range(4) if i // 2 != r["group"]]
        of = np.concatenate([x[i][labels[i, :, run - 1] == topic] for i in theirs])
        far = np.sqrt(((x[2 * r["group"] + r["place"]][:, None] - of[None]) ** 2).sum(axis=2))
        assert r["n"] == len(of) and np.frombuffer(r["total"]) == pytest.approx(far.sum(axis=1))


def test_silhouette_of_runs_with_many_topics(spark):
    """Sums by topic, not by product, give the same."""
    rng = np.random.default_rng(12)
    x = rng.normal(size=(300, 4))
    labels = {1: np.arange(300) % 90, 2: np.where(np.arange(300) % 4 == 0, -1, np.arange(300) % 3)}
    rows = [(run, i, int(v)) for run, label in labels.items() for i, v in enumerate(label)]
    topics = spark.createDataFrame(rows, "run_name int, doc_id long, topic int")
    got = separation.silhouette(frame(spark, x), topics, ["run_name"], block_rows=128, block_topics=50)
    want = {run: brute.silhouette(x, label) for run, label in labels.items()}
    assert {r.run_name: r.silhouette for r in got.collect()} == pytest.approx(want)


@pytest.mark.parametrize("method", ["exact", "ivf"])
def test_knn_tasks_get_bounded_blocks_once(spark, monkeypatch, method):
    """A task gets few blocks that ask and few that they meet, and none of them twice."""
    x = np.random.default_rng(13).normal(size=(400, 3))
    monkeypatch.setattr(neighbours, "MET_BLOCKS", 2)
    monkeypatch.setattr(neighbours, "SHARES", 2)
    tasks = []
    cogroups = type(spark.range(1).groupBy("id").cogroup(spark.range(1).groupBy("id")))
    plain = cogroups.applyInArrow

    def checked(self, kernel, schema):
        def bounded(asking, met):
            assert asking.num_rows <= 2 and met.num_rows <= 2
            assert len(set(asking.column("block").to_pylist())) == asking.num_rows
            return kernel(asking, met)

        tasks.append(schema)
        return plain(self, bounded, schema)

    monkeypatch.setattr(cogroups, "applyInArrow", checked)
    got = neighbours.knn_graph(frame(spark, x), 5, "euclidean", method, 40, cell_rows=20, block_rows=20).collect()
    assert len(tasks) == 1
    far = np.sqrt(((x[:, None] - x[None]) ** 2).sum(axis=2))
    np.fill_diagonal(far, np.inf)
    want = {(i, int(j), r + 1) for i in range(400) for r, j in enumerate(np.argsort(far[i])[:5])}
    assert {(r.src, r.dst, r.rank) for r in got} == want

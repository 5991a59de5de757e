import math
import threading

from topicweave.operators import quality, tokens as tok, tuning
from topicweave.scratch import Scratch


def test_coherence_has_no_row_for_each_document_and_topic(spark, monkeypatch):
    """Topics that share their words with all documents: the tables grow with the topics, not with topics times documents."""
    n_docs, n_topics = 60, 50
    words = [f"w{i}" for i in range(8)]
    docs = [(d, [w for i, w in enumerate(words) if (d >> i % 5) & 1 or i == 7 or d % (i + 2) == 0]) for d in range(n_docs)]
    docs += [(None, ["w0", "w1"]), (3, ["w0", "w6"])]  # a document without id, and one in two rows
    sets = spark.createDataFrame(docs, "doc_id long, words array<string>")
    of = lambda t, rank: words[(t + rank * (1 + t % 3)) % 8]
    top = spark.createDataFrame([(1, t, r, of(t, r)) for t in range(n_topics) for r in (1, 2, 3)], "run int, topic int, rank int, word string")
    monkeypatch.setattr(quality, "PIECE_DOCS", 3)
    monkeypatch.setattr(quality, "SHARE_LISTS", 7)
    rows = {}
    plain = Scratch.table

    def table(self, df, name="t", *more, **options):
        out = plain(self, df, name, *more, **options)
        rows[name] = Scratch.rows(out)
        return out

    monkeypatch.setattr(Scratch, "table", table)
    got = quality.topic_coherence(top, sets, by=["run"]).first().coherence
    held = {}
    for d, ws in docs:
        held.setdefault(d, set()).update(ws)
    n = lambda *ws: sum(all(w in one for w in ws) for one in held.values())
    score = lambda a, b: math.log((n(a, b) + 1) / (n(a) * n(b) / len(docs) + 1))
    pairs = [(0, 1), (0, 2), (1, 2)]
    means = [sum(score(of(t, i + 1), of(t, j + 1)) for i, j in pairs) / 3 for t in range(n_topics)]
    assert abs(got - sum(means) / n_topics) < 1e-9
    assert max(rows.values()) <= max(6 * n_topics, len(docs))


def test_clusterings_of_a_grid_run_side_by_side(spark, monkeypatch):
    """Two reductions are measured at the same time: each waits until the other has come as far."""
    docs = spark.createDataFrame([(d, f"a b{d}") for d in range(12)], "doc_id long, text string")
    vectors = spark.createDataFrame([(d, [float(d), 1.0]) for d in range(12)], "doc_id long, vec array<double>")
    tokens = tok.tokenize_whitespace(docs).select("doc_id", "tokens")
    trials = quality.expand_grid(
        spark, {"n_neighbors": [3, 4], "n_components": [2], "min_dist": [0.0]}, {"min_cluster_size": [3], "min_samples": [2], "cluster_method": ["eom"]}
    )
    both = threading.Barrier(2, timeout=30)

    def grid(vectors, trials, **more):
        both.wait()
        return spark.createDataFrame([(t[0],) for t in trials], "trial int")

    measured = lambda reduced, doc_topics, *rest: doc_topics.selectExpr("trial_id", "2L n_clusters", "0D noise_ratio", "0D silhouette", "0D diversity", "0D coherence")
    monkeypatch.setattr(tuning, "reduce_points", lambda points, *rest: points)
    monkeypatch.setattr(tuning, "cluster_grid", grid)
    monkeypatch.setattr(tuning, "trial_metrics", measured)
    assert tuning.run_trials(vectors, tokens, trials, min_df=1).count() == 2

import itertools
import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from topicweave.operators import quality, represent, tokens as tok


@pytest.fixture(scope="module")
def words(spark):
    rows = [
        (0, 1, "a", 0.9), (0, 2, "b", 0.8), (1, 1, "a", 0.7), (1, 2, "c", 0.6),
        (1, 3, "never", 0.5), (-1, 1, "z", 0.1),
    ]
    return spark.createDataFrame(rows, "topic int, rank int, word string, score double")


def test_diversity(spark, words):
    assert quality.topic_diversity(words).first().diversity == pytest.approx(4 / 5)
    assert quality.topic_diversity(words, top_n=1).first().diversity == pytest.approx(1 / 2)
    assert quality.topic_diversity(words.where("topic = 0")).first().diversity == 0.0
    # -1 counts as a topic for the single-topic rule only
    assert quality.topic_diversity(words.where("topic in (0, -1)")).first().diversity == 1.0


def test_other_aspects_do_not_count(spark, words):
    named = words.selectExpr("*", "'Main' AS aspect").union(words.selectExpr("topic", "rank", "'k'", "score", "'KeyBERT'"))
    assert quality.topic_diversity(named).first().diversity == pytest.approx(4 / 5)
    docs = spark.createDataFrame([(0, ["a", "b", "k"]), (1, ["a", "c"])], "doc_id long, words array<string>")
    assert quality.topic_coherence(named, docs).first() == quality.topic_coherence(words, docs).first()
    reps = spark.createDataFrame([(0, 1, 5), (1, 1, 6)], "topic int, rank int, doc_id long")
    corpus = spark.createDataFrame([(5, "five"), (6, "six")], "doc_id long, text string")
    prompts = {r.topic: r.prompt for r in represent.label_prompts(named, reps, corpus, "[KEYWORDS]").collect()}
    assert prompts == {0: "a, b", 1: "a, c, never"}


def test_coherence(spark, words):
    docs = [["a", "b"], ["a"], ["b", "c"], ["a", "c"], ["x"]]
    df = spark.createDataFrame(list(enumerate(docs)), "doc_id long, words array<string>")
    pmi = lambda d12, d1, d2: math.log((d12 + 1) / (d1 * d2 / 5 + 1))
    want = (pmi(1, 3, 2) + pmi(1, 3, 2)) / 2
    assert quality.topic_coherence(words, df).first().coherence == pytest.approx(want)
    none = spark.createDataFrame([(0, ["q"])], "doc_id long, words array<string>")
    assert quality.topic_coherence(words, none).first().coherence == 0.0
    apart = spark.createDataFrame([(0, ["a"]), (1, ["b"])], "doc_id long, words array<string>")
    got = quality.topic_coherence(words.where("topic = 0"), apart).first().coherence
    assert got == pytest.approx(math.log(1 / 1.5))


def test_coherence_of_many_words(spark):
    """More words a topic than one long has bits, in two runs."""
    rng = random.Random(8)
    docs = [sorted({f"w{rng.randrange(90)}" for _ in range(30)}) for _ in range(80)]
    df = spark.createDataFrame(list(enumerate(docs)), "doc_id long, words array<string>")
    rows = [(run, topic, rank, f"w{(rank * 7 + topic + run) % 90}") for run in (1, 2) for topic in (0, 1) for rank in range(1, 71)]
    top = spark.createDataFrame([*rows, (3, 0, 1, "none")], "run int, topic int, rank int, word string")
    holds = lambda *words: sum(all(w in d for w in words) for d in map(set, docs))
    want = {}
    for run in (1, 2):
        means = []
        for topic in (0, 1):
            words = [w for r, t, _, w in rows if (r, t) == (run, topic)]
            pairs = [(holds(a, b), holds(a), holds(b)) for a, b in itertools.combinations(words, 2)]
            means.append(sum(math.log((ab + 1) / (a * b / 80 + 1)) for ab, a, b in pairs) / len(pairs))
        want[run] = sum(means) / 2
    got = {r.run: r.coherence for r in quality.topic_coherence(top, df, 70, ["run"]).collect()}
    assert got == pytest.approx({**want, 3: 0.0})


@pytest.mark.parametrize(
    "n, share", [(9, 0.3), (10, 0.7), (19, 0.7), (20, 1.0), (50, 1.0), (51, 0.7), (75, 0.7), (76, 0.3)]
)
def test_composite_range(spark, n, share):
    df = spark.createDataFrame([(n, 0.0, 0.0, 0.0, 0.0)], "n_clusters long, noise_ratio double, silhouette double, diversity double, coherence double")
    assert quality.with_composite_score(df).first().composite == pytest.approx(0.2 + 0.15 * share)


def test_composite_bounds(spark):
    df = spark.createDataFrame([(30, 1.0, -0.5, 0.0, -2.0), (30, 1.0, 0.4, 0.5, 9.0)], "n_clusters long, noise_ratio double, silhouette double, diversity double, coherence double")
    low, high = [r.composite for r in quality.with_composite_score(df).collect()]
    assert low == pytest.approx(0.15 * -0.4 + 0.15)
    assert high == pytest.approx(0.1 + 0.125 + 0.15 + 0.15)


def test_grid_and_ranking(spark):
    grid = quality.expand_grid(spark)
    assert grid.count() == 270 and grid.distinct().count() == 270
    rows = [(t, c) for t, c in ((0, 0.5), (1, float("nan")), (2, 0.50001), (3, None), (4, 0.7))]
    metrics = grid.join(spark.createDataFrame(rows, "trial_id int, composite double"), "trial_id")
    assert [r.trial_id for r in quality.rank_trials(metrics).collect()] == [4, 0, 2, 1, 3]
    assert quality.best_trial(metrics).first().trial_id == 4


def test_ctfidf_by_hand(spark):
    tokens = spark.createDataFrame([(1, ["A", "a", "b"]), (2, ["b", "c"]), (3, ["c"])], "doc_id long, tokens array<string>")
    topics = spark.createDataFrame([(1, 0), (2, 1), (3, 1)], "doc_id long, topic int")
    counts = represent.topic_term_counts(tokens, topics)
    assert {(r.topic, r.word): r.n for r in counts.collect()} == {(0, "a"): 2, (0, "b"): 1, (1, "b"): 1, (1, "c"): 2}
    scores = {(r.topic, r.word): r.score for r in represent.ctfidf(counts).collect()}
    assert scores[0, "a"] == pytest.approx(2 / 3 * math.log(1 + 3 / 2))
    assert scores[1, "b"] == pytest.approx(1 / 3 * math.log(1 + 3 / 2))
    kept = represent.filter_vocabulary(counts, min_df=1, max_df=0.5).collect()
    assert {r.word for r in kept} == {"a", "c"}
    assert {r.word for r in represent.filter_vocabulary(counts, min_df=2, max_df=1.0).collect()} == {"b"}


def test_top_words_break_ties_by_word(spark):
    df = spark.createDataFrame([(0, "b", 1.0), (0, "a", 1.0), (0, "c", 2.0)], "topic int, word string, score double")
    assert [(r.rank, r.word) for r in represent.top_words(df, 2).orderBy("rank").collect()] == [(1, "c"), (2, "a")]


def test_mmr(spark):
    rng = np.random.default_rng(3)
    vec = {f"w{i:02d}": rng.normal(size=4) for i in range(20)}
    topic = rng.normal(size=4)
    candidates = spark.createDataFrame([(0, i + 1, w) for i, w in enumerate(vec)], "topic int, rank int, word string")
    words = spark.createDataFrame([(w, v.tolist()) for w, v in vec.items()], "word string, vec array<double>")
    topics = spark.createDataFrame([(0, topic.tolist())], "topic int, vec array<double>")
    got = [r.word for r in represent.mmr_words(candidates, words, topics, 0.6, 6).orderBy("rank").collect()]
    cos = lambda a, b: a @ b / np.linalg.norm(a) / np.linalg.norm(b)
    want = [max(vec, key=lambda w: cos(vec[w], topic))]
    while len(want) < 6:
        rest = [w for w in vec if w not in want]
        want.append(max(rest, key=lambda w: 0.4 * cos(vec[w], topic) - 0.6 * max(cos(vec[w], vec[c]) for c in want)))
    assert got == want


def test_representation_modes(spark):
    scores = spark.createDataFrame([(0, w, s) for w, s in (("a", 3.0), ("b", 2.0), ("c", 1.0))], "topic int, word string, score double")
    flip = lambda c: represent.top_words(c.withColumn("score", -F.col("score")), 2)
    models = {"Flip": flip, "Cut": lambda c: c.where("rank <= 1")}
    rows = represent.represent(scores, models, ("Flip", "Nope", "Cut"), n=2).collect()
    assert {(r.aspect, r.rank, r.word) for r in rows} == {
        (represent.MAIN, 1, "a"), (represent.MAIN, 2, "b"), ("Flip", 1, "c"), ("Flip", 2, "b"), ("Cut", 1, "a"),
    }
    chained = represent.represent(scores, models, ("Flip", "Cut"), "chained").collect()
    assert [(r.aspect, r.word) for r in chained] == [(represent.MAIN, "c")]
    with pytest.raises(ValueError):
        represent.represent(scores, models, mode="other")


def test_reports(spark, words):
    topics = spark.createDataFrame([(1, 0), (2, 0), (3, 1), (4, -1)], "doc_id long, topic int")
    listed = words.withColumn("aspect", F.lit(represent.MAIN))
    info = represent.topic_info(topics, listed).collect()
    assert [(r.Topic, r.Count, r.Name) for r in info] == [(-1, 1, "-1_z"), (0, 2, "0_a_b"), (1, 1, "1_a_c_never")]
    summary = represent.run_summary(topics).first()
    assert (summary.n_documents, summary.n_topics, summary.n_outliers, summary.pct_outliers) == (4, 2, 1, 25.0)
    reps = spark.createDataFrame([(0, 1, 2), (0, 2, 1)], "topic int, rank int, doc_id long")
    corpus = spark.createDataFrame([(1, "one"), (2, "two")], "doc_id long, text string")
    prompts = {r.topic: r.prompt for r in represent.label_prompts(listed, reps, corpus, template="[KEYWORDS]|[DOCUMENTS]").collect()}
    assert prompts == {0: "a, b|- two\n- one\n", 1: "a, c, never|"}


def test_scores_go_to_the_documents(spark, monkeypatch):
    """The words of documents stay where they are, and the result does not depend on that."""
    tokens = spark.createDataFrame([(i, [f"w{j}" for j in range(i % 5 + 1)]) for i in range(40)], "doc_id long, tokens array<string>")
    topics = spark.createDataFrame([(i, i % 3) for i in range(40)], "doc_id long, topic int")
    scores = represent.ctfidf(represent.topic_term_counts(tokens, topics))
    held = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        got = []
        for bound, joins in ((represent.SHARED_SCORES, 1), (0, 0)):
            monkeypatch.setattr(represent, "SHARED_SCORES", bound)
            reps = represent.representative_docs(tokens, topics, scores, 2)
            plan = reps._jdf.queryExecution().optimizedPlan().toString()
            assert plan.count("rightHint=(strategy=broadcast)") == joins
            got.append(sorted((r.topic, r.rank, r.doc_id, round(r.similarity, 9)) for r in reps.collect()))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", held)
    assert got[0] == got[1] and len(got[0]) == 6

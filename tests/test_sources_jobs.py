import os
import time

import numpy as np
import pytest

from topicweave.operators import quality, represent, tokens as tok, tuning
from topicweave.plans import jobs
from topicweave.scratch import Scratch
from topicweave.sources import readers, writers


def test_csv_edges(spark, tmp_path):
    text = '﻿id,text,score\n1,"a ""q"" b",1.5\n2,"two\nlines",NA\n3,,2\n4,NA,x\n5,"", 3\n6," keep ",nan\n'
    (tmp_path / "c.csv").write_text(text, encoding="utf-8")
    df = readers.read_corpus_csv(spark, str(tmp_path / "c.csv"), "id long, text string, score double")
    got = {r.id: (r.text, r.score) for r in df.collect()}
    assert got == {
        1: ('a "q" b', 1.5), 2: ("two\nlines", None), 3: (None, 2.0), 4: (None, None), 5: (None, 3.0), 6: (" keep ", None),
    }
    raw = readers.read_corpus_csv(spark, str(tmp_path / "c.csv"), pandas_na=False)
    assert raw.columns == ["id", "text", "score"] and raw.where("text = 'NA'").count() == 1


def _csv_rows(rng, n):
    words = ["plain", 'a "quoted" word', "two\nlines", "\n\n", "", 'x"y', "comma, here", "é가😀", '"', "\r\nend", " lead", "long " * 30]
    return [(str(i), *(" ".join(rng.choice(words, 2)) for _ in range(2))) for i in range(n)]


def _csv_bytes(rng, rows, end):
    field = lambda v: '"' + v.replace('"', '""') + '"' if rng.random() < 0.2 or any(c in v for c in ',"\n\r') else v
    return end.join(",".join(map(field, r)) for r in [("id", "a", "b"), *rows]).encode("utf-8")


@pytest.fixture
def small_splits(spark):
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "2000")
    yield
    spark.conf.set("spark.sql.files.maxPartitionBytes", old)


def test_csv_with_line_breaks_is_read_in_splits(spark, tmp_path, small_splits):
    rng = np.random.default_rng(1)
    for i, n in enumerate((400, 1, 0)):
        (tmp_path / f"{i}.csv").write_bytes(_csv_bytes(rng, _csv_rows(rng, n), "\n"))
    # a stray quote in an unquoted field opens nothing; empty lines are no records; one text spans several splits
    (tmp_path / "3.csv").write_bytes(b'id,a,b\n\n1,5" pipe,x\n\n2,"' + b"word\n" * 3000 + b'",y\n3,,""""\n')
    one_task = spark.read.options(header=True, multiLine=True, quote='"', escape='"').csv(str(tmp_path))
    assert spark.read.text(str(tmp_path / "0.csv")).rdd.getNumPartitions() >= 8
    got = readers.read_corpus_csv(spark, str(tmp_path), pandas_na=False).collect()
    assert len(got) == 404 and sorted(map(str, got)) == sorted(map(str, one_task.collect()))


def test_csv_keeps_line_breaks_of_either_kind(spark, tmp_path, small_splits):
    rng = np.random.default_rng(2)
    rows = _csv_rows(rng, 300)
    (tmp_path / "c.csv").write_bytes(b"\xef\xbb\xbf" + _csv_bytes(rng, rows, "\r\n"))
    got = readers.read_corpus_csv(spark, str(tmp_path), pandas_na=False).collect()
    assert sorted(tuple(v or "" for v in r) for r in got) == sorted(rows)


def test_csv_without_rows(spark, tmp_path):
    (tmp_path / "none.csv").write_bytes(b"")
    none = readers.read_corpus_csv(spark, str(tmp_path / "none.csv"))
    assert none.columns == [] and none.count() == 0
    (tmp_path / "open.csv").write_bytes(b'id,text\n1,"never closed\nsecond line\n')
    assert [(r.id, r.text.rstrip("\n")) for r in readers.read_corpus_csv(spark, str(tmp_path / "open.csv")).collect()] == [("1", "never closed\nsecond line")]


def test_quotes_open_fields_only_at_their_beginning():
    from topicweave.sources.records import ends_inside

    cases = {'a,b': 0, 'a,"b': 1, '"a""': 1, '"a"': 0, '""': 0, '"""': 1, '""""': 0, 'a"b,c': 0, '"a,b",c': 0, '"a" x,"': 1, ',"': 1, '': 0}
    for line, inside in cases.items():
        assert ends_inside(line, False) == bool(inside), line
    assert ends_inside('b",c', True) is False and ends_inside('b""', True) is True and ends_inside('",', True) is False
    assert ends_inside('b","', True) is True and ends_inside("", True) is True


def test_word_list_and_user_dict(spark, tmp_path):
    (tmp_path / "w.txt").write_text("# note\n  그 \n\nthe\nthe\n", encoding="utf-8")
    words = readers.read_word_list(spark, str(tmp_path / "w.txt"))
    assert sorted(r.word for r in words.collect()) == ["the", "그"]
    assert readers.read_word_list(spark, str(tmp_path / "w.txt"), distinct=False).count() == 3
    (tmp_path / "d.txt").write_text("청소년\tNNG\n인공지능\n\"quo\tNNG\n", encoding="utf-8")
    got = {r.term: r.tag for r in readers.read_user_dict(spark, str(tmp_path / "d.txt")).collect()}
    assert got == {"청소년": "NNG", "인공지능": "NNP", '"quo': "NNG"}


def test_latest_artifact(spark, tmp_path):
    for i, name in enumerate(("b_info.json", "a_info.json", "c.csv")):
        (tmp_path / name).write_text("{}")
        os.utime(tmp_path / name, (time.time() + i, time.time() + i))
    assert readers.latest_artifact(spark, str(tmp_path), "*_info.json").endswith("a_info.json")
    assert readers.latest_artifact(spark, str(tmp_path), "*.npy") is None


def test_tuned_config_round_trip(spark, tmp_path):
    assert readers.load_tuned_config(spark, str(tmp_path / "none")) == readers.DEFAULT_PARAMETERS
    metrics = quality.expand_grid(spark).where("trial_id = 17").selectExpr(
        "*", "21L n_clusters", "0.1D noise_ratio", "0.2D silhouette", "0.3D diversity", "0.4D coherence", "0.5D composite"
    )
    writers.write_tuned_config(quality.best_trial(metrics), 1, str(tmp_path), "r1")
    got = readers.load_tuned_config(spark, str(tmp_path / "tuned_config"))
    row = metrics.first()
    assert {k: got[k] for k in quality.PARAMETERS} == {k: row[k] for k in quality.PARAMETERS}


@pytest.fixture(scope="module")
def groups(spark):
    """Three groups of documents with words and vectors of their own."""
    rng = np.random.default_rng(5)
    centers = rng.normal(size=(3, 8)) * 3
    docs, vectors = [], []
    for i in range(150):
        g = i % 3
        docs.append((i, " ".join(f"g{g}w{j}" for j in rng.integers(0, 12, 8)) + " common"))
        vectors.append((i, (centers[g] + rng.normal(size=8) * 0.3).tolist()))
    return (
        spark.createDataFrame(docs, "doc_id long, text string"),
        spark.createDataFrame(vectors, "doc_id long, vec array<double>"),
    )


def test_tune_then_model(spark, groups, tmp_path):
    docs, vectors = groups
    out = str(tmp_path)
    ranked = jobs.tune(
        docs, vectors,
        {"n_neighbors": [10], "n_components": [3], "min_dist": [0.0]},
        {"min_cluster_size": [20, 60], "min_samples": [5], "cluster_method": ["eom"]},
        target=(2, 5), min_df=1, max_df=0.95, n_epochs=60, rounds=2, out=out,
    ).collect()
    assert ranked[0].min_cluster_size == 20 and ranked[0].n_clusters == 3
    assert ranked[0].diversity == 1.0 and ranked[0].silhouette > 0.5
    result = jobs.model(
        docs, vectors, tuned_dir=f"{out}/tuned_config", min_df=1, n_epochs=60, rounds=2, out=out,
        knn_method="ivf", embedding_model="hash", prompt="words: [KEYWORDS]\n[DOCUMENTS]",
    )
    topics = {r.doc_id: r.topic for r in result.doc_topics.collect()}
    named = {g: {topics[i] for i in range(150) if i % 3 == g} - {-1} for g in range(3)}
    assert all(len(t) == 1 for t in named.values())
    for r in result.topic_words.where("topic >= 0").collect():
        group = next(g for g, t in named.items() if r.topic in t)
        assert r.word.startswith(f"g{group}")
    assert {r.aspect for r in result.topic_words.select("aspect").distinct().collect()} == {represent.MAIN, "KeyBERT", "MMR"}
    folder = f"{out}/topic_model/{os.listdir(f'{out}/topic_model')[0]}"
    assert readers.load_topic_model(spark, folder)["doc_topics"].count() == 150
    for part in ("topic_info", "doc_topics", "run_summary", "tuning_results"):
        assert os.listdir(f"{out}/{part}")
    summary = spark.read.json(f"{out}/run_summary").first()
    assert summary.elapsed_seconds > 0 and summary.embedding_model == "hash" and summary.n_documents == 150
    prompts = {r.topic: r.prompt for r in spark.read.json(f"{out}/label_prompts").collect()}
    assert prompts == {r.topic: r.prompt for r in result.prompts.collect()} and set(prompts) == {0, 1, 2}
    assert all(p.startswith("words: g") and p.count("\n- ") == 4 for p in prompts.values())


def test_a_failing_reduction_costs_its_own_trials_only(spark, groups, tmp_path, monkeypatch):
    docs, vectors = groups
    tokens = tok.tokenize_whitespace(docs).select("doc_id", "tokens")
    trials = quality.expand_grid(
        spark, {"n_neighbors": [5, 8], "n_components": [2], "min_dist": [0.0]}, {"min_cluster_size": [10], "min_samples": [3], "cluster_method": ["eom", "leaf"]}
    )
    calls = []

    def failing(points, knn, scratch, n_components, n_neighbors, *rest):
        calls.append(n_neighbors)
        if n_neighbors == 8 and len(calls) < 3:
            raise ValueError("no room")
        return points

    def measured(reduced, doc_topics, *rest):
        return doc_topics.selectExpr("trial_id", "2L AS n_clusters", "0.1D AS noise_ratio", "0.2D AS silhouette", "0.3D AS diversity", "0.4D AS coherence")

    grid = lambda vectors, trials, **more: spark.createDataFrame([(t[0],) for t in trials], "trial int")
    monkeypatch.setattr(tuning, "reduce_points", failing)
    monkeypatch.setattr(tuning, "cluster_grid", grid)
    monkeypatch.setattr(tuning, "trial_metrics", measured)
    ledger = f"{tmp_path}/ledger"
    run = lambda: tuning.run_trials(vectors, tokens, trials, min_df=1, n_epochs=20, rounds=2, ledger=ledger).collect()
    first = run()
    assert {r.n_neighbors for r in first} == {5} and len(first) == 2
    failures = tuning.Ledger(spark, ledger).failures().collect()
    assert {(r.n_neighbors, r.cluster_method, r.error) for r in failures} == {(8, m, "ValueError: no room") for m in ("eom", "leaf")}
    second = run()
    assert calls == [5, 8, 8]
    assert {r.n_neighbors for r in second} == {5, 8} and len(second) == 4
    assert tuning.Ledger(spark, ledger).failures().isEmpty()
    run()
    assert calls == [5, 8, 8]
    monkeypatch.setattr(tuning, "reduce_points", lambda *a: 1 / 0)
    with pytest.raises(RuntimeError):
        tuning.run_trials(vectors, tokens, trials, min_df=1).collect()


def test_embed(spark, tmp_path):
    df = spark.createDataFrame([("x", "a b"), ("x", "a b"), ("y", "c"), ("x", ""), ("x", None)], "v string, abstract string")
    docs, vectors = jobs.embed(df, verify_column="v", verify_values=["x"], out=str(tmp_path), model_name="hash")
    assert sorted((r.doc_id, r.abstract) for r in docs.collect()) == [(0, "a b"), (1, "a b")]
    assert vectors.count() == 2
    info = spark.read.json(f"{tmp_path}/info").first()
    assert (info.n_documents, info.embedding_dim, info.model_name) == (2, 64, "hash")


def test_words_of_a_model_are_not_left_in_few_tasks(spark, monkeypatch):
    """Documents that a filter leaves in one of many files are dealt out before their words are taken."""

    class Written(Exception):
        pass

    def stop(*_, **__):
        raise Written

    rows = []
    table = Scratch.table

    def watched(self, df, name="t", *more, **options):
        if name == "tokens":
            rows.extend(df.rdd.mapPartitions(lambda part: [sorted(r.doc_id for r in part)]).collect())
        return table(self, df, name, *more, **options)

    docs = spark.range(0, 8000, 1, 8).where("id < 1000").selectExpr("id AS doc_id", "concat('word', id, ' other') AS text")
    vectors = docs.selectExpr("doc_id", "array(1.0D, doc_id) AS vec")
    monkeypatch.setattr(jobs, "reduce_dimensions", stop)
    monkeypatch.setattr(Scratch, "table", watched)
    with pytest.raises(Written):
        jobs.model(docs, vectors)
    assert sorted(i for part in rows for i in part) == list(range(1000))
    assert max(map(len, rows)) < 400


def test_dealing_out_is_not_left_to_a_join(spark):
    ids = spark.range(100).withColumnRenamed("id", "doc_id")
    joined = ids.join(ids.hint("merge"), "doc_id", "left_semi")
    assert "REPARTITION_BY_NUM" in jobs.dealt_out(joined)._jdf.queryExecution().executedPlan().toString()

import pytest
from pyspark.sql import functions as F

from topicweave.operators import corpus


def test_text_column_order(spark):
    df = spark.createDataFrame([("a", "b")], "content string, abstract string")
    assert corpus.resolve_text_column(df) == "abstract"
    assert corpus.resolve_text_column(df, "content") == "content"
    with pytest.raises(ValueError):
        corpus.resolve_text_column(spark.createDataFrame([(1,)], "x int"))


def test_verify_filter(spark):
    df = spark.createDataFrame([(1, "ok"), (2, "no"), (3, None)], "id int, v string")
    assert corpus.filter_verified(df, "missing", ["ok"]).count() == 3
    assert corpus.filter_verified(df, None).count() == 3
    assert [r.id for r in corpus.filter_verified(df, "v", ["ok"]).collect()] == [1]
    with pytest.warns(UserWarning):
        assert corpus.filter_verified(df, "v", None).count() == 0


def test_blank_text_is_kept(spark):
    df = spark.createDataFrame([(1, None), (2, ""), (3, " "), (4, "　"), (5, "x")], "id int, text string")
    assert [r.id for r in corpus.drop_empty_text(df).orderBy("id").collect()] == [3, 4, 5]
    report = corpus.missing_text_report(df).first()
    assert (report.n_rows, report.n_with_text, report.n_empty) == (5, 3, 2)


def test_truncation_counts_characters(spark):
    df = spark.createDataFrame([("가" * 2501,), ("😀" * 2501,), ("ab",)], "text string")
    lengths = corpus.truncate_text(df).select(F.char_length("text_for_embed").alias("n"), F.char_length("text").alias("m"))
    assert sorted((r.n, r.m) for r in lengths.collect()) == [(2, 2), (2500, 2501), (2500, 2501)]


def test_doc_ids_are_dense_and_stable(spark):
    rows = [(f"t{i % 7}", i % 3) for i in range(60)] + [("copy", 0)] * 40 + [(None, None)]
    df = spark.createDataFrame(rows, "text string, k int")
    given = spark.createDataFrame([(7, "a"), (7, "b")], "doc_id int, text string")
    kept = corpus.with_doc_id(given)
    assert kept.columns == ["doc_id", "text"] and [r.doc_id for r in kept.collect()] == [7, 7]
    one = corpus.with_doc_id(df.repartition(1), rows_per_task=8)
    many = corpus.with_doc_id(df.repartition(5), buckets=16, rows_per_task=3)
    key = lambda r: tuple(r)
    assert sorted(map(key, one.collect()), key=str) == sorted(map(key, many.collect()), key=str)
    assert sorted(r.doc_id for r in one.collect()) == list(range(101))
    assert sorted((r.text, r.k) for r in one.where("text is not null").collect()) == sorted(r for r in rows if r[0])


def test_doc_ids_with_clashing_names_maps_and_alike_joins(spark):
    rows = [("a\x1fb", "c", {"k": 1}), ("a", "b\x1fc", {"k": 1}), ("a", "b\x1fc", {"k": 2}), (None, "\x00", None), ("\x00", None, None)]
    df = spark.createDataFrame(rows * 3, "row string, digest string, n map<string,int>")
    got = corpus.with_doc_id(df, rows_per_task=2).collect()
    assert sorted(r.doc_id for r in got) == list(range(15))
    assert sorted(map(str, ((r.row, r.digest, r.n) for r in got))) == sorted(map(str, rows * 3))
    runs = {}
    for r in got:
        runs.setdefault(str((r.row, r.digest, r.n)), []).append(r.doc_id)
    assert all(max(ids) - min(ids) == 2 for ids in runs.values())  # equal rows lie next to each other
    assert corpus.with_doc_id(df.limit(0)).count() == 0

from pyspark.sql import functions as F

from topicweave.llm.exact import deduplicate, keep_one, normalised, sha256

from .conftest import collected


def lower(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")


def brute(rows):
    groups = {}
    for i, t in rows:
        groups.setdefault(lower(t), []).append(i)
    out = []
    for i, t in rows:
        own = groups[lower(t)]
        keep = max((x for x in own if x is not None), default=None)
        out.append((i, keep, len(own)))
    return sorted(out, key=str)


def test_groups_and_keepers(make, edge_rows):
    got = deduplicate(make(edge_rows))
    assert sorted(map(tuple, got.select("doc_id", "keep_id", "group_size").collect()), key=str) == brute(edge_rows)
    kept = got.where("kept").collect()
    assert len(kept) == len({lower(t) for _, t in edge_rows})
    assert all(r.doc_id == r.keep_id for r in kept)


def test_only_ascii_letters_are_lowered(make):
    got = deduplicate(make([(1, "É"), (2, "é"), (3, "AB"), (4, "ab")]))
    assert collected(got, "doc_id", "keep_id") == [(1, 1), (2, 2), (3, 4), (4, 4)]


def test_bytes_decide_where_digests_collide(make):
    rows = [(i, f"text {i % 17}") for i in range(200)] + [(500, None), (501, "")]
    weak = lambda text: (F.crc32(text.cast("binary")) % 5).cast("string")
    got = deduplicate(make(rows), digest=weak)
    assert sorted(map(tuple, got.select("doc_id", "keep_id", "group_size").collect()), key=str) == brute(rows)
    assert got.where("kept").count() == 18
    want = deduplicate(make(rows), digest=sha256)
    assert collected(got, "doc_id", "text_sha256") == collected(want, "doc_id", "text_sha256")


def test_many_batches_give_the_state_of_one(make):
    docs = make([(i, f"t{i % 7}") for i in range(60)]).repartition(6)
    assert collected(deduplicate(docs, batches=6), "doc_id", "keep_id") == collected(deduplicate(docs, batches=1), "doc_id", "keep_id")


def test_empty_table_and_removal(spark, make, tmp_path):
    assert deduplicate(make([])).count() == 0
    docs = make([(1, "a"), (2, "a"), (3, "b"), (3, "b")])
    docs.write.parquet(f"{tmp_path}/docs")
    for rows in (docs, spark.read.parquet(f"{tmp_path}/docs")):
        left = keep_one(rows)
        assert sorted(r.doc_id for r in left.collect()) == [2, 3]
        assert left.columns == docs.columns and normalised(F.col("text")) is not None


def test_columns_that_look_like_places_are_not_taken_for_them(spark, make, tmp_path):
    """A constant ``_locator`` and a ``_metadata`` of the table's own."""
    rows = [(1, "a"), (2, "a"), (3, "b")]
    make(rows).write.parquet(f"{tmp_path}/docs")
    for docs in (make(rows), spark.read.parquet(f"{tmp_path}/docs")):
        assert {"_locator", "_metadata"} < set(docs.columns)
        assert collected(deduplicate(docs), "doc_id", "keep_id", "group_size") == [(1, 2, 2), (2, 2, 2), (3, 3, 1)]

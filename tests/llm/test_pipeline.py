import random

import pytest

import corpus_pipeline
from topicweave.llm import pii

from .test_exact import lower
from .test_neardup import changed, classes


@pytest.fixture(scope="module")
def folder(spark, make, tmp_path_factory):
    """Documents with junk, copies, near copies and personal data, and labels for half of them."""
    rnd = random.Random(7)
    rows = []
    for i in range(60):
        text = " ".join(f"w{rnd.randrange(900)}" for _ in range(60)) + (f" me{i}@mail.org" if i % 4 == 1 else "")
        rows.append((i, text))
        if i % 6 == 0:
            rows += [(100 + i, text.upper()), (200 + i, changed(rnd, text, 1)), (300 + i, text + " more")]
        rows.append((400 + i, " ".join(rnd.choice(["!!!", "###", "$$$"]) for _ in range(30))))
    rows += [(None, rows[0][1]), (500, None), (501, ""), (502, " ".join(f"w{rnd.randrange(900)}" for _ in range(30_000)))]
    path = str(tmp_path_factory.mktemp("tables"))
    make(rows).write.parquet(f"{path}/documents.parquet")
    labels = [(i, int(i < 400), 0) for i, _ in rows if i is not None and i % 2 == 0 and i < 500]
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{path}/labels.parquet")
    return path


def test_each_stage_on_the_output_of_the_last(spark, folder, tmp_path):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    columns = docs.columns
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
        out = stage(spark, docs, folder)
        out.write.parquet(f"{tmp_path}/{k}")
        before, after = docs.collect(), spark.read.parquet(f"{tmp_path}/{k}")
        rows = after.collect()
        if name != "packing":
            assert after.columns == columns
        texts = [(r.doc_id, r.text) for r in before]
        if name == "quality":
            good = [t for t in texts if t[1] and "w" in t[1].lower()]
            assert set(good) <= {(r.doc_id, r.text) for r in rows}
            assert not any(r.text and "###" in r.text for r in rows)
        elif name == "exact_dedup":
            assert sorted(lower(r.text) for r in rows) == sorted({lower(t) for _, t in texts})
        elif name == "near_dedup":
            known = [t for t in texts if t[0] is not None]
            assert {r.doc_id for r in rows if r.doc_id is not None} == {c for _, c in classes(known)}
        elif name == "pii":
            assert len(rows) == len(before)
            assert not any("@" in (r.text or "") for r in rows) and any("[email]" in (r.text or "") for r in rows)
            assert all(r.n_chars == len(r.text) for r in rows if r.text is not None)
        else:
            assert {r.doc_id for r in rows} == {r.doc_id for r in before}
        docs = after
    assert sorted(map(tuple, corpus_pipeline.run(spark, folder).collect()), key=str) == sorted(map(tuple, docs.collect()), key=str)
    assert pii.KINDS[0] == "email"

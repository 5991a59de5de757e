import random
import zlib

import numpy as np
import pytest

from topicweave.llm import quality, toxicity


def labels_of(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, quality int, toxic int")


def test_votes_are_those_of_all_cosines():
    rng = np.random.default_rng(2)
    words = [f"w{i}" for i in range(80)]
    texts = [(" ".join(rng.choice(words[: 50 if y else 80], 40)), y) for y in (0, 1) for _ in range(60)]
    space = quality.fit(texts, {0: 100, 1: 900})
    new = [" ".join(rng.choice(words, 30)) for _ in range(20)] + [""]
    x = space.project(new).astype(float)
    got = space.score(new)
    for row, score in zip(x, got, strict=True):
        cosine = sorted(((float(row @ v), i) for i, v in enumerate(space.vectors.astype(float))), reverse=True)[: quality.NEIGHBOURS]
        votes = np.array([max(c, 0) ** 4 * space.votes[i] for c, i in cosine]).sum(axis=0)
        lean = quality.PRIOR * 1000 / len(texts)
        assert score == pytest.approx((votes[1] + lean * 0.9) / (votes.sum() + lean), abs=1e-4)
    assert got[-1] == pytest.approx(0.9, abs=0.05)


def test_shapes_and_repeats_are_seen():
    assert quality.shape("Hello,") == "Aa," and quality.shape("12-34") == "9-9" and quality.shape("###") == "#"
    space = quality.fit([("a b c d", 1), ("a a a a", 0)] * 4, {0: 1, 1: 1})
    assert space.terms_of("x x y y y")[3] == 3


def test_a_machine_learns_what_only_a_pair_tells():
    rng = np.random.default_rng(4)
    filler = [f"f{i}" for i in range(30)]
    texts = []
    for _ in range(400):
        insult, group = (int(x < 0.5) for x in rng.random(2))
        words = list(rng.choice(filler, 6)) + ["insult"] * insult + ["people"] * group
        texts.append((" ".join(words), int(insult != group)))  # a sum of weights gets three quarters right at most
    machine = toxicity.fit(texts, {0: 200, 1: 200})
    want = np.array([y for _, y in texts])
    got = machine.score([machine.terms_of(t) for t, _ in texts]) >= 0.5
    assert (got == want).mean() > 0.8


def test_raw_values_are_those_of_the_formula():
    rng = np.random.default_rng(5)
    machine = toxicity.Machine(np.arange(50), 0.3, rng.normal(size=50), rng.normal(size=(50, 4)))
    for size in (0, 1, 2, 7):
        at = rng.choice(50, size, replace=False)
        want = 0.3 + machine.weight[at].sum() + sum(
            machine.factor[i] @ machine.factor[j] for k, i in enumerate(at) for j in at[k + 1 :]
        )
        assert machine.raw([at])[0] == pytest.approx(want)


@pytest.mark.parametrize("module", [quality, toxicity])
def test_edges(spark, make, edge_rows, module):
    docs = make(edge_rows)
    none = labels_of(spark, [])
    got = module.score_documents(docs, none).collect()
    assert len(got) == len(edge_rows) and all(r.score == 0.5 for r in got)
    some = labels_of(spark, [(1, 1, 0), (2, 0, 1), (5, 1, 0), (None, 1, 1), (6, None, None), (7, 0, 1), (99, 1, 1), (3, 1, 0), (3, 1, 0)])
    got = module.score_documents(docs, some).collect()
    assert len(got) == len(edge_rows) and all(0 <= r.score <= 1 for r in got)
    assert module.score_documents(make([]), some).count() == 0


def test_rejected_rows_go_and_others_stay_as_they_are(spark, make):
    good, bad = "plain words that follow one another here", "!!! ### $$$ !!! ### $$$ !!!"
    docs = make([(i, good if i % 2 else bad) for i in range(40)] + [(None, good), (41, good), (41, good)])
    left = quality.keep_good(docs, labels_of(spark, [(i, i % 2, 0) for i in range(40)]))
    assert left.columns == docs.columns
    assert {r.text for r in left.collect()} == {good} and left.count() == 23


@pytest.mark.parametrize("module, column, divisor, out, least", [(quality, "quality", 4, 2, 0.95), (toxicity, "toxic", 5, 0, 0.9)])
def test_held_out_accuracy(spark, module, column, divisor, out, least):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    labels = spark.read.parquet("/root/testdata/sf0.01/labels.parquet")
    got = module.score_documents(docs, labels).join(labels, "doc_id").collect()
    held = [r for r in got if zlib.crc32(str(r.doc_id).encode()) % divisor == out]
    assert held and all(r.held_out for r in held)
    assert sum(r.predicted == r[column] for r in held) / len(held) > least


@pytest.mark.parametrize("of", [quality, toxicity])
def test_a_class_of_long_texts_only_is_learnt(spark, make, of):
    rnd = random.Random(9)
    plain = [" ".join(f"word{rnd.randrange(300)}" for _ in range(50)) for _ in range(60)]
    other = [" ".join(rnd.choice(["###", "bad$", "!!!"]) for _ in range(12_000)) for _ in range(30)]
    rows = [(i, t) for i, t in enumerate(plain)] + [(1000 + i, t) for i, t in enumerate(other)]
    labels = [(i, int(i < 1000), int(i >= 1000)) for i, _ in rows] + [(5000 + i, 0, 0) for i in range(500)]  # the last have no document
    labels = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    got = of.score_documents(make(rows), labels).collect()
    assert all(r.predicted == ((r.doc_id < 1000) if of is quality else (r.doc_id >= 1000)) for r in got)

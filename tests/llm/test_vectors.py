import numpy as np
import pytest

from topicweave.llm.vectors import link

from .conftest import collected


def brute(rows, threshold):
    good = [(i, np.array(v, dtype=float)) for i, v in rows if i is not None and v and all(x is not None and np.isfinite(x) for x in v) and any(v)]
    root = {i: i for i, _ in rows}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    links = []
    for k, (i, a) in enumerate(good):
        n = 0
        for m, (j, b) in enumerate(good):
            if k != m and len(a) == len(b) and a @ b / np.linalg.norm(a) / np.linalg.norm(b) >= threshold:
                n += 1
                x, y = sorted((find(i), find(j)))
                root[y] = x
        links.append((i, n))
    others = [(i, 0) for i, v in rows if not any(g is not None and i == g for g, _ in good)]
    return sorted(((i, n, find(i)) for i, n in links + others), key=str)


def planted(seed=1, dim=8):
    rng = np.random.default_rng(seed)
    rows = []
    for c in range(20):
        center = rng.normal(size=dim)
        for _ in range(rng.integers(1, 30)):
            rows.append(center + rng.normal(size=dim) * 0.12)
    rows += [rows[0]] * 5 + [rows[3] * 7.0]
    table = [(int(i), [float(x) for x in np.float32(v)]) for i, v in zip(rng.permutation(len(rows)), rows, strict=True)]
    n = len(table)
    return table + [
        (n, None), (n + 1, [0.0] * dim), (n + 2, []), (n + 3, [float("nan")] * dim), (n + 4, [None] + [1.0] * (dim - 1)),
        (n + 5, [float("inf")] * dim), (n + 6, [1.0, 2.0]), (n + 7, [2.0, 4.0]),
    ]


@pytest.mark.parametrize("kind, block", [("float", 16), ("double", 16), ("float", 2048)])
def test_links_are_those_of_all_pairs(spark, kind, block):
    rows = planted()
    table = spark.createDataFrame(rows, f"vec_id long, embedding array<{kind}>").selectExpr("*", "1 AS label", "'x' AS row", "0 AS rep")
    got = link(table, block=block)
    assert collected(got, "vec_id", "n_links", "component_id") == sorted(brute(rows, 0.95))
    assert all(r.kept == (r.vec_id == r.component_id) for r in got.collect())


def test_edges(spark):
    schema = "vec_id long, embedding array<float>"
    assert link(spark.createDataFrame([], schema)).count() == 0
    rows = [(None, [1.0, 0.0]), (1, [1.0, 0.0]), (1, [1.0, 0.0]), (2, [0.0, 1.0]), (3, None)]
    got = sorted(map(tuple, link(spark.createDataFrame(rows, schema)).collect()), key=str)
    assert got == sorted([(None, 0, None, True), (1, 1, 1, True), (1, 1, 1, True), (2, 0, 2, True), (3, 0, 3, True)], key=str)

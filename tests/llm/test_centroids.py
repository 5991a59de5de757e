import hashlib
import math
import random
import struct

import numpy as np
import pytest
from pyspark.sql import functions as F

from topicweave.llm.centroids import Segment, cluster

SCHEMA = "vec_id long, embedding array<float>, label int, cluster string, distance string"


def brute(rows, k=8, rounds=10):
    """(vec_id, cluster, distance, centroid digest) in plain integers."""
    kept = [
        (i, [math.floor(1024 * x) if abs(x) < 2**40 else int(x) * 1024 for x in v])
        for i, v in rows
        if v is not None and len(v) == 64 and all(x is not None and math.isfinite(x) for x in v)
    ]
    first = sorted(kept, key=lambda r: (hashlib.sha256(f"3:{'' if r[0] is None else r[0]}".encode()).hexdigest(), r[1]))
    centroids = [list(v) for _, v in first[:k]]
    away = lambda v, c: sum((a - b) ** 2 for a, b in zip(v, c))
    nearest = lambda v: min((away(v, c), i) for i, c in enumerate(centroids))
    for _ in range(rounds):
        groups = {}
        for _, v in kept:
            groups.setdefault(nearest(v)[1], []).append(v)
        for c, own in groups.items():
            centroids[c] = [sum(x) // len(own) for x in zip(*own)]
    digest = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centroids]
    out = []
    for i, v in kept:
        d, c = nearest(v)
        out.append((i, c, d if d < 2**63 else None, digest[c]))
    return out


def single(x):
    return struct.unpack("f", struct.pack("f", x))[0]


def vectors(rng, n):
    return [(i, [single(rng.gauss(0, 0.125)) for _ in range(64)]) for i in range(n)]


def run(spark, rows, **more):
    return cluster(spark.createDataFrame([(i, v, 1, "x", "y") for i, v in rows], SCHEMA).repartition(5), **more)


def as_key(rows):
    return sorted(map(tuple, rows), key=str)


@pytest.mark.parametrize("segment", [7, 1 << 14])
def test_equals_brute_force_with_copies_and_unusable_vectors(spark, segment):
    rng = random.Random(1)
    rows = vectors(rng, 90)
    rows += [(200 + i, rows[3][1]) for i in range(60)]  # one vector for a third of the rows
    rows += [(5, rows[6][1]), (5, rows[5][1]), (None, rows[8][1]), (None, None), (300, None), (301, []), (302, [0.0] * 63)]
    rows += [(303, [float("nan")] + [0.0] * 63), (304, [float("inf")] + [0.0] * 63), (305, [None] + [0.0] * 63), (306, [0.0] * 64)]
    got = run(spark, rows, segment=segment)
    assert got.columns[:6] == ["vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"]
    found = got.collect()
    assert as_key((r.vec_id, r.cluster, r.distance, r.centroid_sha256) for r in found) == as_key(brute(rows))
    for r in found:
        assert r.cluster_inertia == sum(x.distance for x in found if x.cluster == r.cluster)
        assert r.inertia == sum(x.distance for x in found)


def test_numbers_beyond_long_integers_are_exact(spark):
    rng = random.Random(2)
    rows = vectors(rng, 20) + [(100 + i, [single(rng.uniform(-3e38, 3e38)) for _ in range(64)]) for i in range(6)]
    got = run(spark, rows, k=3, rounds=2).collect()
    assert as_key((r.vec_id, r.cluster, r.distance, r.centroid_sha256) for r in got) == as_key(brute(rows, 3, 2))
    assert any(r.distance is None and r.cluster_inertia is None and r.inertia is None for r in got)


def test_fewer_vectors_than_centroids_and_none(spark):
    rows = [(1, [0.5] * 64), (2, [0.5] * 64), (3, [-0.5] * 64)]
    got = run(spark, rows).collect()
    assert as_key((r.vec_id, r.cluster, r.distance, r.centroid_sha256) for r in got) == as_key(brute(rows))
    assert run(spark, [(1, None)]).collect() == []
    assert [f.simpleString() for f in run(spark, [(1, None)]).schema] == [f.simpleString() for f in run(spark, rows).schema]


def test_segments_are_lossless_and_join_blocks_of_copies():
    rng = np.random.default_rng(3)
    unlike = rng.integers(-30, 30, (4000, 16))
    copies = np.repeat(unlike[:2], 2000, axis=0)
    for rows, blocks in ((unlike, 16), (copies, 1)):
        segment = Segment.encode(rows)
        back = np.concatenate([e[c] for e, c in segment.blocks], axis=1)
        assert (back == rows).all()
        assert len(segment.blocks) == blocks
        centroids = rng.integers(-300, 300, (3, 16))
        assert (segment.distances(centroids) == ((rows[:, None] - centroids[None]) ** 2).sum(2)).all()


def test_no_dependence_on_order_or_partitions(spark):
    rows = vectors(random.Random(4), 120)
    one = run(spark, rows).collect()
    df = spark.createDataFrame([(i, v, 1, "x", "y") for i, v in rows], SCHEMA).orderBy(F.desc("vec_id")).coalesce(1)
    assert as_key(cluster(df).collect()) == as_key(one)

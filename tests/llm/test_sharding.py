import hashlib
import math
import zlib
from collections import Counter

from topicweave.llm.sharding import shard_documents, shard_of, tree_of
from pyspark.sql import functions as F


def draw(key, name, weight):
    number = int(hashlib.md5(f"{key}/{name}".encode()).hexdigest()[:13], 16)
    return -math.log((number + 0.5) / 2.0**52) / weight


def brute(key, tree):
    def weight(node):
        return sum(map(weight, node.values())) if isinstance(node, dict) else node

    region = min(tree, key=lambda r: draw(key, r, weight(tree[r])))
    rack = min(tree[region], key=lambda k: draw(key, f"{region}/{k}", weight(tree[region][k])))
    return min(tree[region][rack], key=lambda s: draw(key, f"{region}/{rack}/{s}", tree[region][rack][s]))


def test_shards_are_those_of_a_plain_descent(spark, make, edge_rows):
    rows = {tuple(r) for r in map(tuple, edge_rows)}
    got = shard_documents(make(edge_rows)).collect()
    assert len(got) == len(edge_rows)
    by_shard = {}
    for r in got:
        key = "" if r.doc_id is None else str(r.doc_id)
        assert r.shard == brute(key, tree_of(24)) and r.grown_shard == brute(key, tree_of(25))
        assert r.grown_shard in (r.shard, 24) and r.law == "key"
        texts = [t.encode() if t else b"" for i, t in rows if i == r.doc_id]
        assert (r.size - 8, r.text_crc32) in [(len(t), zlib.crc32(t)) for t in texts]
        by_shard.setdefault(r.shard, []).append(r.slot)
    for slots in by_shard.values():
        assert sorted(slots) == list(range(len(slots)))


def test_shards_are_even_and_movement_is_confined(spark):
    keys = spark.range(24_000).select(F.col("id").cast("string").alias("k"))
    base, grown = tree_of(24), tree_of(25)
    heavier = tree_of(24)
    heavier["region1"]["rack0"][9] = 2.0
    got = keys.select(*(shard_of(F.col("k"), t).alias(n) for n, t in (("a", base), ("b", grown), ("c", heavier)))).collect()
    counts = Counter(r.a for r in got)
    assert len(counts) == 24 and all(abs(n - 1000) < 150 for n in counts.values())
    moved = [r for r in got if r.a != r.b]
    assert all(r.b == 24 for r in moved) and abs(len(moved) - 24_000 / 25) < 150
    region = lambda s: s // 8
    for r in got:  # only region 1 gained weight: the others keep all inner places
        assert r.a == r.c or region(r.c) == 1


def test_empty_table(spark, make):
    assert shard_documents(make([])).count() == 0

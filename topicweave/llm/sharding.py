"""Placing documents in shards by a hierarchical weighted hash tree.

Regions hold racks and racks hold shards.  At each level every child draws a
number from a hash of the document id and the child's own name, divided by the
child's weight; the smallest draw wins and the descent goes on inside the winner.
A child's draw depends on no other child, so when a weight changes, rows move
only into subtrees that gained weight or out of those that lost it.

A further shard opens a region of its own, with the weight of one shard.  All
regions there were keep their weights and inner draws, so rows move into the new
shard only.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from topicweave.llm.shared import rank_within, whole

#: Region, then rack, then shard number and weight.
Tree = dict[str, dict[str, dict[int, float]]]
BITS = 52


def tree_of(shards: int, region_racks: int = 2, rack_shards: int = 4, regions: int = 3) -> Tree:
    """``regions`` full regions of equal shards; each shard beyond them is a region of its own."""
    tree: Tree = {}
    full = region_racks * rack_shards
    for shard in range(shards):
        region, place = divmod(shard, full)
        if region >= regions:
            tree[f"single{shard}"] = {"rack0": {shard: 1.0}}
        else:
            tree.setdefault(f"region{region}", {}).setdefault(f"rack{place // rack_shards}", {})[shard] = 1.0
    return tree


def _nodes(tree: Tree) -> Column:
    """The tree as a literal: regions with their racks with their shards."""

    def node(name: str, weight: float, shard: int, below: list[Column] | None) -> Column:
        fields = [F.lit(name).alias("name"), F.lit(float(weight)).alias("weight"), F.lit(shard).alias("shard")]
        return F.struct(*fields, *([F.array(*below).alias("below")] if below else []))

    regions = []
    for r, racks in tree.items():
        below = []
        for k, leaves in racks.items():
            shards = [node(f"{r}/{k}/{s}", w, s, None) for s, w in leaves.items()]
            below.append(node(f"{r}/{k}", sum(leaves.values()), -1, shards))
        regions.append(node(r, sum(w for leaves in racks.values() for w in leaves.values()), -1, below))
    return F.array(*regions)


def _draw(key: Column, node: Column) -> Column:
    digest = F.md5(F.concat(key, F.lit("/"), node["name"]).cast("binary"))
    number = F.conv(F.substring(digest, 1, BITS // 4), 16, 10).cast("double")
    return -F.log((number + 0.5) / F.lit(float(2**BITS))) / node["weight"]


def shard_of(key: Column, tree: Tree) -> Column:
    """The shard that ``tree`` gives to ``key`` (text): three descents, each to the smallest draw."""

    def winner(children: Column) -> Column:
        drawn = F.transform(children, lambda c: F.struct(_draw(key, c).alias("draw"), c.alias("node")))
        return F.array_min(drawn)["node"]

    return winner(winner(winner(_nodes(tree))["below"])["below"])["shard"]


def shard_documents(docs: DataFrame, shards: int = 24) -> DataFrame:
    """Shard, slot and size of every document, and its shard if there were one more.

    The id and the number of shards decide (law ``key``).  A null id counts as
    an empty one, a null text as no bytes with the checksum of no bytes; rows
    that repeat an id share its shard and have slots of their own.  An empty
    table gives no rows.  Further columns of ``docs`` are not read.
    """
    text = whole().cast("binary")
    rows = docs.select(
        "doc_id",
        (F.octet_length(text) + 8).cast("long").alias("size"),
        F.crc32(text).cast("long").alias("text_crc32"),
        F.lit("key").alias("law"),
    )
    key = F.coalesce(F.col("doc_id").cast("string"), F.lit(""))
    placed = rows.withColumn("shard", shard_of(key, tree_of(shards)))
    placed = placed.withColumn("grown_shard", shard_of(key, tree_of(shards + 1)))
    ranked = rank_within(placed, ["shard"], ["doc_id", "text_crc32", "size"], "slot", docs.count())
    return ranked.select("doc_id", "size", "text_crc32", "law", "shard", "slot", "grown_shard")

"""The merge tree of a spanning forest, built, climbed and folded in rounds of joins.

Merging the parts of a forest along its edges, the least one first, gives a binary
tree of merges, however deep.  It is built by contraction.  An edge that is the least
one at neither of its ends joins two parts that have both merged before; there are
fewer than half of those.  All others are contracted, the tree of the rest is
built in the same way, and then every contracted edge finds its place: it follows the
last merge above its part that is less than the edge itself.  Edges with the same
place form a chain in their own order.  The last merge below a limit is found by
jumps of halving length.

No step looks at a whole tree, part or chain: the rounds are joins and sorts of
tables of one row an edge, and each is written.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from topicweave.operators.spanning import EDGE, find_roots, hooks
from topicweave.scratch import Scratch

#: Joins in one plan before its result is written.
JOINS = 6
#: Bits of the number of a row within its partition in a table written in order.
WITHIN = 33


def merge_tree(links: DataFrame, scratch: Scratch) -> tuple[DataFrame, DataFrame]:
    """Merges ``(run, id, e, up)`` of ``links(run, id, a, b, w, src, dst)``, and the first merge ``(run, v, id, e)`` of each part.

    Parts ``a, b`` and link ids are different numbers in all runs; the links are a
    forest and no two of a run are equal in ``(w, src, dst)``.  ``up`` is the next merge
    of what a merge makes, null for the last one.
    """
    levels = []
    edges = links.select("run", "id", "a", "b", F.struct(*EDGE).alias("e"))
    while True:
        ends = edges.select("run", F.col("a").alias("v"), F.col("b").alias("o"), "id", "e").union(
            edges.select("run", F.col("b").alias("v"), F.col("a").alias("o"), "id", "e")
        )
        least = ends.groupBy("run", "v").agg(F.min(F.struct("e", "id", "o")).alias("m"))
        first = scratch.table(least.select("run", "v", "m.id", "m.e", "m.o"), "first")
        roots = find_roots(hooks(first), scratch)
        told = first.select("run", "v", F.col("id").alias("first")).join(roots, ["run", "v"])
        end = lambda x: told.select(F.col("v").alias(x), F.col("first").alias(f"first_{x}"), F.col("p").alias(f"root_{x}"))
        inner = (F.col("id") != F.col("first_a")) & (F.col("id") != F.col("first_b"))
        dealt = edges.join(end("a"), "a").join(end("b"), "b").select(
            "run", "id", "e", F.col("root_a").alias("a"), F.col("root_b").alias("b"), inner.alias("inner")
        )
        dealt = scratch.table(dealt, "dealt", watch=F.col("inner"))
        scratch.drop(roots)
        levels.append((dealt.where("not inner").select("run", "id", "e", F.col("a").alias("part")), first))
        if not Scratch.watched(dealt):
            break
        edges = dealt.where("inner")
    merges = None
    for level in range(len(levels) - 1, -1, -1):
        chain = levels[level][0]
        if merges is None:
            merges = _in_chains(chain.withColumn("place", F.col("part")).withColumn("beyond", F.lit(None).cast("long")), None, scratch)
        else:
            above = levels[level + 1][1].select(F.col("v").alias("part"), F.col("id").alias("at"), F.col("e").alias("at_e"))
            asked = chain.join(above, "part", "left")
            low = F.col("at").isNull() | (F.col("e") < F.col("at_e"))
            before = asked.where(low).select("run", "id", "e", F.col("part").alias("place"), F.col("at").alias("beyond"))
            climbed = last_below(asked.where(~low).select("run", "id", "e", "at"), jumps(merges, scratch), scratch)
            beyond = merges.select(F.col("id").alias("at"), F.col("up").alias("beyond"))
            after = climbed.join(beyond, "at").select("run", "id", "e", F.col("at").alias("place"), "beyond")
            merges = _in_chains(before.unionByName(after), merges, scratch)
    return merges, levels[0][1].select("run", "v", "id", "e")


def _in_chains(chain: DataFrame, merges: DataFrame | None, scratch: Scratch) -> DataFrame:
    """Put the edges ``(run, id, e, place, beyond)`` between their place and what lies beyond it."""
    rows = chain.select("run", "id", "e", "place", "beyond")
    if merges is not None:
        rows = rows.unionByName(merges.select("run", "id", "e", F.col("id").alias("place"), F.col("up").alias("beyond")))
    placed, bounds = in_order(rows, ["place", "e"], scratch)
    ends = bounds.withColumn("next_start", F.lead("start").over(Window.orderBy("part"))).select("part", "last", "next_start")
    at = placed.join(F.broadcast(ends), F.shiftright("at", WITHIN) == F.col("part"))  # one row for each partition
    at = at.withColumn("next_at", F.when(F.col("at") == F.col("last"), F.col("next_start")).otherwise(F.col("at") + 1))
    follows = placed.select(F.col("at").alias("next_at"), F.col("place").alias("next_place"), F.col("id").alias("next_id"))
    up = F.when(F.col("next_place") == F.col("place"), F.col("next_id")).otherwise(F.col("beyond"))
    return scratch.table(at.join(follows, "next_at", "left").select("run", "id", "e", up.alias("up")), "merges", replaces=merges)


def in_order(rows: DataFrame, order: list, scratch: Scratch) -> tuple[DataFrame, DataFrame]:
    """The rows in a written table with ``at``, which grows in the order, and ``(part, start, last, rows)`` of its partitions.

    Within a partition ``at`` has no gap; its upper bits are the partition's number.
    """
    placed = scratch.table(rows.orderBy(*order).withColumn("at", F.monotonically_increasing_id()), "ordered")
    bounds = placed.groupBy(F.shiftright("at", WITHIN).alias("part")).agg(
        F.min("at").alias("start"), F.max("at").alias("last"), F.count(F.lit(1)).alias("rows")
    )
    return placed, bounds


def jumps(merges: DataFrame, scratch: Scratch) -> list[DataFrame]:
    """Tables ``(id, up, up_e)`` of the merge 1, 2, 4, ... steps above each, as long as there is one."""
    above = merges.select(F.col("id").alias("up"), F.col("e").alias("up_e"))
    step = scratch.table(merges.where("up IS NOT NULL").select("id", "up").join(above, "up").select("id", "up", "up_e"), "jump")
    out = []
    while Scratch.rows(step):
        out.append(step)
        further = step.select(F.col("id").alias("mid"), F.col("up").alias("far"), F.col("up_e").alias("far_e"))
        step = scratch.table(
            step.join(further, step.up == further.mid).select("id", F.col("far").alias("up"), F.col("far_e").alias("up_e")), "jump"
        )
    return out


def last_below(asked: DataFrame, steps: list[DataFrame], scratch: Scratch) -> DataFrame:
    """``asked(..., e, at)`` with ``at`` moved up to the last merge that is less than ``e``."""
    columns = asked.columns
    for k, step in enumerate(reversed(steps)):
        step = step.select(F.col("id").alias("at"), "up", "up_e")
        moved = F.when(F.col("up_e") < F.col("e"), F.col("up")).otherwise(F.col("at"))
        asked = asked.join(step, "at", "left").withColumn("at", moved).select(*columns)
        if k % JOINS == JOINS - 1:
            asked = scratch.table(asked, "climbed")
    return asked


def fold_up(nodes: DataFrame, scratch: Scratch) -> DataFrame:
    """``(node, value)``: the greater of ``low`` and ``add`` plus the values of the children.

    ``nodes(node, low, add, c1, c2)``; a null child is none, a null bound does not
    count.  In a round every node takes the values its children have, and one with a
    single open child that also has a single one skips it: both together are
    again the greater of a bound and a sum.  So chains halve while leaves go.
    """
    value = F.when(F.col("c1").isNull(), F.greatest("low", "add"))
    state = scratch.table(nodes.select("node", "low", "add", "c1", "c2", value.alias("value")), "fold", watch=F.col("value").isNull())
    while Scratch.watched(state):
        child = lambda c: state.select(
            F.col("node").alias(c), *[F.col(x).alias(f"{c}_{x}") for x in ("low", "add", "c1", "c2", "value")]
        )
        seen = state.join(child("c1"), "c1", "left").join(child("c2"), "c2", "left")
        seen = seen.withColumn("add", F.col("add") + F.coalesce("c1_value", F.lit(0.0)) + F.coalesce("c2_value", F.lit(0.0)))
        one, two = (F.when(F.col(f"{c}_value").isNull(), F.col(c)) for c in ("c1", "c2"))
        of = lambda x: F.when(one.isNotNull(), F.col(f"c1_{x}")).otherwise(F.col(f"c2_{x}"))
        seen = seen.select(
            "node", "low", "add", "value", F.coalesce(one, two).alias("open"), F.when(one.isNotNull(), two).alias("other"),
            of("low").alias("its_low"), of("add").alias("its_add"), of("c1").alias("its_c1"), of("c2").alias("its_c2"),
        )
        done, skips = F.col("open").isNull(), F.col("other").isNull() & F.col("its_c1").isNotNull() & F.col("its_c2").isNull()
        known = F.col("value").isNotNull()
        after = seen.select(
            "node",
            F.when(skips & ~known, F.greatest("low", F.col("its_low") + F.col("add"))).otherwise(F.col("low")).alias("low"),
            F.when(skips & ~known, F.col("add") + F.col("its_add")).otherwise(F.col("add")).alias("add"),
            F.when(~known, F.when(skips, F.col("its_c1")).otherwise(F.col("open"))).alias("c1"),
            F.when(~known, F.col("other")).alias("c2"),
            F.when(known, F.col("value")).when(done, F.greatest("low", "add")).alias("value"),
        )
        state = scratch.table(after, "fold", replaces=state, watch=F.col("value").isNull())
    return state.select("node", "value")


def topmost(nodes: DataFrame, chosen: Column, scratch: Scratch) -> DataFrame:
    """``(node, top)`` for ``nodes(node, up, ...)``: the highest chosen node on the way up, itself included; others are left out."""
    state = scratch.table(
        nodes.select("node", "up", F.when(chosen, F.col("node")).alias("top")), "top", watch=F.col("up").isNotNull()
    )
    while Scratch.watched(state):
        higher = state.select(F.col("node").alias("up"), F.col("up").alias("further"), F.col("top").alias("higher"))
        state = scratch.table(
            state.join(higher, "up", "left").select("node", F.col("further").alias("up"), F.coalesce("higher", "top").alias("top")),
            "top", replaces=state, watch=F.col("up").isNotNull(),
        )
    return state.where("top IS NOT NULL").select("node", "top")

"""Near-duplicate documents by order MinHash and alignment.

A document is its sequence of lower-case words.  Its k-mers are runs of five
words, each labelled with how many equal ones came before.  A sketch takes the
labelled k-mers with the smallest values of one hash function and keeps them in
the order of the text, so that documents share it the more likely the closer
their edit distance, not only their sets of k-mers.  Documents that share one of
their sketches are candidates.

Candidates are aligned k-mer by k-mer.  The similarity is the share of k-mers that
the alignment which matches most of them matches, among all k-mers of the two
documents; a block that is left out or put in costs its own k-mers only.

Equal word sequences are one node.  A group of near copies need not be paired up:
first every member of a bucket is aligned with the bucket's hub, the member that
meets most others in all of its buckets.  Then only members of one bucket that are
still in different components are compared with each other, in blocks, and those
whose signatures leave a similarity of the threshold possible are aligned.
"""

from __future__ import annotations

from bisect import bisect_left

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from topicweave.llm.exact import located, narrow, without
from topicweave.llm.shared import apply_batches, components, whole
from topicweave.scratch import Scratch

#: Letters of scripts that are written without spaces.
UNSPACED = r"[\p{IsHan}\p{IsHiragana}\p{IsKatakana}\p{IsThai}\p{IsLao}\p{IsKhmer}\p{IsMyanmar}&&\p{L}]"
#: Characters among which those letters are; one comparison tells them from all others.
FURTHER = r"[\x{E00}-\x{10FFFF}]"
#: Words of a k-mer, sketches of a document, and k-mers of a sketch.
WORDS, SKETCHES, MINIMA = 5, 32, 5
#: Documents of at most so many k-mers are also candidates by each single one.
SHORT = 20
#: Bins of a signature, each a byte, and how many standard errors below the threshold an estimate may lie.
BINS, ERRORS = 1024, 5.0
#: Members of a bucket compared in one block, and k-mers hashed at once.
BLOCK, STRIPE = 1024, 50_000
#: Pairs of equal k-mers for each k-mer up to which all of them are looked at.
PAIRS = 4
_MIX = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)


def words_of(text: Column | str) -> Column:
    """Runs of letters, their marks and digits in lower case; each character of a script without spaces is a word."""
    lower = F.lower(text)
    apart = F.when(lower.rlike(FURTHER), F.regexp_replace(lower, rf"({UNSPACED}\p{{M}}*+)", " $1 ")).otherwise(lower)
    return F.filter(F.split(apart, r"[^\p{L}\p{M}\p{N}]+"), lambda w: w != "")


def mixed(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser."""
    x = (x ^ (x >> np.uint64(30))) * _MIX[0]
    x = (x ^ (x >> np.uint64(27))) * _MIX[1]
    return x ^ (x >> np.uint64(31))


SEEDS = mixed(np.arange(1, SKETCHES + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))


def plain_kmers(words: np.ndarray) -> np.ndarray:
    """Hashes of the k-mers without labels, in the order of the text."""
    w = words.astype(np.int64).view(np.uint64)
    n = len(w) - WORDS + 1
    h = np.zeros(max(n, 0), dtype=np.uint64)
    for k in range(WORDS if n > 0 else 0):
        h = mixed(h + w[k : n + k])
    return h


def kmers(words: np.ndarray) -> np.ndarray:
    """Labelled k-mers of word hashes: equal k-mers differ by how many equal ones came before."""
    h = plain_kmers(words)
    if not len(h):
        return h
    order = np.argsort(h, kind="stable")
    first = np.flatnonzero(np.diff(h[order], prepend=~h[order][:1]))
    label = np.empty(len(h), dtype=np.uint64)
    label[order] = np.arange(len(h)) - np.repeat(first, np.diff(first, append=len(h)))
    return np.where(label > 0, mixed(h + label * _MIX[1]), h)


def signature(h: np.ndarray) -> np.ndarray:
    """One hash deals the k-mers into bins; each bin holds a byte of its smallest, or 0 if it is empty."""
    out = np.zeros(BINS, dtype=np.uint8)
    low = np.sort(mixed(h ^ _MIX[0]))
    bins = (low >> np.uint64(54)).astype(np.int64)
    first = np.flatnonzero(np.diff(bins, prepend=-1))
    out[bins[first]] = (low[first] % np.uint64(255)).astype(np.uint8) + 1
    return out


def possible(one: np.ndarray, n: int, others: np.ndarray, ns: np.ndarray, threshold: float) -> np.ndarray:
    """Which of the ``others`` may share enough k-mers with ``one``; ``n`` and ``ns`` are their numbers of k-mers.

    The bins that are not empty in both signatures are a sample, without
    replacement, of the k-mers of the two documents.
    """
    drawn = np.maximum(((others != 0) | (one != 0)).sum(axis=1), 1)
    equal = ((others == one) & (one != 0)).sum(axis=1) / drawn
    all_ = (n + ns) / (1 + threshold)
    error = np.sqrt(threshold * (1 - threshold) / drawn * np.maximum(1 - drawn / all_, 0))
    near = np.minimum(n, ns) >= threshold * np.maximum(n, ns) - 1e-9
    return near & (equal >= threshold - ERRORS * error - 0.01)


def sketches(h: np.ndarray) -> np.ndarray:
    """Bucket keys."""
    if not len(h):
        return np.zeros(0, dtype=np.int64)
    take = min(MINIMA, len(h))
    at = np.zeros((SKETCHES, 0), dtype=np.int64)
    value = np.zeros((SKETCHES, 0), dtype=np.uint64)
    for i in range(0, len(h), STRIPE):
        part = h[i : i + STRIPE]
        hashed = mixed(part[None, :] ^ SEEDS[:, None])
        if len(part) > take:
            low = np.argpartition(hashed, take - 1, axis=1)[:, :take]
        else:
            low = np.broadcast_to(np.arange(len(part)), hashed.shape)
        at = np.hstack([at, low + i])
        value = np.hstack([value, np.take_along_axis(hashed, low, axis=1)])
        if at.shape[1] > take:
            low = np.argpartition(value, take - 1, axis=1)[:, :take]
            at, value = np.take_along_axis(at, low, axis=1), np.take_along_axis(value, low, axis=1)
    at = np.sort(at, axis=1)
    key = SEEDS.copy()
    for k in range(take):
        key = mixed(key + h[at[:, k]])
    if len(h) <= SHORT:
        key = np.concatenate([key, mixed(h)])
    return key.view(np.int64)


def matched_runs(a: np.ndarray, b: np.ndarray, limit: int) -> list[int] | None:
    """Lengths of the matched runs of an alignment with the fewest insertions and deletions, none if it takes over ``limit``.

    The furthest cell reached on each diagonal of a band that grows by one
    diagonal on each side with every edit.  There are no substitutions, so no other
    alignment matches more.
    """
    na, nb = len(a), len(b)
    if abs(na - nb) > limit:
        return None
    a, b = a.tolist(), b.tolist()
    level: dict[int, tuple[int, tuple]] = {}  # by diagonal: end, and the runs before as a chain
    for edits in range(limit + 1):
        before, level = level, {}
        for k in range(-edits, edits + 1, 2):
            if k < -na or k > nb:
                continue
            choices = [] if edits else [(0, ())]
            if k - 1 in before and before[k - 1][0] + k <= nb:
                choices.append(before[k - 1])
            if k + 1 in before and before[k + 1][0] < na:
                choices.append((before[k + 1][0] + 1, before[k + 1][1]))
            if not choices:
                continue
            start, chain = max(choices, key=lambda c: c[0])
            end, stop = start, min(na, nb - k)
            while end < stop and a[end] == b[end + k]:
                end += 1
            level[k] = (end, (end - start, chain) if end > start else chain)
        if nb - na in level and level[nb - na][0] == na:
            runs, chain = [], level[nb - na][1]
            while chain:
                run, chain = chain
                runs.append(run)
            return runs[::-1]
    return None


def in_order(a: np.ndarray, b: np.ndarray, limit: int) -> int | None:
    """How many k-mers ``a`` and ``b`` share in the same order, at most; none if that leaves over ``limit`` of both.

    Few k-mers of a text are equal, so the longest rising sequence of their places
    is found from all equal pairs.  Where there are many pairs, edits are
    counted instead.
    """
    left = len(a) + len(b)
    short = min(len(a), len(b))
    differ = np.flatnonzero(a[:short] != b[:short])
    head = int(differ[0]) if len(differ) else short
    a, b, short = a[head:], b[head:], short - head
    differ = np.flatnonzero(a[len(a) - short :] != b[len(b) - short :])
    tail = short - 1 - int(differ[-1]) if len(differ) else short
    a, b = a[: len(a) - tail], b[: len(b) - tail]
    order = np.argsort(b, kind="stable")
    first, last = (np.searchsorted(b[order], a, side) for side in ("left", "right"))
    times = last - first
    pairs = int(times.sum())
    if pairs <= PAIRS * left:
        # the places of one k-mer fall, so that at most one of them is taken
        places = order[np.repeat(last - 1, times) - (np.arange(pairs) - np.repeat(np.cumsum(times) - times, times))]
        ends: list[int] = []
        for place in places.tolist():
            at = bisect_left(ends, place)
            ends[at : at + 1] = [place]
        shared = head + tail + len(ends)
        return shared if left - 2 * shared <= limit else None
    runs = matched_runs(a, b, limit)
    return None if runs is None else head + tail + sum(runs)


def similarity(a: np.ndarray, b: np.ndarray, threshold: float) -> float:
    """Most k-mers shared in the same order, over all k-mers of both; 0 where it must be below the threshold."""
    na, nb = len(a) - WORDS + 1, len(b) - WORDS + 1
    if na < 1 or nb < 1:
        return 0.0
    least = threshold / (1 + threshold) * (na + nb) - 1e-9  # k-mers that must be shared
    if min(na, nb) < least or len(np.intersect1d(kmers(a), kmers(b), assume_unique=True)) < least:
        return 0.0
    shared = in_order(plain_kmers(a), plain_kmers(b), int(na + nb - 2 * least))
    return shared / (na + nb - shared) if shared is not None else 0.0


def near_duplicates(docs: DataFrame, threshold: float = 0.8, place: str | None = None) -> DataFrame:
    """``doc_id, class_id, class_size, kept`` and ``_locator`` for every row.

    A class is all documents linked by a similarity of ``threshold`` or more,
    over any number of steps; its id is its smallest document id, and the first
    row of that id stays.  Texts of equal words are alike, as are equal texts
    without any word; a text of fewer than five words is like no other.  A null
    text is empty.  Null ids come last; a class without any id has a null one.
    An empty table gives no rows.  Two blocks that change places leave fewer k-mers
    in the same order and may thus end a likeness.  ``place`` names the column of
    locators, as in :func:`topicweave.llm.exact.deduplicate`.
    """
    scratch = Scratch(docs.sparkSession, "near")
    rows = narrow(scratch, docs, place).withColumn("text", whole())
    words = words_of(F.col("text"))
    digest = F.md5(F.when(F.size("words") > 0, F.array_join("words", " ")).otherwise(F.concat(F.lit("\n"), "text")).cast("binary"))
    split = rows.withColumn("words", words).select("doc_id", "_locator", digest.alias("digest"), F.transform("words", lambda w: F.xxhash64(w)).alias("words"))

    def sketch(batch: pa.RecordBatch) -> pa.RecordBatch:
        keys, numbers, signatures = [], [], []
        for one in batch["words"]:
            own = kmers(one.values.to_numpy())
            keys.append(sketches(own))
            numbers.append(len(own))
            signatures.append(signature(own).tobytes())
        made = [pa.array(keys, pa.list_(pa.int64())), pa.array(numbers, pa.int64()), pa.array(signatures, pa.binary())]
        return pa.RecordBatch.from_arrays(
            [batch["doc_id"], batch["_locator"], batch["digest"], *made],
            names=["doc_id", "_locator", "digest", "keys", "kmers", "signature"],
        )

    kind = rows.schema["doc_id"].dataType.simpleString()
    place = rows.schema["_locator"].dataType.simpleString()
    sketched = scratch.table(
        apply_batches(split, sketch, f"doc_id {kind}, _locator {place}, digest string, keys array<long>, kmers long, signature binary"), "sketched"
    )
    distinct = sketched.groupBy("digest").agg(*[F.first(c).alias(c) for c in ("keys", "kmers", "signature")])
    nodes = scratch.table(distinct.withColumn("node", F.monotonically_increasing_id()), "nodes")
    sketched = scratch.table(sketched.select("doc_id", "_locator", "digest"), "placed", replaces=sketched)

    # members of buckets with company
    listed = nodes.select("node", F.explode("keys").alias("bucket"))
    shared = listed.groupBy("bucket").agg(F.count(F.lit(1)).alias("size")).where("size > 1")
    members = scratch.table(listed.join(shared, "bucket"), "members")
    met = members.groupBy("node").agg(F.sum("size").alias("met"))
    ranked = members.join(met, "node").select("bucket", "node", F.struct("met", "node").alias("rank"))
    hubs = ranked.groupBy("bucket").agg(F.max("rank")["node"].alias("hub"))
    stars = members.join(hubs, "bucket").where("node != hub").select(F.col("node").alias("src"), F.col("hub").alias("dst")).distinct()
    stars = scratch.table(stars, "stars")

    # the words of the documents that have candidates
    wanted = nodes.join(met.select("node"), "node", "left_semi").select("digest", "node")
    content = split.select("digest", "words").join(wanted, "digest").groupBy("node").agg(F.first("words").alias("words"))
    content = scratch.table(content, "content")

    links = scratch.table(_aligned(stars, content, threshold), "links")
    first = components(scratch, links)
    within = members.join(first, "node", "left").select("bucket", "node", "size", F.coalesce("component", "node").alias("component"))
    within = scratch.table(within, "within", replaces=members)
    split_up = within.groupBy("bucket").agg((F.min("component") != F.max("component")).alias("apart")).where("apart").select("bucket")
    apart = within.join(split_up, "bucket").join(nodes.select("node", "kmers", "signature"), "node")
    more = scratch.table(_crossing(apart, threshold), "crossing")
    more = more.join(stars, ["src", "dst"], "left_anti").join(stars.select(F.col("dst").alias("src"), F.col("src").alias("dst")), ["src", "dst"], "left_anti")
    links = links.union(scratch.table(_aligned(more, content, threshold), "links"))
    classes = components(scratch, links)

    by_digest = nodes.join(classes, "node", "left").select("digest", F.coalesce("component", "node").alias("class"))
    told = scratch.table(sketched.join(by_digest, "digest").select("doc_id", "_locator", "class"), "told")
    scratch.keep(told)
    order = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "_locator")
    of_class = told.groupBy("class").agg(F.min(order).alias("least"), F.count(F.lit(1)).alias("class_size"))
    return told.join(of_class, "class").select(
        "doc_id",
        F.col("least.doc_id").alias("class_id"),
        "class_size",
        (F.col("_locator") == F.col("least._locator")).alias("kept"),
        "_locator",
    )


def keep_one(docs: DataFrame) -> DataFrame:
    """The rows, unchanged, that :func:`near_duplicates` keeps."""
    rows, place = located(Scratch(docs.sparkSession, "near"), docs)
    return without(rows, place, near_duplicates(rows, place=place).where("not kept"))


def _aligned(pairs: DataFrame, content: DataFrame, threshold: float) -> DataFrame:
    """The pairs whose alignment has the similarity."""
    a = content.select(F.col("node").alias("src"), F.col("words").alias("a"))
    b = content.select(F.col("node").alias("dst"), F.col("words").alias("b"))

    def align(batch: pa.RecordBatch) -> pa.RecordBatch:
        good = [
            similarity(x.values.to_numpy(), y.values.to_numpy(), threshold) >= threshold
            for x, y in zip(batch["a"], batch["b"], strict=True)
        ]
        return batch.select(["src", "dst"]).filter(pa.array(good, pa.bool_()))

    return apply_batches(pairs.join(a, "src").join(b, "dst").select("src", "dst", "a", "b"), align, "src long, dst long")


def _crossing(apart: DataFrame, threshold: float) -> DataFrame:
    """Pairs of members of one bucket, in different components, whose signatures leave the threshold possible.

    A bucket is dealt into blocks and each pair of blocks is a group of its own,
    so no task holds a whole bucket, and only promising pairs come out.
    """
    blocks = F.ceil(F.col("size") / BLOCK)
    dealt = apart.withColumn("own", F.pmod(F.xxhash64("node"), blocks)).withColumn("other", F.explode(F.sequence(F.lit(0), blocks - 1)))
    dealt = dealt.select(
        "bucket", F.least("own", "other").alias("low"), F.greatest("own", "other").alias("high"), "own", "node", "component", "kmers", "signature"
    )

    def compare(table: pa.Table) -> pa.Table:
        node, component, own, numbers = (table[c].to_numpy() for c in ("node", "component", "own", "kmers"))
        low, high = table["low"][0].as_py(), table["high"][0].as_py()
        sign = np.frombuffer(b"".join(table["signature"].to_pylist()), dtype=np.uint8).reshape(len(node), -1)
        left, right = np.flatnonzero(own == low), np.flatnonzero(own == high)
        src, dst = [], []
        for i in left:
            rest = right[node[right] > node[i]] if low == high else right
            rest = rest[component[rest] != component[i]]
            rest = rest[possible(sign[i], numbers[i], sign[rest], numbers[rest], threshold)]
            src.append(np.minimum(node[i], node[rest]))
            dst.append(np.maximum(node[i], node[rest]))
        ends = [np.concatenate(x) if x else np.zeros(0, dtype=np.int64) for x in (src, dst)]
        return pa.table({"src": pa.array(ends[0], pa.int64()), "dst": pa.array(ends[1], pa.int64())})

    return dealt.groupBy("bucket", "low", "high").applyInArrow(compare, "src long, dst long").distinct()

"""Exact integer k-means over vectors held as codes into dictionaries of subvectors.

Vectors are cut into segments of bounded size.  In a segment every block of
dimensions is encoded without loss: a dictionary of the distinct subvectors that occur
and, for each vector, its code.  Neighbouring blocks are joined while that makes less
work, so copies end as one wide entry and unlike vectors as single dimensions.

A round computes the distance of every dictionary entry to every centroid's part
once.  A vector's distance is the sum of its codes' entries, and a cluster's sum is the
entries weighed by how often their code falls into it.  All numbers are integers, so
neither the order of rows nor the segments change a result.  The encoded segments
are a written table that every round reads; a round shuffles one partial sum per
task, cluster and dimension, and the driver holds the centroids alone.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from topicweave.scratch import Scratch

#: Vectors of a segment; codes are 16-bit numbers.
SEGMENT = 1 << 14
#: Components up to this size have squared distances that fit a long integer.
NARROW = 1 << 27
#: Bits of a part of a sum on its way to the driver.
LIMB = 40
LONG = 1 << 63
ENCODED = "ids array<long>, wide boolean, widths array<int>, sizes array<int>, codes binary, entries binary"


def usable(vector: Column, dims: int) -> Column:
    """A vector of ``dims`` components, none of them null or not finite."""
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))
    return F.coalesce((F.size(vector) == dims) & finite, F.lit(False))


def whole_number(x: float, scale: int) -> int:
    """floor(scale * x), exact for every finite number."""
    return math.floor(x * scale) if abs(x) < 1 << 40 else int(x) * scale


class Segment:
    """Vectors as codes: for each block its width, its entries and every vector's code."""

    def __init__(self, wide: bool, blocks: list[tuple[np.ndarray, np.ndarray]]):
        """blocks: entries (distinct, width), and codes."""
        self.wide, self.blocks = wide, blocks

    @classmethod
    def encode(cls, rows: np.ndarray) -> Segment:
        """Encode a matrix of whole numbers, joining neighbouring blocks while that makes less work."""
        n = len(rows)
        level = []
        for d in range(rows.shape[1]):
            values, codes = np.unique(rows[:, d], return_inverse=True)
            level.append((values[:, None], codes.reshape(-1)))
        work = lambda block: n + block[0].size
        done = True
        while done and len(level) > 1:
            done, after = False, []
            for i in range(0, len(level) - 1, 2):
                (left, a), (right, b) = level[i], level[i + 1]
                pair, codes = np.unique(a.astype(np.int64) * len(right) + b, return_inverse=True)
                both = np.concatenate([left[pair // len(right)], right[pair % len(right)]], axis=1)
                joined = (both, codes.reshape(-1))
                if work(joined) < work(level[i]) + work(level[i + 1]):
                    after.append(joined)
                    done = True
                else:
                    after += [level[i], level[i + 1]]
            level = after + level[len(level) // 2 * 2 :]
        return cls(rows.dtype == object, level)

    def packed(self, ids: pa.Array) -> pa.RecordBatch:
        entries = [e for e, _ in self.blocks]
        if self.wide:
            kept = ",".join(str(x) for e in entries for x in e.ravel()).encode()
        else:
            kept = b"".join(e.astype("<i8").tobytes() for e in entries)
        columns = [
            pa.ListArray.from_arrays(pa.array([0, len(ids)], pa.int32()), ids),
            pa.array([self.wide]),
            pa.array([[e.shape[1] for e in entries]], pa.list_(pa.int32())),
            pa.array([[len(e) for e in entries]], pa.list_(pa.int32())),
            pa.array([b"".join(c.astype("<u2").tobytes() for _, c in self.blocks)], pa.binary()),
            pa.array([kept], pa.binary()),
        ]
        return pa.RecordBatch.from_arrays(columns, names=["ids", "wide", "widths", "sizes", "codes", "entries"])

    @classmethod
    def unpacked(cls, row: dict) -> Segment:
        codes = np.frombuffer(row["codes"], dtype="<u2").reshape(len(row["widths"]), -1)
        if row["wide"]:
            flat = np.array([int(x) for x in row["entries"].decode().split(",")], dtype=object)
        else:
            flat = np.frombuffer(row["entries"], dtype="<i8")
        blocks, at = [], 0
        for own, width, size in zip(codes, row["widths"], row["sizes"], strict=True):
            blocks.append((flat[at : at + width * size].reshape(size, width), own))
            at += width * size
        return cls(row["wide"], blocks)

    def distances(self, centroids: np.ndarray) -> np.ndarray:
        """Squared distance of every vector to every centroid, from one table of entries a block."""
        exact = object if self.wide or centroids.dtype == object else np.int64
        total = np.zeros((len(self.blocks[0][1]), len(centroids)), dtype=exact)
        at = 0
        for entries, codes in self.blocks:
            part = centroids[:, at : at + entries.shape[1]].astype(exact)
            table = np.zeros((len(entries), len(centroids)), dtype=exact)
            for d in range(entries.shape[1]):
                away = entries[:, d, None].astype(exact) - part[None, :, d]
                table += away * away
            total += table[codes]
            at += entries.shape[1]
        return total

    def sums(self, cluster: np.ndarray, clusters: int) -> np.ndarray:
        """Sum of the vectors of each cluster, from how often each code falls into it."""
        out = []
        for entries, codes in self.blocks:
            n = np.bincount(cluster * len(entries) + codes, minlength=clusters * len(entries)).reshape(clusters, -1)
            out.append(n.astype(entries.dtype) @ entries)
        return np.concatenate(out, axis=1)


def encode(vectors: DataFrame, dims: int, scale: int, segment: int) -> DataFrame:
    """``ENCODED`` rows of the usable vectors of ``(vec_id, v)``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[bool, tuple[list, list]] = {False: ([], []), True: ([], [])}

        def flush(wide: bool) -> pa.RecordBatch:
            ids, rows = held[wide]
            held[wide] = ([], [])
            return Segment.encode(np.concatenate(rows)).packed(pa.concat_arrays(ids))

        for batch in batches:
            for start in range(0, batch.num_rows, segment):
                part = batch.slice(start, segment)
                x = part["v"].flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, dims)
                big = (np.abs(x) >= NARROW // scale).any(axis=1)
                for wide in (False, True):
                    own = np.flatnonzero(big == wide)
                    if not len(own):
                        continue
                    if wide:
                        rows = np.array([[whole_number(float(y), scale) for y in x[i]] for i in own], dtype=object)
                    else:
                        rows = np.floor(x[own] * scale).astype(np.int64)
                    if sum(map(len, held[wide][1])) + len(own) > segment:
                        yield flush(wide)
                    held[wide][0].append(part["vec_id"].cast(pa.int64()).take(pa.array(own)))
                    held[wide][1].append(rows)
        for wide in (False, True):
            if held[wide][1]:
                yield flush(wide)

    return vectors.mapInArrow(run, ENCODED)


def _segments(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.Array, Segment]]:
    for batch in batches:
        for i in range(batch.num_rows):
            row = batch.slice(i, 1)
            yield row["ids"].flatten(), Segment.unpacked(row.drop_columns(["ids"]).to_pylist()[0])


def as_matrix(rows: list[list[int]]) -> np.ndarray:
    """Whole numbers; Python's own where one is too large for squares of long integers."""
    fits = all(abs(x) <= NARROW for row in rows for x in row)
    return np.array(rows, dtype=np.int64 if fits else object)


def one_round(encoded: DataFrame, centroids: np.ndarray) -> list[list[int]]:
    """The centroids after one round; an empty cluster keeps its own."""
    k, dims = centroids.shape

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, rows = np.zeros((k, dims), dtype=object), np.zeros(k, dtype=np.int64)
        for _, segment in _segments(batches):
            cluster = segment.distances(centroids).argmin(axis=1).astype(np.int64)
            total += segment.sums(cluster, k)
            rows += np.bincount(cluster, minlength=k)
        parts = [(c, -1, 0, int(rows[c])) for c in range(k) if rows[c]]
        for c in np.flatnonzero(rows):
            for d in range(dims):
                left, sign, limb = abs(int(total[c, d])), -1 if total[c, d] < 0 else 1, 0
                while left:
                    parts.append((int(c), d, limb, sign * (left & ((1 << LIMB) - 1))))
                    left, limb = left >> LIMB, limb + 1
        if parts:
            yield pa.RecordBatch.from_pylist(
                [dict(zip(("cluster", "dim", "limb", "part"), p)) for p in parts],
                pa.schema([("cluster", pa.int32()), ("dim", pa.int32()), ("limb", pa.int32()), ("part", pa.int64())]),
            )

    parts = encoded.mapInArrow(run, "cluster int, dim int, limb int, part long")
    sums = parts.groupBy("cluster", "dim", "limb").agg(F.sum(F.col("part").cast("decimal(20,0)")).alias("part"))
    total = np.zeros((k, dims), dtype=object)
    rows = {}
    for cluster, dim, limb, part in sums.collect():  # clusters, dimensions and the few parts of a number
        if dim < 0:
            rows[cluster] = int(part)
        else:
            total[cluster, dim] += int(part) << (LIMB * limb)
    return [[int(t) // rows[c] for t in total[c]] if c in rows else [int(x) for x in centroids[c]] for c in range(k)]


def assigned(encoded: DataFrame, centroids: np.ndarray) -> DataFrame:
    """``vec_id, cluster, distance``; a distance beyond a long integer is null."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for ids, segment in _segments(batches):
            away = segment.distances(centroids)
            cluster = away.argmin(axis=1)
            best = away[np.arange(len(away)), cluster]
            if best.dtype == object:
                best = [int(x) if x < LONG else None for x in best]
            yield pa.RecordBatch.from_arrays(
                [ids, pa.array(cluster.astype(np.int32)), pa.array(best, pa.int64())], names=["vec_id", "cluster", "distance"]
            )

    return encoded.mapInArrow(run, "vec_id long, cluster int, distance long")


def cluster(
    vectors: DataFrame, k: int = 8, rounds: int = 10, dims: int = 64, scale: int = 1024, salt: str = "3", segment: int = SEGMENT
) -> DataFrame:
    """``vec_id, cluster, distance, cluster_inertia, inertia, centroid_sha256`` for every usable vector.

    A component x counts as floor(scale * x).  The first centroids are the ``k``
    usable vectors with the smallest sha256 of ``salt:vec_id``; a null id counts as
    empty text, and rows that repeat an id are ordered by their components.  With
    fewer usable vectors there are fewer centroids.  Null vectors, those of another
    length and those with a null or not finite component are left out; an empty table
    gives no rows.  Repeated rows are vectors of their own, and equally near
    centroids go to the smaller number.  Numbers of any size are exact; only a
    distance, or a sum of distances, that does not fit a long integer is null.
    """
    if segment > 1 << 16:
        raise ValueError("codes have 16 bits")
    scratch = Scratch(vectors.sparkSession, "centroids")
    kept = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast("array<double>").alias("v"))
    kept = kept.where(usable(F.col("v"), dims))
    encoded = scratch.table(encode(kept, dims, scale, segment), "encoded")
    place = F.sha2(F.concat(F.lit(f"{salt}:"), F.coalesce(F.col("vec_id").cast("string"), F.lit(""))).cast("binary"), 256)
    first = kept.orderBy(place, "v").limit(k).collect()
    centroids = [[whole_number(x, scale) for x in row.v] for row in first]
    if not centroids:
        return kept.select("vec_id").limit(0).selectExpr(
            "vec_id", "0 AS cluster", "0L AS distance", "0L AS cluster_inertia", "0L AS inertia", "'' AS centroid_sha256"
        )
    for _ in range(rounds):
        centroids = one_round(encoded, as_matrix(centroids))
    rows = scratch.table(assigned(encoded, as_matrix(centroids)), "assigned")
    scratch.drop(encoded)
    exact = F.sum(F.col("distance").cast("decimal(38,0)"))
    own = rows.groupBy("cluster").agg(F.when(F.count("distance") == F.count(F.lit(1)), exact).alias("sum"))
    every = own.agg(F.when(F.count("sum") == F.count(F.lit(1)), F.sum("sum")).alias("all"))
    digest = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centroids]
    named = F.element_at(F.array(*[F.lit(d) for d in digest]), F.col("cluster") + 1)
    totals = own.crossJoin(every).select(  # one row for each centroid, and one row
        "cluster", F.col("sum").try_cast("long").alias("cluster_inertia"), F.col("all").try_cast("long").alias("inertia")
    )
    return rows.join(F.broadcast(totals), "cluster").select(
        "vec_id", "cluster", "distance", "cluster_inertia", "inertia", named.alias("centroid_sha256")
    )

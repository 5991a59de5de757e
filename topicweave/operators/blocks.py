"""Block joins: NumPy work on pairs of bounded blocks, shuffled by Spark.

Queries and candidates meet in cells.  A cell of any size is cut into blocks of
candidates and chunks of queries, and one task sees one block and one chunk, so
a cell that holds a third of all rows is many tasks, not one.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

BLOCK_ROWS = 4096
# rows of a distance matrix held at once inside a task
STRIPE_ROWS = 512
# pairs whose difference vectors are held at once inside a task
PAIRS_AT_ONCE = 32_768
# entries of a matrix of rows by cells held at once inside a task
ENTRIES_AT_ONCE = 1 << 20
# squared distances below this share of the two squared lengths are taken from the differences
CANCELLED = 1e-4
# coordinates from here on, and those that are no numbers, are never multiplied
LARGEST = 1e150


def matrix(table: pa.Table, name: str) -> np.ndarray:
    """A list column as a 2-D array."""
    column = table.column(name).combine_chunks()
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64, copy=False)
    return flat.reshape(len(column), -1)


def values(table: pa.Table, name: str) -> np.ndarray:
    return table.column(name).to_numpy()


def list_column(rows: np.ndarray) -> pa.Array:
    """A 2-D array as a list column."""
    rows = np.ascontiguousarray(rows, dtype=np.float64)
    offsets = np.arange(0, rows.size + 1, max(rows.shape[1], 1), dtype=np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(rows.ravel()))


def slices(batch: pa.RecordBatch, width: int, entries: int = ENTRIES_AT_ONCE) -> Iterator[pa.Table]:
    """Stretches of a batch, each with at most ``entries`` of a matrix of its rows by ``width``."""
    step = max(1, entries // max(width, 1))
    for start in range(0, batch.num_rows, step):
        yield pa.Table.from_batches([batch.slice(start, step)])


def squared_distances(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Fast squared Euclidean distances, good to about ``slack(a, b)``."""
    return (a * a).sum(1)[:, None] + (b * b).sum(1)[None, :] - 2.0 * (a @ b.T)


def slack(a: np.ndarray, b: np.ndarray) -> float:
    """More than the rounding error of ``squared_distances``."""
    return 1e-11 * (1.0 + (a * a).sum(1).max(initial=0.0) + (b * b).sum(1).max(initial=0.0))


def exact_squared(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Row-wise squared distances; the same pair gives the same bits in any block."""
    diff = a - b
    return (diff * diff).sum(axis=1)


def exact_pairs(a: np.ndarray, b: np.ndarray, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """``exact_squared`` of the rows ``i`` of ``a`` and ``j`` of ``b``, some pairs at a time."""
    out = np.empty(len(i))
    for start in range(0, len(i), PAIRS_AT_ONCE):
        some = slice(start, start + PAIRS_AT_ONCE)
        out[some] = exact_squared(a[i[some]], b[j[some]])
    return out


def distinct_rows(x: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The distinct rows, which of them each row is, and how often each occurs."""
    x = np.ascontiguousarray(x)
    whole = x.view(np.dtype((np.void, x.dtype.itemsize * x.shape[1]))).ravel()
    _, first, which, counts = np.unique(whole, return_index=True, return_inverse=True, return_counts=True)
    return x[first], which.ravel(), counts.astype(np.float64)


def stripes(left: np.ndarray, right: np.ndarray) -> Iterator[tuple[slice, np.ndarray, Callable]]:
    """Stretches of the rows of ``left`` with their product with ``right``, and its places at or below a limit a row.

    Fresh memory for every product costs more than the product, so all use the same.
    """
    shape = (min(STRIPE_ROWS, len(left)), right.shape[1])
    held, marked = np.empty(shape, dtype=left.dtype), np.empty(shape, dtype=bool)
    for start in range(0, len(left), STRIPE_ROWS):
        rows = slice(start, min(start + STRIPE_ROWS, len(left)))
        product = np.matmul(left[rows], right, out=held[: rows.stop - start])

        def below(limit: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
            under = np.less_equal(product, limit[:, None], out=marked[: len(product)])
            return np.divmod(np.flatnonzero(under), shape[1])

        yield rows, product, below


def distance_stripes(q: np.ndarray, c: np.ndarray) -> Iterator[tuple[slice, np.ndarray]]:
    """Stretches of the rows of ``q`` with their distances to the rows of ``c``.

    Distances come from matrix products about the mean of ``c``; where two rows are so near
    that the product cancels, from their difference.  All stretches use the same memory: one
    holds until the next is asked for.
    """
    middle = c.mean(axis=0)
    a, b = q - middle, c - middle
    aa, bb = (a * a).sum(axis=1), (b * b).sum(axis=1)
    ones = lambda x: np.ones((len(x), 1))
    left, right = np.hstack([-2.0 * a, aa[:, None], ones(a)]), np.hstack([b, ones(b), bb[:, None]]).T.copy()
    for rows, square, below in stripes(left, right):
        i, j = below(CANCELLED * (aa[rows] + bb.max()))
        if len(i):
            square[i, j] = exact_pairs(q[rows], c, i, j)
        yield rows, np.sqrt(square, out=square)


def far_from_range(*x: np.ndarray) -> bool:
    """Whether a coordinate is too large for products, or no number."""
    return not max(np.abs(one).max(initial=0.0) for one in x) < LARGEST


def distance_sums(q: np.ndarray, c: np.ndarray) -> np.ndarray:
    """Per row of ``q`` the sum of its distances to the rows of ``c``, good to about 1e-11 of itself.

    Equal rows are one row with a count.
    """
    q, which, _ = distinct_rows(q)
    c, _, counts = distinct_rows(c)
    if far_from_range(q, c):
        return np.array([np.sqrt(exact_squared(row, c)) @ counts for row in q])[which]
    total = np.empty(len(q))
    for rows, far in distance_stripes(q, c):
        total[rows] = far @ counts
    return total[which]


def block_join(
    queries: DataFrame,
    candidates: DataFrame,
    kernel: Callable[[pa.Table, pa.Table], pa.Table],
    schema: str,
    cell: Sequence[str] = ("cell",),
    query_id: str = "q_id",
    candidate_id: str = "c_id",
    block_rows: int = BLOCK_ROWS,
    few_cells: bool = True,
) -> DataFrame:
    """Run ``kernel(chunk, block)`` for every query chunk and candidate block of a cell.

    ``few_cells`` says that the number of cells is bounded, so the table of
    their sizes may be broadcast.
    """
    cell = list(cell)

    def pieces(rows: DataFrame, name: str) -> DataFrame:
        n = F.count(F.lit(1)).cast("double") / block_rows
        return rows.groupBy(*cell).agg(F.ceil(n).cast("int").alias(name))

    sizes = pieces(queries, "_nq").join(pieces(candidates, "_nc"), cell)
    if few_cells:
        sizes = F.broadcast(sizes)

    def part(row_id: str, n: str):
        return F.pmod(F.xxhash64(row_id), F.col(n)).cast("int")

    def numbers(n: str):
        return F.explode(F.sequence(F.lit(0), F.col(n) - 1))

    keys = [*cell, "_chunk", "_block"]
    left = (
        queries.join(sizes, cell)
        .withColumn("_chunk", part(query_id, "_nq"))
        .withColumn("_block", numbers("_nc"))
        .drop("_nq", "_nc")
    )
    right = (
        candidates.join(sizes, cell)
        .withColumn("_block", part(candidate_id, "_nc"))
        .withColumn("_chunk", numbers("_nq"))
        .drop("_nq", "_nc")
    )
    return left.groupBy(*keys).cogroup(right.groupBy(*keys)).applyInArrow(kernel, schema)

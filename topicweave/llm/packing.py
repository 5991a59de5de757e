"""Packing token sequences: exact fillings by non-negative least squares, the rest greedily.

A document's ids are cut into windows; what remains of it is one piece shorter
than a window.  Only the histogram of piece lengths reaches the driver, with at
most one number for each length up to the window.  Shallow combinations of two
to four lengths that fill a window exactly are the columns of a matrix; least
squares without negative repeats fits them to the histogram.  Rounded repeats
are taken as far as pieces of their lengths are left, largest first, and the
remaining lengths are packed best fit, longest first, a whole class of equal
lengths at a time.

The plan says for each length which of its pieces, numbered from 0, go where.  It
does not grow with the number of documents.
"""

from __future__ import annotations

import json
import re
import zlib
from array import array
from collections import Counter, defaultdict
from functools import lru_cache
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from topicweave.llm.bpe import read_ranks
from topicweave.llm.shared import apply_batches, rank_within, tokenizer_file, whole
from topicweave.llm.words import Remembered, parts_of
from topicweave.scratch import Scratch

WINDOW = 2048
END = 1
SWEEPS = 40


@lru_cache(maxsize=2)
def _added(path: str) -> tuple[re.Pattern | None, dict[str, bytes]]:
    """A pattern that splits a text at the added tokens of the vocabulary's file for ``tokenizers``, and their ids."""
    tokens = json.loads(Path(path).with_suffix(".json").read_text(encoding="utf-8"))["added_tokens"]
    if any(t["lstrip"] or t["rstrip"] or t["single_word"] for t in tokens):
        raise ValueError("added tokens that take spaces or whole words only are not supported")
    ids = {t["content"]: t["id"].to_bytes(4, "little") for t in tokens}
    longest_first = sorted(ids, key=len, reverse=True)
    return re.compile(f"({'|'.join(map(re.escape, longest_first))})") if ids else None, ids


@lru_cache(maxsize=2)
def _encoder(path: str):
    """Functions from a part of a text to its ids, little-endian: for the first part, and for the others.

    The library reads the vocabulary as ranks; ids are those of the same
    vocabulary's file for the ``tokenizers`` library, which takes four times as long
    for single words.
    """
    import public_tokenizers
    import tiktoken

    encoding = tiktoken.Encoding(
        "packing", pat_str=public_tokenizers.PATTERN, mergeable_ranks=read_ranks(path), special_tokens={}
    )

    def ids(text: str) -> bytes:
        return array("I", encoding.encode_ordinary(text)).tobytes()

    return ids, Remembered(lambda part: ids(" " + part))


def token_bytes(text: str, path: str) -> bytes:
    """All ids of a text as little-endian unsigned 32-bit numbers; added tokens are found first and have their own ids."""
    pattern, added = _added(path)
    between = pattern.split(text) if pattern else [text]
    return b"".join(added[t] if i % 2 else _plain_bytes(t, path) for i, t in enumerate(between))


def _plain_bytes(text: str, path: str) -> bytes:
    """All ids of a text without added tokens."""
    if not text:
        return b""
    first, others = _encoder(path)
    parts = parts_of(text)
    return first(parts[0]) + b"".join(map(others.__getitem__, parts[1:]))


def pieces_of(docs: DataFrame, vocabulary: str, window: int = WINDOW) -> DataFrame:
    """Every document's ids and the end id, cut into windows and a remainder."""
    path = tokenizer_file(vocabulary)

    def cut(batch: pa.RecordBatch) -> pa.RecordBatch:
        out: list[list] = [[] for _ in range(5)]
        for doc, text in zip(batch["doc_id"].to_pylist(), batch["text"], strict=True):
            ids = token_bytes(text.as_py(), path) + END.to_bytes(4, "little")
            for at in range(0, len(ids), 4 * window):
                piece = ids[at : at + 4 * window]
                for column, value in zip(
                    out, (doc, at // 4, len(piece) // 4, zlib.crc32(piece), len(ids) // 4), strict=True
                ):
                    column.append(value)
        names = ["doc_id", "start", "length", "ids_crc32", "doc_tokens"]
        return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in out], names=names)

    return apply_batches(
        docs.select(F.col("doc_id").cast("long"), whole().alias("text")),
        cut,
        "doc_id long, start long, length long, ids_crc32 long, doc_tokens long",
    )


def combinations(window: int) -> list[tuple[int, ...]]:
    """Two to four lengths that fill the window, at most two of them different but for the last."""
    found = set()
    for a in range(1, window):
        for rest in ((), (a,), (2 * a,), (a, a)):
            last = window - a - sum(rest)
            if last >= 1:
                found.add(tuple(sorted((a, *rest, last), reverse=True)))
    return sorted(found, key=lambda c: (len(c), c))


def nonnegative_repeats(columns: list[tuple[int, ...]], histogram: np.ndarray, sweeps: int = SWEEPS) -> np.ndarray:
    """Repeats of the columns, none below zero, that come closest to the histogram: coordinate descent."""
    counted = [tuple(Counter(c).items()) for c in columns]
    norms = [sum(k * k for _, k in c) for c in counted]
    left = histogram.astype(float).tolist()
    x = [0.0] * len(columns)
    for _ in range(sweeps):
        moved = 0.0
        for j, column in enumerate(counted):
            step = max(-x[j], sum(k * left[n] for n, k in column) / norms[j])
            if step:
                x[j] += step
                moved = max(moved, abs(step))
                for n, k in column:
                    left[n] -= k * step
        if moved < 0.01:
            break
    return np.array(x)


def plan(histogram: dict[int, int], window: int = WINDOW) -> list[tuple[tuple[int, ...], int]]:
    """Patterns of lengths with their repeats; together they use every piece exactly once."""
    left = np.zeros(window + 1, dtype=np.int64)
    for length, count in histogram.items():
        left[length] = count
    out: list[tuple[tuple[int, ...], int]] = []
    if left[window]:
        out.append(((window,), int(left[window])))
        left[window] = 0
    columns = [c for c in combinations(window) if all(left[n] for n in c)]
    repeats = np.rint(nonnegative_repeats(columns, left)).astype(np.int64)
    for j in np.argsort(-repeats, kind="stable"):
        taken = min([int(repeats[j]), *(int(left[n]) // k for n, k in Counter(columns[j]).items())])
        if taken > 0:
            out.append((columns[j], taken))
            for n in columns[j]:
                left[n] -= taken
    return out + greedy({n: int(left[n]) for n in range(window, 0, -1) if left[n]}, window)


def greedy(left: dict[int, int], window: int) -> list[tuple[tuple[int, ...], int]]:
    """Best fit, longest first, over classes of equal lengths and equal sequences."""
    opened: dict[int, dict[tuple[int, ...], int]] = defaultdict(dict)  # by the room left

    def put(pattern: tuple[int, ...], count: int) -> None:
        room = opened[window - sum(pattern)]
        room[pattern] = room.get(pattern, 0) + count

    for length in sorted(left, reverse=True):
        count = left[length]
        for room in range(length, window):
            if not count:
                break
            fits = opened.get(room)
            while count and fits:
                pattern, there = fits.popitem()
                times = min(room // length, -(-count // there))
                used = min(there, count // times)  # sequences that take the full number
                if used < there:
                    fits[pattern] = there - used
                put(pattern + (length,) * times, used)
                count -= used * times
                if used == 0:  # fewer pieces than one sequence would take
                    if there == 1:
                        fits.pop(pattern, None)
                    else:
                        fits[pattern] = there - 1
                    put(pattern + (length,) * count, 1)
                    count = 0
        most = window // length
        if count // most:
            put((length,) * most, count // most)
        if count % most:
            put((length,) * (count % most), 1)
    return [(pattern, n) for room in sorted(opened) for pattern, n in opened[room].items() if n]


def pack(docs: DataFrame, vocabulary: str = "byte_bpe_50k.tiktoken", window: int = WINDOW) -> DataFrame:
    """One row for each piece: its document, its ids' place there, its sequence and place in it.

    A null text is empty and has the end id alone.  Rows that repeat an id are
    packed as rows of their own.  An empty table gives no rows.  Only ``doc_id``
    and ``text`` are read.
    """
    scratch = Scratch(docs.sparkSession, "packing")
    pieces = scratch.table(pieces_of(docs, vocabulary, window), "pieces")
    histogram = dict(pieces.groupBy("length").count().collect())
    starts, bases, offsets = _intervals(plan(histogram, window))
    spread = docs.sparkSession.sparkContext.broadcast((starts, bases, offsets))

    def place(batch: pa.RecordBatch) -> pa.RecordBatch:
        starts, bases, offsets = spread.value
        key = (batch["length"].to_numpy().astype(np.int64) << 44) + batch["rank"].to_numpy()
        at = np.searchsorted(starts, key, side="right") - 1
        kept = [batch[c] for c in ("doc_id", "start", "length", "ids_crc32", "doc_tokens")]
        return pa.RecordBatch.from_arrays(
            [*kept, pa.array(bases[at] + key - starts[at]), pa.array(offsets[at])],
            names=["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"],
        )

    ranked = rank_within(pieces, ["length"], ["doc_id", "start", "ids_crc32", "doc_tokens"], "rank", Scratch.rows(pieces))
    return apply_batches(
        ranked.select("doc_id", "start", "length", "ids_crc32", "doc_tokens", "rank"),
        place,
        "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long",
    )


def _intervals(patterns: list[tuple[tuple[int, ...], int]]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """By length and first rank: the first sequence and the place in it, for a run of ranks."""
    used: dict[int, int] = defaultdict(int)
    rows, base = [], 0
    for pattern, repeats in patterns:
        offset = 0
        for length in pattern:
            rows.append(((length << 44) + used[length], base, offset))
            used[length] += repeats
            offset += length
        base += repeats
    table = np.array(sorted(rows), dtype=np.int64).reshape(-1, 3)
    return table[:, 0], table[:, 1], table[:, 2]

"""Byte-level BPE by rounds over padded matrices.

Each distinct match of the splitting pattern is one row of bytes.  Rows of like
length form a padded matrix; in every round each row merges its leftmost pair of
the lowest rank, the matrix is closed up, and rows with no pair left leave it.
The ranks of pairs come from a hash table of numpy arrays.  A row too long for a
matrix merges all its pairs of the lowest rank in one round, but only where one
after the other would give the same.
"""

from __future__ import annotations

import base64
import hashlib
from functools import lru_cache

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from topicweave.llm.shared import apply_batches, tokenizer_file, whole
from topicweave.llm.words import parts_of

NONE = np.int32(2**31 - 1)
WIDTHS = (2, 3, 4, 5, 6, 7, 8, 10, 12, 16, 20, 28, 40, 64, 128)
ROWS = 20_000
#: Text of one call, in characters, and parts remembered from one call to the next.
CALL_CHARS, REMEMBERED = 2_000_000, 250_000


class PairTable:
    """Ranks of pairs of ids: open addressing with linear probing."""

    def __init__(self, left: np.ndarray, right: np.ndarray, rank: np.ndarray):
        size = 1 << max(4, int(2 * len(rank)).bit_length())
        self.mask = size - 1
        self.keys = np.full(size, -1, dtype=np.int64)
        self.ranks = np.full(size, NONE, dtype=np.int32)
        key = (left.astype(np.int64) << 32) | right
        slot = self._slot(key)
        while len(key):
            free = self.keys[slot] == -1
            _, first = np.unique(slot, return_index=True)
            mine = np.zeros(len(key), dtype=bool)
            mine[first] = True
            mine &= free
            self.keys[slot[mine]] = key[mine]
            self.ranks[slot[mine]] = rank[mine]
            key, rank, slot = key[~mine], rank[~mine], (slot[~mine] + 1) & self.mask

    def _slot(self, key: np.ndarray) -> np.ndarray:
        mixed = (key ^ (key >> 29)).astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
        return (mixed >> np.uint64(33)).astype(np.int64) & self.mask

    def rank(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """The rank of each pair, ``NONE`` where there is none; negative ids have no pairs."""
        shape = left.shape
        key = ((left.astype(np.int64) << 32) | right.astype(np.int64)).ravel()
        out = np.full(len(key), NONE, dtype=np.int32)
        open_ = np.flatnonzero((left.ravel() >= 0) & (right.ravel() >= 0))
        slot = self._slot(key[open_])
        while len(open_):
            there = self.keys[slot]
            hit = there == key[open_]
            out[open_[hit]] = self.ranks[slot[hit]]
            more = ~hit & (there != -1)
            open_, slot = open_[more], (slot[more] + 1) & self.mask
        return out.reshape(shape)


class Vocabulary:
    """Ranks of byte strings, and the encoder and decoder over them."""

    def __init__(self, ranks: dict[bytes, int], pattern: str):
        self.ranks = ranks
        self.pattern = regex.compile(pattern)
        self.token = np.empty(max(ranks.values()) + 1, dtype=object)
        for token, rank in ranks.items():
            self.token[rank] = token
        self.byte = np.array([ranks[bytes([b])] for b in range(256)], dtype=np.int32)
        pairs = [
            (ranks[t[:i]], ranks[t[i:]], r)
            for t, r in ranks.items()
            for i in range(1, len(t))
            if t[:i] in ranks and t[i:] in ranks
        ]
        columns = np.array(pairs, dtype=np.int64).reshape(-1, 3).T
        self.pairs = PairTable(columns[0], columns[1], columns[2].astype(np.int32))
        self.first: dict[str, bytes] = {}
        self.later: dict[str, bytes] = {}

    def encode_all(self, rows: list[bytes]) -> list[np.ndarray]:
        """Ids of each row of bytes, every row on its own."""
        out: list[np.ndarray | None] = [None] * len(rows)
        buckets: dict[int, list[int]] = {}
        for i, row in enumerate(rows):
            whole_id = self.ranks.get(row)
            if whole_id is not None or not row:
                out[i] = np.array([whole_id] if row else [], dtype=np.int32)
            elif len(row) > WIDTHS[-1]:
                out[i] = self._long(self.byte[np.frombuffer(row, dtype=np.uint8)])
            else:
                buckets.setdefault(next(w for w in WIDTHS if w >= len(row)), []).append(i)
        for width, at in buckets.items():
            for k in range(0, len(at), ROWS):
                self._matrix(width, [rows[i] for i in at[k : k + ROWS]], at[k : k + ROWS], out)
        return out  # type: ignore[return-value]

    def _matrix(self, width: int, rows: list[bytes], at: list[int], out: list) -> None:
        flat = np.frombuffer(b"".join(r.ljust(width, b"\0") for r in rows), dtype=np.uint8).reshape(-1, width)
        size = np.array([len(r) for r in rows])
        ids = np.where(np.arange(width) < size[:, None], self.byte[flat], np.int32(-1))
        rank = self.pairs.rank(ids[:, :-1], ids[:, 1:])
        place = np.array(at)
        while len(ids):
            best = rank.argmin(axis=1)  # the first of equal ranks
            low = rank[np.arange(len(ids)), best]
            done = low == NONE
            if done.any():
                for i in np.flatnonzero(done):
                    out[place[i]] = ids[i, : size[i]].copy()
                keep = ~done
                ids, rank, place, size, best, low = ids[keep], rank[keep], place[keep], size[keep], best[keep], low[keep]
                if not len(ids):
                    return
                used = int(size.max())
                ids, rank = ids[:, :used], rank[:, : used - 1]
            line = np.arange(len(ids))
            ids[line, best] = low
            columns = np.arange(ids.shape[1] - 1)
            closed = np.full_like(ids, -1)
            closed[:, :-1] = np.take_along_axis(ids, columns + (columns > best[:, None]), axis=1)
            ids = closed
            size -= 1
            after = np.full_like(rank, NONE)
            columns = np.arange(rank.shape[1] - 1)
            after[:, :-1] = np.take_along_axis(rank, columns + (columns >= best[:, None]), axis=1)
            # the two pairs that touch the merged id
            inner = best < ids.shape[1] - 1
            after[line[inner], best[inner]] = self.pairs.rank(ids[line[inner], best[inner]], ids[line[inner], best[inner] + 1])
            inner = best > 0
            after[line[inner], best[inner] - 1] = self.pairs.rank(ids[line[inner], best[inner] - 1], ids[line[inner], best[inner]])
            rank = after

    def _long(self, ids: np.ndarray) -> np.ndarray:
        rank = self.pairs.rank(ids[:-1], ids[1:])
        while len(rank) and (low := rank.min()) != NONE:
            at = np.flatnonzero(rank == low)
            # of runs of neighbouring places every second one, from the left
            run = np.flatnonzero(np.diff(at, prepend=-9) != 1)
            step = np.arange(len(at)) - np.repeat(run, np.diff(run, append=len(at)))
            at = at[step % 2 == 0]
            before, after = at[at > 0] - 1, at[at + 2 < len(ids)] + 2
            merged_before = np.isin(before, at + 1)
            left = np.where(merged_before, low, ids[before]).astype(np.int32)
            same = np.full(1, low, dtype=np.int32)
            touched = np.concatenate([
                self.pairs.rank(left, np.broadcast_to(same, left.shape)),
                self.pairs.rank(np.broadcast_to(same, after.shape), ids[after]),
            ])
            if len(at) > 1 and len(touched) and touched.min() <= low:
                at = at[:1]
            ids[at] = low
            ids = np.delete(ids, at + 1)
            at = at - np.arange(len(at))
            rank = np.delete(rank, np.minimum(at + np.arange(len(at)), len(rank) - 1))
            for side in (at - 1, at):
                side = side[(side >= 0) & (side < len(ids) - 1)]
                rank[side] = self.pairs.rank(ids[side], ids[side + 1])
        return ids

    def encode_texts(self, texts: list[str]) -> list[bytes]:
        """Ids of each text as little-endian unsigned 32-bit numbers."""
        parts = [parts_of(t) if t else [] for t in texts]
        if len(self.first) + len(self.later) > REMEMBERED:
            self.first.clear()
            self.later.clear()
        self._learn(self.first, "", {p[0] for p in parts if p})
        self._learn(self.later, " ", {w for p in parts for w in p[1:]})
        return [self.first[p[0]] + b"".join(map(self.later.__getitem__, p[1:])) if p else b"" for p in parts]

    def _learn(self, known: dict[str, bytes], before: str, wanted: set[str]) -> None:
        new = [w for w in wanted if w not in known]
        matches = [self.pattern.findall(before + w) for w in new]
        distinct = list({m for found in matches for m in found})
        ids = self.encode_all([m.encode() for m in distinct])
        coded = {m: i.astype("<u4").tobytes() for m, i in zip(distinct, ids, strict=True)}
        for word, found in zip(new, matches, strict=True):
            known[word] = b"".join(map(coded.__getitem__, found))

    def decode(self, ids: bytes) -> bytes:
        return b"".join(self.token[np.frombuffer(ids, dtype="<u4")].tolist())


def read_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as lines:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}


@lru_cache(maxsize=2)
def vocabulary(path: str, pattern: str) -> Vocabulary:
    """The vocabulary, built once in each Python worker."""
    return Vocabulary(read_ranks(path), pattern)


def encode_documents(docs: DataFrame, name: str = "byte_bpe_multi_50k.tiktoken") -> DataFrame:
    """``doc_id``, the ids of the whole text as little-endian bytes, and the bytes decoded from them.

    A null text is empty and has no ids.  Every row is encoded on its own;
    repeated ids stay repeated.  An empty table gives no rows.  Only ``doc_id``
    and ``text`` are read.
    """
    return _each_text(docs, name, lambda ids, decoded: [ids, decoded], "ids binary, decoded binary")


def encode_digests(docs: DataFrame, name: str = "byte_bpe_multi_50k.tiktoken") -> DataFrame:
    """As :func:`encode_documents`, with the number of ids and the digests of ids and decoded bytes."""

    def digests(ids: bytes, decoded: bytes) -> list:
        return [len(ids) // 4, hashlib.sha256(ids).hexdigest(), hashlib.sha256(decoded).hexdigest()]

    return _each_text(docs, name, digests, "n_tokens long, ids_sha256 string, decoded_sha256 string")


def _each_text(docs: DataFrame, name: str, make, columns: str) -> DataFrame:
    import public_tokenizers

    path, pattern = tokenizer_file(name), public_tokenizers.PATTERN
    kinds = {"binary": pa.binary(), "long": pa.int64(), "string": pa.string()}
    fields = [c.split() for c in columns.split(", ")]

    def step(batch: pa.RecordBatch) -> pa.RecordBatch:
        words = vocabulary(path, pattern)
        rows: list[list] = []
        held: list[str] = []
        chars = 0

        def flush() -> None:
            rows.extend(make(ids, words.decode(ids)) for ids in words.encode_texts(held))
            held.clear()

        for text in batch["text"]:
            held.append(text.as_py())
            chars += len(held[-1])
            if chars > CALL_CHARS:
                flush()
                chars = 0
        flush()
        made = [pa.array([r[k] for r in rows], kinds[kind]) for k, (_, kind) in enumerate(fields)]
        return pa.RecordBatch.from_arrays([batch["doc_id"], *made], names=["doc_id", *(f for f, _ in fields)])

    read = docs.select("doc_id", whole().alias("text"))
    return apply_batches(read, step, f"doc_id {read.schema['doc_id'].dataType.simpleString()}, {columns}")

"""Groups of spelling variants by a bit-sliced position index.

The index of a block of words holds one bitset for every position and letter: the
words with that letter there.  A query runs along its letters once.  Four bitsets
say which words agree so far without an error, with one letter replaced, with one
letter more, and with one letter less; the last two read the index one position
further or back.  One operation on 64-bit numbers moves 64 words a step, and a stripe
of queries moves at once.

Two words that differ by one edit share the first half or the last half of the
shorter one.  Words therefore meet only in cells: the length of the shorter word, the
side, and a bucket of the half's hash, with about as many buckets as fill blocks of the
index.  A cell of any size is cut into blocks and chunks, so a half that a third of the
vocabulary shares is many tasks.  Per task a word's neighbours are folded to their
number and the best one.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from topicweave.llm.exact import LOWER, UPPER
from topicweave.operators.blocks import block_join
from topicweave.scratch import Scratch

RUN = "[A-Za-zÀ-ÿ]+"
#: Words of a block of the index, and cells of (query, 64 words) a step works on.
BLOCK, STRIPE = 8192, 1 << 16
#: Letters of a block's words looked at, summed over its positions, per segment of the index.
LETTERS = 1 << 20
#: Lengths of words that are counted one by one.
LENGTHS = 64
FOLDED = "word string, n_near long, best struct<less:long,form:string>"


def vocabulary(docs: DataFrame, least_length: int = 5, least_count: int = 3, damaged: int = 97) -> DataFrame:
    """``word, n``: the words of all texts, where a run whose checksum ``damaged`` divides lacks a letter."""
    text = F.translate("text", UPPER, LOWER)
    runs = docs.select(
        F.coalesce(F.col("doc_id").cast("string"), F.lit("")).alias("id"),
        F.explode(F.regexp_extract_all(text, F.lit(RUN), F.lit(0))).alias("run"),
    ).where(F.length("run") >= least_length)
    h = F.crc32(F.concat("id", F.lit(":"), "run").cast("binary"))
    at = (h % F.length("run")).cast("int")
    less = F.concat(F.substring("run", F.lit(1), at), F.substring("run", at + 2, F.length("run")))
    words = runs.select(F.when(h % damaged == 0, less).otherwise(F.col("run")).alias("word"))
    words = words.where(F.length("word") >= least_length)
    return words.groupBy("word").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= least_count)


def half(shorter: Column) -> Column:
    """Letters that two words with one edit share at one of their ends at least; ``shorter``: the lesser length."""
    return F.floor(shorter / 2).cast("int")


def in_cells(words: DataFrame, least_length: int, block: int = BLOCK) -> DataFrame:
    """Every word once for each lesser length (its own and one less) and side: ``shorter, tail, bucket, word, n``.

    The numbers of buckets follow the counts of the lengths up to ``LENGTHS``; longer words have one number.
    """
    length = F.length("word")
    by_length = words.groupBy(F.least(length, F.lit(LENGTHS)).alias("length")).count().collect()
    count = {row["length"]: row["count"] for row in by_length}
    meet = [count.get(s, 0) + (count.get(s + 1, 0) if s < LENGTHS else 0) for s in range(1, LENGTHS + 1)]
    buckets = F.element_at(F.array(*[F.lit(max(1, -(-n // block))) for n in meet]), F.least("shorter", F.lit(LENGTHS)))
    sides = words.select("word", "n", F.explode(F.array(length, length - 1)).alias("shorter")).where(F.col("shorter") >= least_length)
    sides = sides.select("*", F.explode(F.array(F.lit(False), F.lit(True))).alias("tail"))
    size = half(F.col("shorter"))
    key = F.when(F.col("tail"), F.substring("word", -size, size)).otherwise(F.substring("word", F.lit(1), size))
    bucket = F.pmod(F.xxhash64(key), buckets)
    return sides.select("shorter", "tail", bucket.alias("bucket"), "word", "n")


class Index:
    """Bitsets of a block of words: for every position and letter the words that have it."""

    def __init__(self, letters: np.ndarray, lengths: np.ndarray, symbols: int):
        """letters: (words, positions) with 0 beyond a word's end, else 1 to ``symbols``."""
        n, positions = letters.shape
        self.slots = -(-n // 64)
        self.at = np.zeros((positions + 2, symbols + 1, self.slots), dtype=np.uint64)
        for p in range(positions):
            for letter in np.unique(letters[:, p]):
                if letter:
                    self.at[p, letter] = self._bits(letters[:, p] == letter)
        self.long = {int(k): self._bits(lengths == k) for k in np.unique(lengths)}
        self.none = np.zeros(self.slots, dtype=np.uint64)

    def _bits(self, chosen: np.ndarray) -> np.ndarray:
        out = np.zeros(self.slots * 64, dtype=bool)
        out[: len(chosen)] = chosen
        return np.packbits(out, bitorder="little").view("<u8")

    def near(self, queries: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
        """Pairs (query, word) one edit apart, for queries of one length."""
        full = np.full((len(queries), self.slots), ~np.uint64(0))
        none = np.zeros_like(full)
        same, replaced, more, less = full, none, none, none
        for i in range(length):
            letter = queries[:, i]
            here, further = self.at[i][letter], self.at[i + 1][letter]
            back = self.at[i - 1][letter] if i else none
            replaced = (replaced & here) | (same & ~here)
            more = (more | same) & further
            less = (less & back) | same
            same = same & here
        found = replaced & self.long.get(length, self.none)
        found |= (more | same) & self.long.get(length + 1, self.none)
        found |= less & self.long.get(length - 1, self.none)
        query, slot = np.nonzero(found)
        bits = np.unpackbits(found[query, slot].astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        which, bit = np.nonzero(bits)
        return query[which], slot[which] * 64 + bit


def _letters(words: list[str], symbol: dict[str, int], positions: int) -> np.ndarray:
    out = np.zeros((len(words), positions), dtype=np.int32)
    for i, word in enumerate(words):
        out[i, : len(word)] = [symbol.get(c, len(symbol) + 1) for c in word]
    return out


def near_pairs(queries: list[str], words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Places (query, word) of all pairs one edit apart, by index segments and stripes of queries of bounded memory."""
    longest = max(map(len, queries + words), default=0)
    segment = max(64, min(BLOCK, LETTERS // max(longest, 1) // 64 * 64))
    lengths = np.array([len(q) for q in queries], dtype=int)
    left, right = [np.zeros(0, dtype=np.int64)], [np.zeros(0, dtype=np.int64)]
    for start in range(0, len(words), segment):
        part = words[start : start + segment]
        symbol = {c: i + 1 for i, c in enumerate(sorted(set().union(*part)))}
        index = Index(_letters(part, symbol, longest), np.array([len(w) for w in part]), len(symbol) + 1)
        for length in np.unique(lengths):
            own = np.flatnonzero(lengths == length)
            step = max(1, STRIPE // index.slots)
            for i in range(0, len(own), step):
                stripe = own[i : i + step]
                q, w = index.near(_letters([queries[k] for k in stripe], symbol, int(length)), int(length))
                left.append(stripe[q])
                right.append(w + start)
    return np.concatenate(left), np.concatenate(right)


def _fold(chunk: pa.Table, block: pa.Table) -> pa.Table:
    """Per query word of a chunk: its neighbours in the block that belong to this cell, and the best of them."""
    out = {"word": [], "n_near": [], "best": []}
    if chunk.num_rows and block.num_rows:
        shorter, tail = chunk["shorter"][0].as_py(), chunk["tail"][0].as_py()
        queries, words, n = chunk["word"].to_pylist(), block["other"].to_pylist(), block["other_n"].to_pylist()
        size = shorter // 2
        best: dict[int, list] = {}
        for q, w in zip(*(x.tolist() for x in near_pairs(queries, words)), strict=True):
            a, b = queries[q], words[w]
            if min(len(a), len(b)) != shorter:
                continue  # met where both are the shorter one
            heads = a[:size] == b[:size]
            if tail and (heads or a[-size:] != b[-size:]) or not tail and not heads:
                continue  # met in another cell
            own, key = best.setdefault(q, [0, None]), (-n[w], b)
            own[0] += 1
            if own[1] is None or key < own[1]:
                own[1] = key
        for q, (count, (less, form)) in best.items():
            out["word"].append(queries[q])
            out["n_near"].append(count)
            out["best"].append({"less": less, "form": form})
    kinds = pa.schema([("word", pa.string()), ("n_near", pa.int64()), ("best", pa.struct([("less", pa.int64()), ("form", pa.string())]))])
    return pa.table(out, kinds)


def neighbours(words: DataFrame, least_length: int, block: int = BLOCK) -> DataFrame:
    """``word, n_near, best_n, best`` for the words with a near word."""
    cells = in_cells(words, least_length, block)
    candidates = cells.toDF("shorter", "tail", "bucket", "other", "other_n")
    found = block_join(
        cells.drop("n"), candidates, _fold, FOLDED, cell=("shorter", "tail", "bucket"), query_id="word", candidate_id="other",
        block_rows=block, few_cells=False,
    )
    one = found.groupBy("word").agg(F.sum("n_near").alias("n_near"), F.min("best").alias("best"))
    return one.select("word", "n_near", (-F.col("best.less")).alias("best_n"), F.col("best.form").alias("best"))


def roots(scratch: Scratch, forms: DataFrame) -> DataFrame:
    """``word, root`` for ``(word, form)``: follow forms to the last one.

    A form is at least twice as frequent as its word, so chains end; each round doubles the steps taken.
    """
    ahead = scratch.table(forms.select("word", F.col("form").alias("root")), "roots")
    while True:
        next_ = ahead.select(F.col("word").alias("_at"), F.col("root").alias("_further"))
        after = scratch.table(
            ahead.join(next_, ahead.root == next_._at, "left").select(
                "word", F.coalesce("_further", "root").alias("root"), F.col("_further").isNotNull().alias("moved")
            ),
            "roots",
            replaces=ahead,
            watch=F.col("moved"),
        )
        if not Scratch.watched(after):
            return after.select("word", "root")
        ahead = after.select("word", "root")
        ahead._scratch_path = after._scratch_path


def group_variants(
    docs: DataFrame, least_length: int = 5, least_count: int = 3, damaged: int = 97, times: int = 2, block: int = BLOCK
) -> DataFrame:
    """``word, form, root, n, n_near, form_n`` for every word of the vocabulary.

    A word's form is its most frequent near word (ties: the first in code-point
    order) if that one is at least ``times`` as frequent, else null; the root is the end of
    the chain of forms, the word itself without a form.  A null text has no words, and
    a null id counts as empty text in the checksum.  Rows that repeat an id or a text
    count each.  Without words there are no rows.
    """
    if times < 2 or least_length < 3:
        raise ValueError("forms must be more frequent than their words, and halves hold a letter")
    scratch = Scratch(docs.sparkSession, "variants")
    words = scratch.table(vocabulary(docs, least_length, least_count, damaged), "words")
    near = scratch.table(neighbours(words, least_length, block), "near")
    joined = words.join(near, "word", "left")
    takes = F.col("best_n") >= times * F.col("n")
    rows = scratch.table(
        joined.select(
            "word", F.when(takes, F.col("best")).alias("form"), "n", F.coalesce("n_near", F.lit(0).cast("long")).alias("n_near"),
            F.when(takes, F.col("best_n")).alias("form_n"),
        ),
        "rows",
        replaces=near,
    )
    scratch.drop(words)
    ends = roots(scratch, rows.where("form IS NOT NULL").select("word", "form"))
    return rows.join(ends, "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n"
    )

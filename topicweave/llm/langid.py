"""Language identification by prediction by partial matching over bytes.

For each language a context tree counts which byte follows the last three, two,
one and no bytes.  A byte's probability is its share in the longest context seen
in that language; a byte not seen there costs the escape and is then looked up
in the next shorter context among the bytes that are still possible.  So the
probabilities of all bytes add up to one, and the sum of a text's code lengths is
what an arithmetic coder with these frozen counts would need.  The language with
the shortest code wins; the score is its share under equal priors.

The trees come from a bounded sample and are expanded to one table of code
lengths in each Python worker.
"""

from __future__ import annotations

import uuid
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from topicweave.llm.shared import apply_batches, piece, remainder, sample_rows, whole

DEPTH = 3
PAD = b"\n" * DEPTH
STRIPE = 1 << 16
UNKNOWN = "und"

#: Language, contexts of each depth as numbers, and for each the counts of (context, byte).
Trees = dict[str, list[tuple[np.ndarray, np.ndarray]]]


def byte_array(text: str) -> np.ndarray:
    return np.frombuffer(PAD + text.lower().encode(), dtype=np.uint8)


def grow(texts: dict[str, list[str]]) -> Trees:
    """For each language and depth: distinct (context, byte) numbers and their counts."""
    trees: Trees = {}
    for lang, own in sorted(texts.items()):
        trees[lang] = []
        data = [byte_array(t).astype(np.int64) for t in own]
        for depth in range(DEPTH + 1):
            keys = []
            for b in data:
                key = np.zeros(len(b) - DEPTH, dtype=np.int64)
                for back in range(depth, -1, -1):
                    key = (key << 8) | b[DEPTH - back : len(b) - back]
                keys.append(key)
            joined = np.concatenate(keys) if keys else np.zeros(0, dtype=np.int64)
            trees[lang].append(np.unique(joined, return_counts=True))
    return trees


class CodeLengths:
    """Code lengths in bits of every byte after every context, for each language."""

    def __init__(self, trees: Trees):
        self.langs = sorted(trees)
        contexts = [np.zeros(1, dtype=np.int64)]
        for depth in range(1, DEPTH + 1):
            seen = [trees[lang][depth][0] >> 8 for lang in self.langs]
            contexts.append(np.unique(np.concatenate(seen)) if seen else np.zeros(0, dtype=np.int64))
        starts = np.cumsum([0, *(len(c) for c in contexts)])
        table = np.empty((int(starts[-1]), 256, len(self.langs)), dtype=np.float32)
        for k, lang in enumerate(self.langs):
            below = np.full((1, 256), 1 / 256)
            for depth, context in enumerate(contexts):
                if depth:
                    suffix = context & ((1 << 8 * (depth - 1)) - 1)
                    shorter = below[np.searchsorted(contexts[depth - 1], suffix)]
                else:
                    shorter = below
                counts = np.zeros((len(context), 256))
                key, n = trees[lang][depth]
                counts[np.searchsorted(context, key >> 8), key & 255] = n
                below = _blend(counts, shorter)
                table[starts[depth] : starts[depth + 1], :, k] = -np.log2(below)
        self.bits = table.reshape(int(starts[-1]) * 256, len(self.langs))
        # the longest context known for any three bytes
        self.at = np.zeros(1 << 24, dtype=np.int32)
        for depth in range(1, DEPTH + 1):
            grid = self.at.reshape(-1, 1 << 8 * depth)
            grid[:, contexts[depth]] = np.arange(starts[depth], starts[depth + 1], dtype=np.int32)

    def measure(self, text: str) -> np.ndarray:
        """Bits that each language's tree needs for the whole text."""
        b = byte_array(text)
        total = np.zeros(len(self.langs))
        for i in range(DEPTH, len(b), STRIPE):
            part = b[i - DEPTH : i + STRIPE].astype(np.int32)
            key = (part[:-3] << 16) | (part[1:-2] << 8) | part[2:-1]
            total += self.bits.take((self.at[key] << 8) | part[3:], axis=0).sum(axis=0, dtype=np.float64)
        return total


def _blend(counts: np.ndarray, shorter: np.ndarray) -> np.ndarray:
    """Shares of the seen bytes, and the escape spread over the others as the shorter context has it."""
    seen = counts > 0
    rows, kinds = counts.sum(axis=1, keepdims=True), seen.sum(axis=1, keepdims=True)
    others = np.where(seen, 0, shorter)
    free = others.sum(axis=1, keepdims=True)
    full = (kinds == 256) | (free <= 0)
    weight = np.maximum(rows + np.where(full, 0, kinds), 1)
    escape = np.where(full, 0, np.where(rows > 0, kinds / weight, 1))
    return np.where(seen, counts / weight, escape * others / np.where(free > 0, free, 1))


@lru_cache(maxsize=1)
def _tables(key: str, value) -> CodeLengths:
    return CodeLengths(value())


class _Held:
    """A broadcast that hashes by its model's name, so that a worker expands it once."""

    def __init__(self, shared):
        self._shared = shared

    def __call__(self) -> Trees:
        return self._shared.value

    def __hash__(self) -> int:
        return 0

    def __eq__(self, other) -> bool:
        return isinstance(other, _Held)


def predict(
    docs: DataFrame, learn_remainders: tuple[int, ...] = (0, 1, 3), divisor: int = 4, per_language: int = 400, max_chars: int = 50_000
) -> DataFrame:
    """``doc_id, held_out, lang_pred, score`` for every row.

    The trees learn from at most ``per_language`` texts of each language, and at
    most ``max_chars`` characters of a text, among rows whose id's checksum leaves one of
    ``learn_remainders``.  A null text, one without a letter, and any text where
    nothing could be learnt gives ``und`` with score 0.  Ties go to the first
    language by name.  An empty table gives no rows.
    """
    learn = remainder("doc_id", divisor).isin(*learn_remainders)
    usable = docs.where(learn & F.col("text").isNotNull()).select("doc_id", "lang", piece(max_chars).alias("text"))
    texts: dict[str, list[str]] = {}
    for lang, text in sample_rows(usable, "lang", per_language, ["lang", "text"]):
        texts.setdefault(lang, []).append(text)
    trees = grow(texts)
    name = uuid.uuid4().hex
    held = _Held(docs.sparkSession.sparkContext.broadcast(trees))

    def step(batch: pa.RecordBatch) -> pa.RecordBatch:
        model = _tables(name, held)
        langs, scores = [], []
        for value in batch["text"]:
            text = value.as_py()
            if not model.langs or not any(map(str.isalpha, text)):
                langs.append(UNKNOWN)
                scores.append(0.0)
                continue
            bits = model.measure(text)
            best = int(bits.argmin())
            langs.append(model.langs[best])
            scores.append(float(1 / np.exp2(np.maximum(bits[best] - bits, -1000)).sum()))
        return pa.RecordBatch.from_arrays(
            [batch["doc_id"], batch["held_out"], pa.array(langs, pa.string()), pa.array(scores, pa.float64())],
            names=["doc_id", "held_out", "lang_pred", "score"],
        )

    read = docs.select("doc_id", (~learn).alias("held_out"), whole().alias("text"))
    kind = read.schema["doc_id"].dataType.simpleString()
    return apply_batches(read, step, f"doc_id {kind}, held_out boolean, lang_pred string, score double")

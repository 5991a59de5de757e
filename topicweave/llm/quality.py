"""Document quality by votes of the nearest labelled documents in a latent space.

A document has three parts: the weighted counts of its hashed words, the shares of
the words' shapes (letters, capitals, digits and signs, with repeats closed up),
and the share of words that repeat the word before them.  A truncated singular value
decomposition of a bounded labelled sample gives the latent directions.  The
sample's vectors are broadcast; every document's cosines with all of them are
computed in blocks, and the nearest vote for their labels, each by its
similarity.  Votes are weighed so that classes count as among all labelled rows, and
a text with no close neighbour leans to their shares.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from operator import eq

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from topicweave.llm.shared import apply_batches, labelled_texts, remainder, whole
from topicweave.llm.words import Remembered

SPACE = 1 << 20
#: Terms kept for the decomposition, latent directions, and neighbours that vote.
TERMS, DIRECTIONS, NEIGHBOURS = 4096, 48, 25
LEAST_TEXTS = 3
BLOCK = 1024

#: Weight of the words, the shapes and the repeats in a document, and of the labels' shares in a vote.
PARTS, PRIOR = (0.6, 1.0, 1.5), 2.0
REPEATS = SPACE - 1


class _Kinds(dict):
    """Each character's sign in a shape."""

    def __missing__(self, code: int) -> str:
        char = chr(code)
        kind = "9" if char.isdigit() else char if not char.isalpha() else "A" if char.isupper() else "a"
        self[code] = kind
        return kind


_KINDS, _RUN = _Kinds(), re.compile(r"(.)\1+")


def shape(word: str) -> str:
    """The word with runs of small letters, capitals, digits and equal signs closed up."""
    return _RUN.sub(r"\1", word.translate(_KINDS))[:12]


def terms(word: str) -> bytes:
    """Hashed terms of a word and of its shape, each as four bytes."""
    own = zlib.crc32(word.lower().encode()) % SPACE
    form = zlib.crc32(("\0" + shape(word)).encode()) % SPACE
    return own.to_bytes(4, "little") + form.to_bytes(4, "little")


class Space:
    """The latent space and the labelled vectors in it."""

    def __init__(self, chosen: np.ndarray, rarity: np.ndarray, basis: np.ndarray, vectors: np.ndarray, votes: np.ndarray):
        """rarity: of every hashed term; votes: for each labelled vector its weight for label 0 and for label 1."""
        self.rarity, self.basis, self.vectors, self.votes = rarity, basis, vectors, votes
        self.place = np.full(SPACE, -1, dtype=np.int32)
        self.place[chosen] = np.arange(len(chosen))
        self.hashed = Remembered(terms, most=100_000)

    def terms_of(self, text: str) -> tuple[np.ndarray, np.ndarray, np.ndarray, int]:
        """Hashed words and shapes of the distinct words, how often each word occurs, and the repeats."""
        words = text.split()
        found = Counter(words)
        both = np.frombuffer(b"".join(map(self.hashed.__getitem__, found)), dtype="<u4").reshape(-1, 2)
        repeats = sum(map(eq, words, words[1:]))
        return both[:, 0], both[:, 1], np.fromiter(found.values(), dtype=np.int64, count=len(found)), repeats

    def weighted(self, text: str) -> tuple[np.ndarray, np.ndarray]:
        """Places of the kept terms of a text, and their values."""
        words, shapes, n, repeats = self.terms_of(text)
        total = max(1, int(n.sum()))
        value = (1 + np.log(n)) * self.rarity[words]
        forms, back = np.unique(shapes, return_inverse=True)
        at = np.concatenate([words, forms, [REPEATS]]).astype(np.int64)
        values = np.concatenate([
            PARTS[0] * value / max(1e-12, float(np.sqrt((value * value).sum()))),
            PARTS[1] * np.sqrt(np.bincount(back, weights=n, minlength=len(forms)) / total),
            [PARTS[2] * np.sqrt(repeats / total)],
        ])
        place = self.place[at]
        return place[place >= 0], values[place >= 0]

    def project(self, texts: list[str]) -> np.ndarray:
        """Unit vectors of the texts; zero for a text without any kept term."""
        out = np.zeros((len(texts), self.basis.shape[1]), dtype=np.float32)
        for i, text in enumerate(texts):
            at, value = self.weighted(text)
            out[i] = value.astype(np.float32) @ self.basis[at]
        return out / np.maximum(np.sqrt((out * out).sum(axis=1, keepdims=True)), 1e-12)

    def score(self, texts: list[str]) -> np.ndarray:
        """Weighted share of label 1 among the nearest labelled vectors."""
        total = self.votes.sum(axis=0)
        prior = float(total[1] / total.sum()) if total.sum() else 0.5
        if not len(self.vectors):
            return np.full(len(texts), prior)
        out = np.empty(len(texts))
        k = min(NEIGHBOURS, len(self.vectors))
        for i in range(0, len(texts), BLOCK):
            cosine = self.project(texts[i : i + BLOCK]) @ self.vectors.T
            near = np.argpartition(-cosine, k - 1, axis=1)[:, :k]
            power = np.maximum(np.take_along_axis(cosine, near, axis=1), 0).astype(float) ** 4
            against, for_ = (power * self.votes[near, label] for label in (0, 1))
            lean = PRIOR * total.sum() / len(self.vectors)
            out[i : i + BLOCK] = (for_.sum(axis=1) + lean * prior) / ((for_ + against).sum(axis=1) + lean)
        return out


def fit(texts: list[tuple[str, int]], counts: dict[int, int], seed: int = 3) -> Space:
    """The latent space of a labelled sample, by subspace iteration from a fixed seed."""
    every = Space(np.zeros(0, dtype=int), np.ones(SPACE), np.zeros((0, 0), dtype=np.float32), np.zeros((0, 0)), np.zeros((0, 2)))
    held = np.zeros(SPACE, dtype=np.int64)
    for text, _ in texts:
        words, shapes, _n, _r = every.terms_of(text)
        held[np.unique(np.concatenate([words, shapes]))] += 1
    usual = np.argsort(-held, kind="stable")[:TERMS]
    chosen = np.union1d(usual[held[usual] >= LEAST_TEXTS], [REPEATS])
    rarity = np.log((1 + len(texts)) / (1 + held)) + 1
    space = Space(chosen, rarity, np.zeros((len(chosen), 0), dtype=np.float32), np.zeros((0, 0)), np.zeros((0, 2)))
    x = np.zeros((len(texts), len(chosen)), dtype=np.float32)
    for i, (text, _) in enumerate(texts):
        at, value = space.weighted(text)
        np.add.at(x[i], at, value.astype(np.float32))
    width = min(DIRECTIONS, *x.shape)
    if width:
        q = np.random.default_rng(seed).normal(size=(x.shape[1], width)).astype(np.float32)
        for _ in range(8):
            q, _r = np.linalg.qr(x.T @ (x @ q))
        space.basis = q.astype(np.float32)
    label = np.array([y for _, y in texts], dtype=int)
    each = np.array([counts.get(k, 0) / max(1, int((label == k).sum())) for k in (0, 1)])
    space.votes = np.zeros((len(texts), 2))
    space.votes[np.arange(len(texts)), label] = each[label]
    space.vectors = space.project([t for t, _ in texts])
    return space


def score_documents(
    docs: DataFrame,
    labels: DataFrame,
    divisor: int = 4,
    held_out: int = 2,
    per_class: int = 1500,
    max_chars: int = 50_000,
    threshold: float = 0.7,
) -> DataFrame:
    """The rows of ``docs`` by ``doc_id`` with ``held_out, score, predicted``.

    Labels are learnt from rows whose id's checksum does not leave ``held_out``:
    at most ``per_class`` of each class, and at most ``max_chars`` characters of
    a text.  A label whose document is missing counts for nothing.  A null text counts as empty; a text without a known term gets
    the share of label 1 among all labelled rows, and without labels 0.5.  Rows
    that repeat an id are scored one by one.  An empty table gives no rows.
    """
    out = remainder("doc_id", divisor) == held_out
    texts, counts = labelled_texts(docs, labels, "quality", per_class, max_chars, ~out)
    scores_of = _scorer(docs, fit(texts, counts))

    def step(batch: pa.RecordBatch) -> pa.RecordBatch:
        scores = scores_of(batch)
        return pa.RecordBatch.from_arrays(
            [batch["doc_id"], batch["held_out"], pa.array(scores), pa.array((scores >= threshold).astype(np.int32))],
            names=["doc_id", "held_out", "score", "predicted"],
        )

    read = docs.select("doc_id", out.alias("held_out"), whole().alias("text"))
    kind = read.schema["doc_id"].dataType.simpleString()
    return apply_batches(read, step, f"doc_id {kind}, held_out boolean, score double, predicted int")


def keep_good(
    docs: DataFrame,
    labels: DataFrame,
    divisor: int = 4,
    held_out: int = 2,
    per_class: int = 1500,
    max_chars: int = 50_000,
    threshold: float = 0.7,
) -> DataFrame:
    """The rows, unchanged, whose score as in :func:`score_documents` reaches the threshold."""
    learn = remainder("doc_id", divisor) != held_out
    texts, counts = labelled_texts(docs, labels, "quality", per_class, max_chars, learn)
    scores_of = _scorer(docs, fit(texts, counts))
    return apply_batches(docs, lambda batch: batch.filter(pa.array(scores_of(batch) >= threshold)), docs.schema)


def _scorer(docs: DataFrame, space: Space):
    """A function from a batch with a ``text`` column to its scores; the space is broadcast."""
    chosen = np.flatnonzero(space.place >= 0)
    rarity = space.rarity.astype(np.float32)
    model = docs.sparkSession.sparkContext.broadcast((chosen, rarity, space.basis, space.vectors, space.votes))

    def scores_of(batch: pa.RecordBatch) -> np.ndarray:
        if not hasattr(model, "_space"):
            model._space = Space(*model.value)
        texts = batch["text"]
        blocks = range(0, batch.num_rows, BLOCK)
        return np.concatenate([model._space.score([t.as_py() or "" for t in texts.slice(i, BLOCK)]) for i in blocks])

    return scores_of

"""Toxicity by a factorization machine over hashed terms.

A document is the set of its lower-case words and their stems, the first four
and five letters, each hashed to a number.  The machine adds a weight for each
term and, for each pair of terms, the product of their factor vectors, so that a
term can count for more in company.  The terms whose share differs most between
the classes of the learning texts have weights.  It learns by logistic loss from a
bounded sample; the classes weigh as they do among all labelled rows.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from topicweave.llm.shared import apply_batches, labelled_texts, remainder, whole
from topicweave.llm.words import Remembered

SPACE = 1 << 20
FACTORS = 8
#: Terms with weights, and the texts a term must be in.
TERMS, LEAST_TEXTS = 1024, 5
EPOCHS, BATCH, RATE, DECAY = 20, 256, 0.1, 3e-4
STEMS = (4, 5)
STRIPPED = ".,;:!?\"'()[]{}<>|*#$%&-_"


def term(word: str) -> bytes:
    """The hashed terms of a word and its stems, four bytes each."""
    bare = word.strip(STRIPPED)
    own = [bare, *("^" + bare[:n] for n in STEMS if len(bare) >= n)]
    return b"".join((zlib.crc32(t.encode()) % SPACE).to_bytes(4, "little") for t in own)


class Machine:
    def __init__(self, terms: np.ndarray, bias: float, weight: np.ndarray, factor: np.ndarray):
        self.bias, self.weight, self.factor = bias, weight, factor
        self.place = np.full(SPACE, -1, dtype=np.int32)
        self.place[terms] = np.arange(len(terms))
        self.hashed = Remembered(term)

    def terms_of(self, text: str) -> np.ndarray:
        """Places of the distinct terms of a text that have weights."""
        words = set(text.lower().split())
        at = self.place[np.frombuffer(b"".join(map(self.hashed.__getitem__, words)), dtype="<u4")]
        return np.unique(at[at >= 0])

    def raw(self, rows: list[np.ndarray]) -> np.ndarray:
        """The value before the logistic function, for the terms of each row."""
        size = np.array([len(r) for r in rows])
        out = np.full(len(rows), self.bias)
        some = np.flatnonzero(size)
        if len(some):
            at = np.concatenate([rows[i] for i in some])
            edge = np.cumsum(size[some]) - size[some]
            v = self.factor[at]
            both = np.add.reduceat(v, edge, axis=0)
            alone = np.add.reduceat((v * v).sum(axis=1), edge)
            out[some] += np.add.reduceat(self.weight[at], edge) + ((both * both).sum(axis=1) - alone) / 2
        return out

    def score(self, rows: list[np.ndarray]) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.raw(rows), -60, 60)))


def telling(with_term: np.ndarray, texts: np.ndarray) -> np.ndarray:
    """The terms whose share of texts differs most between the classes, against its spread."""
    either = with_term.sum(axis=0)
    share = with_term / np.maximum(texts, 1)[:, None]
    apart = np.where(either >= LEAST_TEXTS, (share[1] - share[0]) ** 2 / (either + LEAST_TEXTS), -1)
    best = np.argsort(-apart, kind="stable")[:TERMS]
    return np.sort(best[apart[best] >= 0])


def fit(texts: list[tuple[str, int]], counts: dict[int, int], seed: int = 5) -> Machine:
    """Adaptive gradient steps over shuffled batches; the order depends on ``seed`` alone."""
    machine = Machine(np.arange(SPACE), 0.0, np.zeros(0), np.zeros((0, FACTORS)))
    rows = [machine.terms_of(t) for t, _ in texts]
    y = np.array([label for _, label in texts], dtype=float)
    label = y.astype(int)
    with_term = np.zeros((2, SPACE))
    for row, k in zip(rows, label, strict=True):
        with_term[k, row] += 1
    terms = telling(with_term, np.bincount(label, minlength=2))
    machine = Machine(terms, 0.0, np.zeros(0), np.zeros((0, FACTORS)))
    rows = [machine.place[r] for r in rows]
    rows = [r[r >= 0] for r in rows]
    n = len(terms)
    rng = np.random.default_rng(seed)
    machine.weight, machine.factor = np.zeros(n), rng.normal(0, 0.01, (n, FACTORS))
    have = {k: max(1, int((y == k).sum())) for k in (0, 1)}
    total = max(1, sum(counts.values()))
    weight = np.where(y == 1, counts.get(1, 0) / have[1], counts.get(0, 0) / have[0]) * len(y) / total
    if len(y):
        share = min(max(counts.get(1, 0) / total, 0.001), 0.999)
        machine.bias = float(np.log(share / (1 - share)))
    steps_w, steps_v = np.full(n, 1e-6), np.full((n, FACTORS), 1e-6)
    for _ in range(EPOCHS if n else 0):
        order = rng.permutation(len(rows))
        for k in range(0, len(order), BATCH):
            chosen = [i for i in order[k : k + BATCH] if len(rows[i])]
            if not chosen:
                continue
            own = [rows[i] for i in chosen]
            size = np.array([len(r) for r in own])
            error = (machine.score(own) - y[chosen]) * weight[chosen] / len(chosen)
            at = np.concatenate(own)
            v = machine.factor[at]
            both = np.add.reduceat(v, np.cumsum(size) - size, axis=0)
            each = np.repeat(error, size)
            grad_v = each[:, None] * (np.repeat(both, size, axis=0) - v)
            used, back = np.unique(at, return_inverse=True)
            gw = np.bincount(back, weights=each) + DECAY * machine.weight[used]
            gv = np.stack([np.bincount(back, weights=grad_v[:, f]) for f in range(FACTORS)], axis=1)
            gv += DECAY * machine.factor[used]
            steps_w[used] += gw * gw
            steps_v[used] += gv * gv
            machine.weight[used] -= RATE * gw / np.sqrt(steps_w[used])
            machine.factor[used] -= RATE / 10 * gv / np.sqrt(steps_v[used])
            machine.bias -= RATE * float(error.sum()) / 10
    return machine


def score_documents(
    docs: DataFrame, labels: DataFrame, divisor: int = 5, held_out: int = 0, per_class: int = 4000, max_chars: int = 50_000
) -> DataFrame:
    """``doc_id, held_out, score, predicted`` for every row.

    Labels are learnt from rows whose id's checksum does not leave ``held_out``:
    at most ``per_class`` of each class, and at most ``max_chars`` characters of
    a text.  A label whose document is missing counts for nothing.  A null text counts as empty and scores as the bias alone.
    Without any labels the score is 0.5.  Rows that repeat an id are scored one
    by one.  An empty table gives no rows.
    """
    out = remainder("doc_id", divisor) == held_out
    texts, counts = labelled_texts(docs, labels, "toxic", per_class, max_chars, ~out)
    machine = fit(texts, counts)
    terms = np.flatnonzero(machine.place >= 0)
    model = docs.sparkSession.sparkContext.broadcast((terms, machine.bias, machine.weight, machine.factor))

    def step(batch: pa.RecordBatch) -> pa.RecordBatch:
        own = _machine(model)
        scores = own.score([own.terms_of(t.as_py()) for t in batch["text"]])
        return pa.RecordBatch.from_arrays(
            [batch["doc_id"], batch["held_out"], pa.array(scores), pa.array((scores >= 0.5).astype(np.int32))],
            names=["doc_id", "held_out", "score", "predicted"],
        )

    read = docs.select("doc_id", out.alias("held_out"), whole().alias("text"))
    kind = read.schema["doc_id"].dataType.simpleString()
    return apply_batches(read, step, f"doc_id {kind}, held_out boolean, score double, predicted int")


def _machine(model) -> Machine:
    """The machine of a broadcast, made once for each task's copy of it."""
    if not hasattr(model, "_machine"):
        model._machine = Machine(*model.value)
    return model._machine

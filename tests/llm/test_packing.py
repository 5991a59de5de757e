import zlib
from collections import Counter

import numpy as np
import public_tokenizers
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from topicweave.llm import packing

VOCABULARY = public_tokenizers.path("byte_bpe_50k.tiktoken")


def library():
    tokenizer = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    tokenizer.encode_special_tokens = True
    return lambda text: tokenizer.encode(text, add_special_tokens=False).ids


def test_ids_are_the_librarys():
    encode = library()
    texts = ["", " ", "a  b\n\n c", "It's  a test, isn't it? été 日本語 😀", "x" * 3000, "  lead and trail  ", "tab\tand\r\nlines"]
    for text in texts:
        assert np.frombuffer(packing.token_bytes(text, VOCABULARY), dtype="<u4").tolist() == encode(text)


def test_added_tokens_are_the_librarys():
    tokenizer = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    end = "<|endoftext|>"
    texts = [f"a {end} b", end, f"{end}{end}", f"x  {end}  y z\n", f" {end} ", f"<|{end}|> it's{end}It's", "<|endoftext|", f"{end} lead"]
    for text in texts:
        want = tokenizer.encode(text, add_special_tokens=False).ids
        assert np.frombuffer(packing.token_bytes(text, VOCABULARY), dtype="<u4").tolist() == want


def test_a_document_with_an_added_token(make):
    text = "a <|endoftext|> b"
    ids = np.array([*Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json")).encode(text, add_special_tokens=False).ids, 1], dtype="<u4")
    (row,) = packing.pack(make([(1, text)])).collect()
    assert (row.doc_tokens, row.length, row.ids_crc32) == (5, 5, zlib.crc32(ids.tobytes()))


@settings(max_examples=60, deadline=None)
@given(st.dictionaries(st.integers(1, 64), st.integers(1, 300), max_size=40))
def test_a_plan_uses_every_piece_once(histogram):
    used = Counter()
    for pattern, repeats in packing.plan(histogram, window=64):
        assert repeats > 0 and sum(pattern) <= 64
        for length in pattern:
            used[length] += repeats
    assert used == Counter(histogram)


def test_least_squares_reaches_its_optimum():
    rng = np.random.default_rng(0)
    columns = packing.combinations(24)
    h = np.zeros(25)
    h[1:24] = rng.integers(0, 50, 23)
    x = packing.nonnegative_repeats(columns, h, sweeps=3000)
    a = np.zeros((25, len(columns)))
    for j, c in enumerate(columns):
        for n in c:
            a[n, j] += 1
    gradient = a.T @ (a @ x - h)
    assert (x >= 0).all() and gradient.min() > -0.5 and abs(gradient[x > 1e-6]).max(initial=0) < 0.5


def test_little_padding():
    rng = np.random.default_rng(1)
    histogram = Counter((rng.exponential(500, 20_000).astype(int) % 2047 + 1).tolist())
    plan = packing.plan(histogram)
    assert sum(n for _, n in plan) * 2048 / sum(k * v for k, v in histogram.items()) < 1.002


def test_pieces_and_places(make, edge_rows):
    rows = edge_rows + [(20 + i, "word " * (37 * i)) for i in range(30)]
    got = packing.pack(make(rows)).collect()
    encode = library()
    ids = {}
    for i, t in rows:
        ids.setdefault(i, []).append([*encode(t or ""), 1])
    total = sum(len(x) for own in ids.values() for x in own)
    assert sum(r.length for r in got) == total
    for r in got:
        pieces = [np.array(x[r.start : r.start + r.length], dtype="<u4") for x in ids[r.doc_id] if len(x) == r.doc_tokens]
        assert r.ids_crc32 in [zlib.crc32(p.tobytes()) for p in pieces]
    starts = Counter((r.doc_id, r.doc_tokens, s) for r in got for s in (r.start,))
    for i, own in ids.items():
        for n, times in Counter(map(len, own)).items():
            assert all(starts[i, n, s] == times for s in range(0, n, 2048))
    sequences = {}
    for r in got:
        sequences.setdefault(r.sequence_id, []).append((r.offset, r.length))
    assert sorted(sequences) == list(range(len(sequences)))
    for own in sequences.values():
        own.sort()
        assert [o for o, _ in own] == [sum(n for _, n in own[:k]) for k in range(len(own))]
        assert sum(n for _, n in own) <= 2048
    assert packing.pack(make([])).count() == 0

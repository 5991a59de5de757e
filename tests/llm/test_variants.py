import random
import re
import zlib

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from topicweave.llm.variants import group_variants, near_pairs, neighbours

from .conftest import collected

COLUMNS = ("word", "form", "root", "n", "n_near", "form_n")


def one_edit(a, b):
    if a == b or abs(len(a) - len(b)) > 1:
        return False
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    a, b = sorted((a, b), key=len)
    return any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def counted(rows):
    n = {}
    for doc_id, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = re.sub("[A-Z]", lambda m: m[0].lower(), run)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            if h % 97 == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            n[run] = n.get(run, 0) + 1
    return {w: k for w, k in n.items() if len(w) >= 5 and k >= 3}


def brute(rows):
    n = counted(rows)
    near = {w: [v for v in n if one_edit(w, v)] for w in n}
    form = {}
    for w in n:
        best = min(near[w], key=lambda v: (-n[v], v), default=None)
        form[w] = best if best is not None and n[best] >= 2 * n[w] else None
    out = []
    for w in n:
        root = w
        while form[root] is not None:
            root = form[root]
        out.append((w, form[w], root, n[w], len(near[w]), n[form[w]] if form[w] else None))
    return sorted(out)


def texts(rng, rows, words):
    alphabet = "abÀé"
    vocabulary = ["".join(rng.choice(alphabet) for _ in range(rng.randrange(5, 9))) for _ in range(words)]
    return [(i, " ".join(vocabulary[int(len(vocabulary) * rng.random() ** 2)] for _ in range(60))) for i in range(rows)]


@pytest.mark.parametrize("block", [16, 8192])
def test_equals_brute_force(make, block):
    rows = texts(random.Random(3), 60, 500)
    got = sorted(tuple(r) for r in group_variants(make(rows), block=block).select(*COLUMNS).collect())
    assert got == brute(rows)
    assert sum(r[1] is not None for r in got) > 20 and any(r[1] != r[2] for r in got if r[1])


def test_hot_half(spark):
    """All words begin alike, so one cell holds them all and is cut into blocks."""
    words = ["abcd" + "".join(x) for x in __import__("itertools").product("xyz", repeat=4)]
    df = spark.createDataFrame([(w, 3 + i) for i, w in enumerate(words)], "word string, n long")
    got = {r.word: (r.n_near, r.best) for r in neighbours(df, 5, block=8).collect()}
    assert got == {w: (8, max((v for v in words if one_edit(w, v)), key=words.index)) for w in words}


words = st.text(alphabet="abcÀ", min_size=2, max_size=7)


@settings(max_examples=150, deadline=None)
@given(st.lists(words, max_size=12), st.lists(words, max_size=80))
def test_index_finds_all_pairs_with_one_edit(queries, others):
    found = set(zip(*(x.tolist() for x in near_pairs(queries, others))))
    assert found == {(i, j) for i, a in enumerate(queries) for j, b in enumerate(others) if one_edit(a, b)}


def test_edge_rows(make, edge_rows):
    assert collected(group_variants(make(edge_rows)), *COLUMNS) == sorted(brute(edge_rows), key=lambda r: tuple((x is not None, x) for x in r))
    assert group_variants(make([])).collect() == []
    assert group_variants(make([(1, "abcd abcd abcd"), (2, None)])).collect() == []


def test_capitals_outside_ascii_and_very_long_words(make):
    rows = [(None, "ÀBCDE àbcde ÀBCDE Àbcde"), (2, f"{'y' * 3000} {'y' * 3000} {'y' * 3000} {'y' * 3001} {'y' * 3001} {'y' * 3001}")]
    rows += [(i, "abc×e÷ abc×e÷") for i in range(3, 6)]
    assert sorted(tuple(r) for r in group_variants(make(rows)).select(*COLUMNS).collect()) == brute(rows)

import itertools
import random
import re

import numpy as np
import pytest
import regex

from topicweave.llm import neardup

from .conftest import collected


def words(text):
    own = r"[\p{Han}\p{Hiragana}\p{Katakana}\p{Thai}\p{Lao}\p{Khmer}\p{Myanmar}]"
    return regex.findall(rf"(?V1)[{own}&&\p{{L}}]\p{{M}}*|[[\p{{L}}\p{{M}}\p{{N}}]--[{own}&&\p{{L}}]]+", (text or "").lower())


def hashes(text):
    return np.array([hash(w) for w in words(text)], dtype=np.int64)


def alignment_similarity(a, b):
    """By a full table of edit distances and the matched runs of one of its best paths."""
    na, nb = len(a) - 4, len(b) - 4
    if min(na, nb) < 1:
        return 0.0
    d = np.zeros((len(a) + 1, len(b) + 1), dtype=int)
    d[:, 0], d[0, :] = range(len(a) + 1), range(len(b) + 1)
    for i, j in itertools.product(range(1, len(a) + 1), range(1, len(b) + 1)):
        d[i, j] = min(d[i - 1, j - 1] + (a[i - 1] != b[j - 1]), d[i - 1, j] + 1, d[i, j - 1] + 1)
    i, j, run, runs = len(a), len(b), 0, []
    while i or j:
        if i and j and a[i - 1] == b[j - 1] and d[i, j] == d[i - 1, j - 1]:
            run, i, j = run + 1, i - 1, j - 1
            continue
        runs.append(run)
        run = 0
        if i and j and d[i, j] == d[i - 1, j - 1] + 1:
            i, j = i - 1, j - 1
        elif i and d[i, j] == d[i - 1, j] + 1:
            i -= 1
        else:
            j -= 1
    runs.append(run)
    shared = sum(max(0, r - 4) for r in runs)
    return shared / (na + nb - shared)


def changed(rnd, text, times):
    w = text.split()
    for _ in range(times):
        at = rnd.randrange(len(w))
        kind = rnd.randrange(3)
        if kind == 0:
            w[at] = f"new{rnd.randrange(10**6)}"
        elif kind == 1:
            w.insert(at, f"more{rnd.randrange(10**6)}")
        else:
            del w[at]
    return " ".join(w)


def test_fewest_edits_and_similarity():
    rnd = random.Random(3)
    for _ in range(60):
        base = " ".join(f"w{rnd.randrange(400)}" for _ in range(rnd.randrange(5, 90)))
        other = changed(rnd, base, rnd.randrange(0, 4))
        a, b = hashes(base), hashes(other)
        want = alignment_similarity(a.tolist(), b.tolist())
        got = neardup.similarity(a, b, 0.8)
        assert (got >= 0.8) == (want >= 0.8)
        if got:
            assert got == pytest.approx(want, abs=0.03)
        runs = neardup.matched_runs(a, b, len(a) + len(b))
        assert sum(runs) <= min(len(a), len(b))
    assert neardup.matched_runs(np.arange(5), np.arange(10, 30), 3) is None


def most_in_order(a, b):
    """Similarity by a full table of the longest common sequence of k-mers."""
    x, y = ([tuple(w[i : i + 5]) for i in range(len(w) - 4)] for w in (a, b))
    d = [[0] * (len(y) + 1) for _ in range(len(x) + 1)]
    for i, j in itertools.product(range(len(x)), range(len(y))):
        d[i + 1][j + 1] = d[i][j] + 1 if x[i] == y[j] else max(d[i][j + 1], d[i + 1][j])
    return d[-1][-1] / (len(x) + len(y) - d[-1][-1])


def jaccard(a, b):
    x, y = ({tuple(w[i : i + 5]) for i in range(len(w) - 4)} for w in (a, b))
    return len(x & y) / len(x | y)


def test_a_block_that_goes_and_another_that_comes():
    x, d, y, i = ([f"{c}{k}" for k in range(n)] for c, n in (("x", 900), ("d", 60), ("y", 59), ("i", 60)))
    a, b = x + d + y, x + y + i
    got = neardup.similarity(hashes(" ".join(a)), hashes(" ".join(b)), 0.8)
    assert got == pytest.approx(jaccard(a, b)) and got > 0.88


def test_blocks_against_plain_shingles():
    rnd = random.Random(11)
    linked = 0
    for _ in range(150):
        base = [f"w{i}" for i in range(rnd.randrange(60, 400))]
        other = list(base)
        for _ in range(rnd.randrange(1, 4)):
            n, at = rnd.randrange(1, 1 + len(base) // 10), rnd.randrange(len(other))
            if rnd.random() < 0.5:
                del other[at : at + n]
            else:
                other[at:at] = [f"n{rnd.randrange(10**9)}" for _ in range(n)]
        want = jaccard(base, other)
        got = neardup.similarity(hashes(" ".join(base)), hashes(" ".join(other)), 0.8)
        assert got == pytest.approx(want if want >= 0.8 else 0.0)
        linked += want >= 0.8
    assert 50 < linked < 150


@pytest.mark.parametrize("pairs", [4, 0])
def test_most_kmers_in_order_with_repeats(monkeypatch, pairs):
    monkeypatch.setattr(neardup, "PAIRS", pairs)
    rnd = random.Random(13)
    linked = 0
    for _ in range(80):
        base = " ".join(rnd.choice("abc") for _ in range(rnd.randrange(5, 80)))
        other = changed(rnd, base, rnd.randrange(0, 3))
        a, b = words(base), words(other)
        want = most_in_order(a, b) if min(len(a), len(b)) > 4 else 0.0
        got = neardup.similarity(hashes(base), hashes(other), 0.8)
        assert got == pytest.approx(want if want >= 0.8 - 1e-9 else 0.0)
        linked += want >= 0.8
    assert linked > 10


def test_order_counts():
    a = " ".join(f"a{i}" for i in range(40))
    b = " ".join(f"b{i}" for i in range(40))
    one, two = neardup.sketches(neardup.kmers(hashes(f"{a} {b}"))), neardup.sketches(neardup.kmers(hashes(f"{b} {a}")))
    same = (one == two).mean()
    assert same < 0.5  # the same k-mers but for the seam, in another order
    assert neardup.similarity(hashes(f"{a} {b}"), hashes(f"{b} {a}"), 0.8) < 0.8


def test_equal_kmers_have_labels_and_stripes_do_not_matter(monkeypatch):
    h = neardup.kmers(hashes("a b c d e " * 6))
    assert len(np.unique(h)) == len(h)
    want = neardup.sketches(h)
    monkeypatch.setattr(neardup, "STRIPE", 7)
    got = neardup.sketches(h)
    assert (got == want).all()


def test_signatures_drop_no_pair_of_the_threshold():
    rng = np.random.default_rng(0)
    kept = 0
    for n in (6, 20, 150, 900, 5000):
        for _ in range(60):
            share = rng.uniform(0.6, 0.95)
            base = rng.integers(0, 2**63, n, dtype=np.int64).view(np.uint64)
            other = base.copy()
            other[: int(n * (1 - share))] = rng.integers(0, 2**63, int(n * (1 - share)), dtype=np.int64).view(np.uint64)
            true = len(np.intersect1d(base, other)) / len(np.union1d(base, other))
            got = neardup.possible(neardup.signature(base), n, neardup.signature(other)[None], np.array([n]), 0.8)[0]
            assert got or true < 0.8
            kept += bool(got and true < 0.7)
    assert kept < 20


def classes(rows):
    root = {i: i for i, _ in rows}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for (i, s), (j, t) in itertools.combinations(rows, 2):
        a, b = words(s), words(t)
        alike = a == b if (a or b) else (s or "") == (t or "")
        if alike or (min(len(a), len(b)) >= 0.8 * max(len(a), len(b)) and neardup.similarity(hashes(s), hashes(t), 0.8) >= 0.8):
            x, y = find(i), find(j)
            root[max(x, y)] = min(x, y)
    return sorted((i, find(i)) for i, _ in rows)


def corpus(seed=5):
    rnd = random.Random(seed)
    rows, n = [], 0
    passage = " ".join(f"p{i}" for i in range(60))
    for group in range(12):
        base = " ".join(f"w{rnd.randrange(5000)}" for _ in range(rnd.choice([30, 60, 200])))
        for k in range(rnd.choice([1, 2, 5, 25])):
            rows.append((n, changed(rnd, base, rnd.randrange(0, 1 + len(base) // 200)) if k else base))
            n += 1
    for _ in range(30):  # they share a passage and nothing else
        rows.append((n, passage + " " + " ".join(f"u{rnd.randrange(10**6)}" for _ in range(40))))
        n += 1
    return rows + [(n, "one two"), (n + 1, "one two"), (n + 2, "one three"), (n + 3, ""), (n + 4, None), (n + 5, "***"), (n + 6, "***")]


@pytest.mark.parametrize("block", [1024, 8])
def test_classes_are_those_of_all_pairs(make, monkeypatch, block):
    monkeypatch.setattr(neardup, "BLOCK", block)
    rows = corpus()
    got = neardup.near_duplicates(make(rows))
    assert collected(got, "doc_id", "class_id") == classes(rows)
    sizes = {}
    for r in got.collect():
        sizes.setdefault(r.class_id, []).append(r)
    for own in sizes.values():
        assert all(r.class_size == len(own) for r in own) and [r.doc_id for r in own if r.kept] == [own[0].class_id]


def test_edges(make, edge_rows):
    got = neardup.near_duplicates(make(edge_rows)).collect()
    assert len(got) == len(edge_rows)
    by_id = {r.doc_id: r.class_id for r in got if r.doc_id is not None}
    assert by_id[1] == by_id[5] == 1 and by_id[2] == by_id[3] == 2 and by_id[4] == 4 and by_id[7] == 7
    assert sum(r.kept for r in got) == len({r.class_id for r in got})
    assert neardup.near_duplicates(make([])).count() == 0


def test_scripts_without_spaces_and_marks(make, spark):
    rnd = random.Random(11)
    chinese = "".join(chr(0x4E00 + rnd.randrange(3000)) for _ in range(224))
    thai = "".join(chr(0x0E01 + rnd.randrange(40)) + rnd.choice(["", "\u0E34", "\u0E48"]) for _ in range(224))
    rows = []
    for i, text in enumerate((chinese, thai)):
        rows += [(10 * i + 1, text), (10 * i + 2, text[:100] + "x" + text[101:])]
    rows += [(50, "".join(chr(0x4E00 + rnd.randrange(3000)) for _ in range(224))), (60, "cafe\u0301 two three four five"), (61, "cafe two three four five")]
    got = {r.doc_id: r.class_id for r in neardup.near_duplicates(make(rows)).collect()}
    assert got == {1: 1, 2: 1, 11: 11, 12: 11, 50: 50, 60: 60, 61: 61}
    one = spark.createDataFrame([(t,) for _, t in rows], "text string").select("text", neardup.words_of("text").alias("words"))
    for r in one.collect():
        assert r.words == words(r.text)

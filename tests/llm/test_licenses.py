import random

import pytest

from topicweave.llm.licenses import PHRASES, TEMPLATES, plain_words, scan

from .conftest import collected

COLUMNS = ("doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score")


def brute(doc_id, text, templates=TEMPLATES, phrases=PHRASES, threshold=0.8):
    """Every block of the text against every template."""
    words = plain_words(text or "")
    templates, phrases = ([t for t in some if plain_words(t[1])] for some in (templates, phrases))
    stands = lambda at, phrase: words[at : at + len(phrase)] == phrase
    places = [(at, label) for label, phrase in phrases for at in range(len(words)) if stands(at, plain_words(phrase))]
    stride = max(len(plain_words(t)) for _, t in templates + phrases)
    own, share = set(), 0.0
    for label, text_ in templates:
        tokens = set(plain_words(text_))
        for start in range(0, len(words), stride):
            part = len(tokens & set(words[start : start + 2 * stride])) / len(tokens)
            if part >= threshold:
                own.add(label)
                share = max(share, part)
    base = {label for _, label in places}
    return (
        doc_id, len(words), len(places), min((p for p, _ in places), default=None), max((p for p, _ in places), default=None),
        ",".join(sorted(base)), ",".join(sorted(base | own)), 1.0 if places else share,
    )


def check(make, rows, **more):
    got = collected(scan(make(rows), **more), *COLUMNS)
    want = sorted([brute(*r[:2], **more) for r in rows], key=lambda r: tuple((x is not None, x) for x in r))
    assert [r[:7] for r in got] == [r[:7] for r in want]
    assert [r[7] for r in got] == pytest.approx([r[7] for r in want])


def test_edge_rows(make, edge_rows):
    check(make, edge_rows)


def test_equals_brute_force_on_mixed_texts(make):
    rng = random.Random(7)
    common = ["the", "of", "by", "all", "license", "under", "public", "word", "cc", "is", "x1"]
    rows = []
    for i in range(120):
        parts = []
        for _ in range(rng.randrange(1, 6)):
            parts.append(" ".join(rng.choice(common) for _ in range(rng.randrange(0, 40))))
            words = rng.choice(TEMPLATES + PHRASES)[1].split()
            for _ in range(rng.randrange(0, 3)):
                words[rng.randrange(len(words))] = rng.choice(["changed", ""])
            parts.append(" ".join(words))
        rows.append((i, " ".join(parts)))
    check(make, rows)


def test_places_of_phrases(make):
    rows = [
        (1, "CC-BY cc by, Cc.BY"), (2, "ccby cc by cc\u0000by"), (3, "All rights. Reserved all rights reserved all rights reserved"),
        (4, "general " * 50 + "public license"), (5, "Kcc by İcc by"), (6, "cc " * 70 + "by"),
    ]
    check(make, rows)
    got = {r.doc_id: r for r in scan(make(rows)).collect()}
    assert (got[1].n_base, got[1].first_word, got[1].last_word, got[1].score) == (3, 0, 4, 1.0)
    assert got[2].base_labels == "cc-by"
    assert (got[3].n_base, got[3].first_word, got[3].last_word) == (3, 0, 6)
    assert got[5].n_base == 0


def test_changed_notices_and_clean_texts(make):
    rows = [
        (1, "Released under an MIT License"), (2, "The mitt was released under water"),
        (3, "Licensed under the Apache Licence, Version 2.0"), (4, "rights of all kinds are reserved by law"),
    ]
    got = {r.doc_id: (r.labels, r.n_base) for r in scan(make(rows)).collect()}
    assert got == {1: ("mit", 0), 2: ("", 0), 3: ("apache", 0), 4: ("", 0)}


def test_hot_notice_and_other_templates(make):
    rows = [(i, f"text {i} all rights reserved " * 3) for i in range(300)]
    check(make, rows)
    check(make, [(1, "a b c d e"), (2, "a c e x y"), (3, "b")], templates=[("own", "a b c d e"), ("one", "b")], phrases=[("none", "!")], threshold=0.6)


def test_no_templates_and_empty_table(make):
    assert collected(scan(make([(1, "cc by")]), templates=[], phrases=[]), *COLUMNS) == [(1, 2, 0, None, None, "", "", 0.0)]
    assert scan(make([])).collect() == []


def test_main_path_has_no_python(make):
    plan = scan(make([(1, "cc by")]))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "MapIn" not in plan

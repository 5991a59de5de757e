import zlib

import numpy as np

from topicweave.llm import langid


def brute_bits(texts, text):
    """The code length of a text by scalar prediction by partial matching."""
    counts = {}
    for t in texts:
        b = langid.byte_array(t).tolist()
        for i in range(langid.DEPTH, len(b)):
            for d in range(langid.DEPTH + 1):
                own = counts.setdefault(tuple(b[i - d : i]), {})
                own[b[i]] = own.get(b[i], 0) + 1

    def shares(context):
        shorter = [1 / 256] * 256 if not context else shares(context[1:])
        own = counts.get(tuple(context))
        if not own and context:
            return shorter
        own = own or {}
        free = sum(p for s, p in enumerate(shorter) if s not in own)
        n, d = sum(own.values()), len(own)
        return [own[s] / (n + d) if s in own else (d / (n + d) if n else 1) * shorter[s] / free for s in range(256)]

    b = langid.byte_array(text).tolist()
    return sum(-np.log2(shares(tuple(b[i - langid.DEPTH : i]))[b[i]]) for i in range(langid.DEPTH, len(b)))


TEXTS = {"en": ["the cat and the dog", "this is that"], "de": ["der hund und die katze", "das ist größer"]}


def test_code_lengths_are_exact():
    model = langid.CodeLengths(langid.grow(TEXTS))
    for text in ("the hund", "größe?", "zzz", "", "A B\n"):
        got = model.measure(text)
        assert np.allclose(got, [brute_bits(TEXTS[lang], text) for lang in model.langs], rtol=1e-4)


def test_shares_of_every_context_add_up_to_one():
    model = langid.CodeLengths(langid.grow(TEXTS))
    total = np.exp2(-model.bits.astype(float)).reshape(-1, 256, 2).sum(axis=1)
    assert np.allclose(total, 1, atol=1e-4)


def test_striped_texts_measure_the_same(monkeypatch):
    model = langid.CodeLengths(langid.grow(TEXTS))
    whole = model.measure("the dog und der hund " * 50)
    monkeypatch.setattr(langid, "STRIPE", 17)
    assert np.allclose(whole, model.measure("the dog und der hund " * 50))


def test_edges(make, edge_rows):
    rows = [(100 + i, t, lang) for lang, texts in TEXTS.items() for i, t in enumerate(texts * 8)]
    got = langid.predict(make(rows + [(i, t, None) for i, t in edge_rows]))
    by_text = {(r.doc_id, r.lang_pred): r for r in got.collect()}
    assert got.count() == len(rows) + len(edge_rows)
    for i in (2, 3, 4):
        assert (i, "und") in by_text and by_text[i, "und"].score == 0
    assert all(r.lang_pred in ("de", "en", "und") and 0 <= r.score <= 1 for r in by_text.values())
    assert {r.lang_pred for r in langid.predict(make(edge_rows)).collect()} == {"und"}  # nothing to learn from
    assert langid.predict(make([])).count() == 0


def test_held_out_accuracy(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    got = langid.predict(docs).join(docs.select("doc_id", "lang"), "doc_id").collect()
    held = [r for r in got if zlib.crc32(str(r.doc_id).encode()) % 4 == 2]
    assert held and all(r.held_out for r in held)
    assert sum(r.lang == r.lang_pred for r in held) / len(held) > 0.95


def test_a_language_of_long_texts_only_is_learnt(make):
    german = "der schnelle braune Fuchs springt ueber den faulen Hund und freut sich sehr darueber "
    english = "the quick brown fox jumps over the lazy dog and is quite happy about it all "
    rows = [(i, german * 700, "de") for i in range(20)] + [(100 + i, english * 3, "en") for i in range(20)]
    got = langid.predict(make(rows)).collect()
    assert all(r.lang_pred == ("de" if r.doc_id < 100 else "en") for r in got)

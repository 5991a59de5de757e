import re

import numpy as np
import pytest
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from topicweave.operators import dictionary, tokens as tok

EDGES = [
    None, "", "   ", "a　bb\u0085cc\x1cdd", "zero​width xx", "한국어 토큰 을", "The the THE", "x" * 2501,
    "\n tabs\tand  spaces ",
]


def test_whitespace_equals_str_split(spark):
    df = spark.createDataFrame(list(enumerate(EDGES)), "doc_id long, text string")
    for stop, least in ((set(), 0), ({"the", "토큰"}, 2), ({f"w{i}" for i in range(20)} | {"The"}, 3)):
        got = {r.doc_id: r.tokens for r in tok.tokenize_whitespace(df, "text", stop, least).collect()}
        for i, text in enumerate(EDGES):
            assert got[i] == [w for w in (text or "").split() if len(w) >= least and w not in stop]
    plain = {r.doc_id: r.tokens for r in tok.tokenize_none(df).collect()}
    assert plain == {i: (t or "").split() for i, t in enumerate(EDGES)}


@pytest.mark.parametrize("more", [0, 10_001])
def test_stopword_tables_of_any_length(spark, more):
    rows = [(1, ["b", "a", "b", "c"]), (1, ["keep", "other"]), (2, ["a"]), (3, []), (4, None), (None, ["a", "d"])]
    df = spark.createDataFrame(rows, "doc_id long, tokens array<string>")
    stop = spark.createDataFrame([("a",), ("x",), (None,), ("a",), *((f"s{i}",) for i in range(more))], "word string")
    got = sorted(((r.doc_id, r.tokens) for r in tok.filter_tokens(df, "tokens", stop, 1).collect()), key=str)
    want = [(1, ["b", "b", "c"]), (1, ["keep", "other"]), (2, []), (3, []), (4, None), (None, ["d"])]
    assert got == sorted(want, key=str)
    bare = tok.filter_tokens(df.select("tokens"), "tokens", stop, 1)
    assert bare.columns == ["tokens"] and bare.count() == len(rows)


def nouns(pairs, stop=(), least=2):
    """The noun rule, step by step."""
    noun = ("NNG", "NNP")
    tag = lambda k: pairs[k][1] if k < len(pairs) else None
    out, i = [], 0
    while i < len(pairs):
        width = 1
        if tag(i) == "XPN" and tag(i + 1) in noun:
            width = 3 if tag(i + 2) == "XSN" else 2
        elif tag(i) in noun and tag(i + 1) == "XSN":
            width = 2
        group = pairs[i : i + width]
        if width > 1 or tag(i) in (*noun, "SL", "XPN", "XSN"):
            if group[-1] == ("들", "XSN"):
                group = group[:-1]
            if group:
                out.append("".join(f for f, _ in group))
        i += width
    out = [re.sub("들$", "", w).replace(" ", "") for w in out]
    return [w for w in out if len(w) >= least and w not in stop]


CASES = [
    [("신", "XPN"), ("청소년", "NNG"), ("법", "XSN")],
    [("신", "XPN"), ("청소년", "NNP"), ("들", "XSN")],
    [("신", "XPN"), ("청소년", "NNG"), ("은", "JX")],
    [("청소년", "NNG"), ("들", "XSN"), ("법", "XSN")],
    [("신", "XPN"), ("신", "XPN"), ("법", "NNG")],
    [("들", "XSN"), ("API", "SL"), ("아들", "NNG"), ("사람 들", "NNG")],
    [("신", "XPN")],
    [],
]
TAGGED = st.lists(
    st.tuples(st.sampled_from(["신", "법", "들", "사람", "a b", "는"]), st.sampled_from(["NNG", "NNP", "XPN", "XSN", "SL", "JX"])),
    max_size=12,
)


@settings(max_examples=5, deadline=None)
@given(st.lists(TAGGED, min_size=30, max_size=30))
def test_nouns(spark, more):
    docs = [*CASES, *more]
    df = spark.createDataFrame(list(enumerate(docs)), "doc_id long, pairs array<struct<form:string,tag:string>>")
    for least, stop in ((0, ()), (2, ("사람",))):
        got = {r.doc_id: r.tokens for r in tok.extract_nouns(df, "pairs", stop, least).collect()}
        assert got == {i: nouns(d, stop, least) for i, d in enumerate(docs)}


def test_nominals_are_merged(spark):
    pairs = [("학교", "NNG"), ("폭력", "NNG"), ("은", "JX"), ("서울", "NNP"), ("시", "NNG"), ("가", "JKS")]
    long_run = [("a", "NNG")] * 50_000
    df = spark.createDataFrame([(1, pairs), (2, long_run)], "doc_id long, pairs array<struct<form:string,tag:string>>")
    got = {r.doc_id: [(p.form, p.tag) for p in r.pairs] for r in tok.combine_nominals(df).collect()}
    assert got[1] == [("학교폭력", "NNG"), ("은", "JX"), ("서울시", "NNP"), ("가", "JKS")]
    assert got[2] == [("a" * 50_000, "NNG")]


def test_dictionary(spark):
    empty = spark.createDataFrame([("old", "np", 0, "x"), ("youth", "np", 0, "gone")], dictionary.DICTIONARY_SCHEMA)
    dicts = dictionary.register_dictionary(empty, "youth", ["청소년참여위원회", "ab", "ab"], ["abc"], ["학교^폭력"])
    assert {r.domain for r in dictionary.list_dictionary_domains(dicts).collect()} == {"old", "youth"}
    assert {(r.kind, r.pos, r.term) for r in dicts.where("domain = 'youth'").collect()} == {
        ("np", 0, "청소년참여위원회"), ("np", 1, "ab"), ("cp", 0, "abc"), ("cp_caret", 0, "학교^폭력"),
    }
    docs = [
        (1, [("청소년", "NNG"), ("참여", "NNG"), ("위원회", "NNG"), ("회의", "NNG")]),
        (2, [("a", "SL"), ("b", "SL"), ("c", "SL"), ("a", "SL"), ("b", "SL")]),
        (3, [("학교폭력", "NNG"), ("은", "JX")]),
        (4, []),
    ]
    df = spark.createDataFrame(docs, "doc_id long, pairs array<struct<form:string,tag:string>>")
    got = {r.doc_id: [(p.form, p.tag) for p in r.after] for r in dictionary.apply_dictionary(df, "pairs", dicts, "youth").collect()}
    assert got == {
        1: [("청소년참여위원회", "NNP"), ("회의", "NNG")],
        2: [("abc", "NNP"), ("ab", "NNP")],
        3: [("학교", "NNG"), ("폭력", "NNG"), ("은", "JX")],
        4: [],
    }
    sliced = dictionary.apply_dictionary(df, "pairs", dicts, "youth", max_chars=4)
    assert sliced.columns == ["doc_id", "pairs", "after"]
    assert {r.doc_id: [(p.form, p.tag) for p in r.after] for r in sliced.collect()} == got


def test_dictionary_against_every_stretch_of_tokens(spark):
    rng = np.random.default_rng(5)
    word = lambda n: "".join(rng.choice(list("ab"), n))
    docs = [(i, [(word(rng.integers(1, 4)), "X") for _ in range(rng.integers(0, 12))]) for i in range(200)]
    docs.append((200, [("ab", "X")] * 5000))
    whole, carets = {word(rng.integers(2, 9)) for _ in range(60)} | {"abab"}, {"a^ba", "b^b", "bb^a", "a^b^b"}
    split = {c.replace("^", ""): c.split("^") for c in carets}

    def expected(forms):
        out, i = [], 0
        while i < len(forms):
            fit = [n for n in range(2, min(len(forms) - i, 9) + 1) if "".join(forms[i : i + n]) in whole]
            if fit:
                out.append(("".join(forms[i : i + max(fit)]), "NNP"))
            else:
                out += [(p, "NNG") for p in split[forms[i]]] if forms[i] in split else [(forms[i], "X")]
            i += max(fit, default=1)
        return out

    none = spark.createDataFrame([], dictionary.DICTIONARY_SCHEMA)
    dicts = dictionary.register_dictionary(none, "d", np=whole, cp_caret=carets)
    df = spark.createDataFrame(docs, "doc_id long, pairs array<struct<form:string,tag:string>>")
    for bound in (8_000_000, 100):
        got = dictionary.apply_dictionary(df, "pairs", dicts, "d", max_chars=bound).collect()
        assert len(got) == 201
        for r in got:
            assert [tuple(p) for p in r.after] == expected([f for f, _ in docs[r.doc_id][1]]), bound


def test_tokenizer_by_name_and_function(spark):
    df = spark.createDataFrame([(1, "b-a"), (2, None)], "doc_id long, text string")
    got = tok.tokenize(df, lambda t: t.split("-")).orderBy("doc_id").collect()
    assert [r.tokens for r in got] == [["b", "a"], []]
    tagged = spark.createDataFrame([(1, [("사람", "NNG"), ("들", "XSN")])], "doc_id long, pairs array<struct<form:string,tag:string>>")
    assert tok.tokenize(tagged, "tagged").first().tokens == ["사람"]
    tagged = spark.createDataFrame(
        [(1, [("인공", "NNG"), ("지능", "NNG"), ("이", "JKS"), ("바다", "NNG"), ("새", "NNG")]), (2, [])],
        "doc_id long, pairs array<struct<form:string,tag:string>>",
    )
    none = spark.createDataFrame([], dictionary.DICTIONARY_SCHEMA)
    dicts = dictionary.register_dictionary(dictionary.register_dictionary(none, "tech", np=["인공지능"]), "sea", cp=["바다새"])

    def nouns(**options):
        got = tok.tokenize(tagged, "tagged", min_len=1, **options)
        assert got.columns == ["doc_id", "pairs", "tokens"]
        rows = {r.doc_id: r for r in got.collect()}
        assert rows[2].tokens == [] and len(rows[1].pairs) == 5
        return rows[1].tokens

    assert nouns() == ["인공", "지능", "바다", "새"]
    assert nouns(dicts=dicts, domains=["tech"]) == ["인공지능", "바다", "새"]
    assert nouns(dicts=dicts, domains=["tech", "sea"]) == ["인공지능", "바다새"]
    assert nouns(dicts=dicts, domains=["sea"], nominals=True) == ["인공지능", "바다새"]
    with pytest.raises(ValueError):
        tok.tokenize(tagged, "tagged", domains=["tech"])
    with pytest.raises(ValueError):
        tok.tokenize(df, "unknown")


def test_word_sets_skip_empty_documents(spark):
    df = spark.createDataFrame([(1, ["a", "b", "a"]), (2, [])], "doc_id long, tokens array<string>")
    assert [(r.doc_id, r.words) for r in tok.doc_word_sets(df).collect()] == [(1, ["a", "b"])]
    assert tok.join_tokens(df).orderBy("doc_id").first().document == "a b a"


def test_dictionary_casts_a_document_once(spark):
    """The list of tokens is a column when spans are put in, not a cast that every span would do again."""
    docs = spark.createDataFrame([(1, "ab cd e")], "doc_id long, text string")
    pair = lambda w: F.struct(w.alias("form"), F.lit("NNG").alias("tag"))
    docs = docs.select("doc_id", F.transform(F.split("text", " "), pair).alias("pairs"))
    dicts = spark.createDataFrame([("d", "np", 0, "abcd")], dictionary.DICTIONARY_SCHEMA)
    out = dictionary.apply_dictionary(docs, "pairs", dicts, "d")
    assert [tuple(p) for p in out.first().after] == [("abcd", "NNP"), ("e", "NNG")]
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("cast(pairs") <= 1 and plan.count("cast(transform(") <= 1


def test_places_of_tokens_are_remembered(monkeypatch):
    monkeypatch.setattr(dictionary, "MAX_PLACES", 2)
    terms, places = ["ab", "abcd", "x"], {}
    met = [dictionary._meet(list(row), terms, {}, places) for row in (["a", "b", "zz"], ["ab", "cd", "x", "y"])]
    assert [[(m["at"], m["n"], m["put"]) for m in row] for row in met] == [[(0, 2, ["ab"])], [(0, 2, ["abcd"])]]
    assert len(places) <= 2 and all(terms[low].startswith(w) for w, low in places.items() if low >= 0)

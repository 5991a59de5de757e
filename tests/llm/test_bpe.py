import random

import numpy as np
import public_tokenizers
import pytest
import tiktoken
from hypothesis import given, settings
from hypothesis import strategies as st

from topicweave.llm import bpe

PATH = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")


@pytest.fixture(scope="module")
def words():
    return bpe.vocabulary(PATH, public_tokenizers.PATTERN)


@pytest.fixture(scope="module")
def library():
    return tiktoken.Encoding("t", pat_str=public_tokenizers.PATTERN, mergeable_ranks=bpe.read_ranks(PATH), special_tokens={})


def ids(words, text):
    return np.frombuffer(words.encode_texts([text])[0], dtype="<u4").tolist()


_words = bpe.vocabulary(PATH, public_tokenizers.PATTERN)
_library = tiktoken.Encoding("t", pat_str=public_tokenizers.PATTERN, mergeable_ranks=bpe.read_ranks(PATH), special_tokens={})


@settings(max_examples=200, deadline=None)
@given(st.text(alphabet=st.one_of(st.sampled_from("ab the\n\t 'sé日"), st.characters(exclude_categories=["Cs"])), max_size=60))
def test_any_text_is_encoded_as_by_the_library(text):
    assert ids(_words, text) == _library.encode_ordinary(text)
    assert _words.decode(_words.encode_texts([text])[0]) == text.encode()


@pytest.mark.parametrize("seed", range(4))
def test_long_rows_merge_as_short_ones(words, library, seed):
    rnd = random.Random(seed)
    for letters in ("a", "ab", "theing", "etaoinshrdlu"):
        text = "".join(rnd.choice(letters) for _ in range(rnd.choice([100, 129, 700, 3000])))
        assert ids(words, text) == library.encode_ordinary(text)


def test_a_text_with_special_tokens_is_plain(words, library):
    text = "a <|endoftext|> b"
    assert ids(words, text) == library.encode_ordinary(text)


def test_pair_table_finds_all_and_only_its_pairs():
    rng = np.random.default_rng(1)
    pairs = np.unique(rng.integers(0, 3000, (5000, 2)), axis=0)
    table = bpe.PairTable(pairs[:, 0], pairs[:, 1], np.arange(len(pairs), dtype=np.int32))
    assert (table.rank(pairs[:, 0], pairs[:, 1]) == np.arange(len(pairs))).all()
    known = set(map(tuple, pairs.tolist()))
    others = rng.integers(-1, 3000, (5000, 2))
    for (a, b), r in zip(others.tolist(), table.rank(others[:, 0], others[:, 1]), strict=True):
        assert ((a, b) in known) == (r != bpe.NONE)


def test_rows_of_a_table(make, edge_rows, library):
    got = bpe.encode_documents(make(edge_rows)).collect()
    assert len(got) == len(edge_rows)
    found = sorted((str(r.doc_id), bytes(r.ids), bytes(r.decoded)) for r in got)
    want = sorted(
        (str(i), np.array(library.encode_ordinary(t or ""), dtype="<u4").tobytes(), (t or "").encode()) for i, t in edge_rows
    )
    assert found == want
    assert bpe.encode_digests(make([])).count() == 0

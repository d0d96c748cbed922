"""BPE against the tokenizers library."""

import hashlib

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from filigree.llm import bpe
from filigree.llm.queries import vocabulary_path

WANT = Tokenizer.from_file(vocabulary_path())
OWN = bpe.Encoder(bpe.read_vocabulary(vocabulary_path()))


@settings(max_examples=300, deadline=None)
@given(st.text(alphabet=st.one_of(st.characters(exclude_categories=["Cs"]), st.sampled_from(list("ab 's\n\t\x1c\x85\xa0")))))
def test_ids_and_round_trip(text):
    ids = WANT.encode(text, add_special_tokens=False).ids
    assert OWN.encode(text) == ids
    assert OWN.decode(ids) == WANT.decode(ids, skip_special_tokens=False) == text


@pytest.mark.parametrize("text", ["", "a<|endoftext|>b<|endoftext|>", "x" * 3000, "ab" * 2000 + " c", "  \n\n a"])
def test_special_and_long(text):
    assert OWN.encode(text) == WANT.encode(text, add_special_tokens=False).ids


def test_long_words_like_short_ones(monkeypatch):
    word = "antidisestablishmentarianism".encode() * 3
    short = OWN._long_word_ids(word)
    monkeypatch.setattr(bpe, "LONG", 10_000)
    assert OWN.word_ids(word) == short


def test_documents(spark):
    rows = [(1, "a b", "x"), (2, None, "y"), (3, "", "z"), (1, "a b", "x")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, n_tokens string")
    out = bpe.encode_documents(docs, vocabulary_path(), ("n_tokens", "ids", "ids_sha256", "decoded", "decoded_sha256")).collect()
    assert sorted((r.doc_id, r.n_tokens, r.decoded) for r in out) == [(1, 2, "a b"), (1, 2, "a b"), (2, 0, ""), (3, 0, "")]
    for r in out:
        assert r.ids_sha256 == hashlib.sha256(",".join(map(str, r.ids)).encode()).hexdigest()
    assert bpe.encode_documents(docs.limit(0), vocabulary_path()).count() == 0

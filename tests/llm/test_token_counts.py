"""Token counts against the tokenizer's library."""

import public_tokenizers
import pytest
from hypothesis import given, settings, strategies as st
from rows import AWKWARD, documents
from tokenizers import Tokenizer

from orderloom.llm import token_counts
from orderloom.llm.token_counts import WholeTokens, count_tokens

PATH = public_tokenizers.path("word_bpe_49k.json")
LIBRARY, OWN = Tokenizer.from_file(PATH), WholeTokens(PATH)


def library(text):
    return len(LIBRARY.encode(text or "", add_special_tokens=False).ids)


PARTS = ["<|endoftext|>", "<|startoftext|>", "<|ENDOFTEXT|>", "don't", "'S", " ", "\n", "İ", "ß",
         "é", "é", "̇", "Σ", "ς", "漢字", "😀", "½", "12", "\x85", "\xa0", "\x1f", "​",
         "the", "unbelievable", "!!", "|", "<", "Å", "K"]


@settings(max_examples=300, deadline=None)
@given(st.lists(st.one_of(st.sampled_from(PARTS), st.text(max_size=6)), max_size=20))
def test_any_text(parts):
    text = "".join(parts).encode("utf-8", "ignore").decode()
    assert OWN.count(text) == library(text)


def test_proved_tokens_are_single():
    words = sorted(OWN.whole)[::97]
    assert len(OWN.whole) > 30_000
    assert all(len(OWN.model.tokenize("".join(token_counts._LETTERS[b] for b in w.encode()))) == 1
               for w in words)


def test_pieces_and_forgetting(monkeypatch):
    text = "Some words<|endoftext|>and more, of any kind; " * 50
    monkeypatch.setattr(token_counts, "PIECE", 16)
    monkeypatch.setattr(token_counts, "REMEMBERED", 3)
    assert "".join(token_counts.pieces(text, 16)) == text
    assert WholeTokens(PATH).count(text) == library(text)


def test_rows(spark):
    got = count_tokens(documents(spark, AWKWARD), PATH).collect()
    want = [(r[0], len((r[1] or "").encode()), library(r[1]), library(r[1]) > 2048)
            for r in AWKWARD]
    assert sorted(map(tuple, got), key=repr) == sorted(want, key=repr)
    assert count_tokens(documents(spark, []), PATH).collect() == []


def test_whole_table(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    want = {r["doc_id"]: library(r["text"]) for r in docs.collect()}
    assert {r["doc_id"]: r["n_tokens"] for r in count_tokens(docs, PATH).collect()} == want

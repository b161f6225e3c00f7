from __future__ import annotations

import hashlib

import numpy as np
import pytest
import public_tokenizers as tokenizers
import tiktoken

from panelwise.llm import bpe

PATH, PATTERN = tokenizers.path("byte_bpe_multi_50k.tiktoken"), tokenizers.PATTERN


@pytest.fixture(scope="module")
def words():
    return bpe.vocabulary(PATH, PATTERN)


@pytest.fixture(scope="module")
def judge(words):
    return tiktoken.Encoding("judge", pat_str=PATTERN, mergeable_ranks=words.ranks, special_tokens={})


HARD = [
    "", " ", "\n\n  x", "a" * 3000 + "b" * 777, "é" * 999, "-" * 5001, "abab" * 700, "日本語のテキスト" * 200, "it's don't 123  456\t\t\n",
    "<|endoftext|> hi", "\x00\x01", "👩‍👩‍👧 family", "Der.%%% mit*** $$$ !!", "ﬁ ligature  x   ", "\r\n\r\n" * 40,
]


def test_every_token_merges_to_itself(words):
    assert words.improper() == []


def test_equals_library(words, judge):
    tokens, at = words.encode(HARD)
    for text, a, b in zip(HARD, at[:-1], at[1:]):
        assert list(tokens[a:b]) == judge.encode_ordinary(text)
    assert [x.decode() for x in words.decode(tokens, at)] == HARD


def test_forgets_rare_words_and_stays_right(words, judge, monkeypatch):
    monkeypatch.setattr(bpe, "KEPT_WORDS", 50)
    texts = [" ".join(f"w{i}x{j}" for j in range(40)) for i in range(6)]
    for text in texts:
        tokens, _ = words.encode([text])
        assert list(tokens) == judge.encode_ordinary(text)
    words._forget()


def test_keeps_the_words_of_a_piece_larger_than_the_cache(words, judge, monkeypatch):
    monkeypatch.setattr(bpe, "KEPT_WORDS", 50)
    words._forget()
    often = " ".join(f"o{i}" for i in range(24))
    for text in (often, often, "rare once", often, " ".join(f"n{i}" for i in range(60)) + " rare once", often + " rare", "m " * 9):
        assert list(words.encode([text])[0]) == judge.encode_ordinary(text)
    words._forget()


def test_round_trip_of_odd_rows(odd, odd_rows, judge):
    got = sorted(map(tuple, bpe.round_trip(odd, PATH, PATTERN).collect()), key=str)
    want = []
    for key, text in odd_rows:
        ids = judge.encode_ordinary(text or "")
        raw = np.array(ids, "<u4").tobytes()
        want.append((key, len(ids), hashlib.sha256(raw).hexdigest(), hashlib.sha256((text or "").encode()).hexdigest()))
    assert got == sorted(want, key=str)


def test_encode_then_decode(odd, odd_rows, empty):
    coded = bpe.encode(odd.withColumnRenamed("words", "ids"), PATH, PATTERN)
    assert "ids" in coded.columns and coded.columns.count("ids") == 1
    back = bpe.decode(coded, PATH, PATTERN).select("doc_id", "decoded").collect()
    assert sorted(bytes(r.decoded).decode() for r in back) == sorted(x or "" for _, x in odd_rows)
    assert bpe.round_trip(empty, PATH, PATTERN).count() == 0
    assert bpe.encode(empty, PATH, PATTERN).count() == 0


def test_unknown_token_is_an_error(words):
    with pytest.raises(ValueError):
        words.decode(np.array([60_000], np.int32), np.array([0, 1]))

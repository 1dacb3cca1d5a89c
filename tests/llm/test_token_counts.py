"""Token counts against the library."""

import random

import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from scourline.llm.token_counts import TokenCounter, count_tokens, slices

PATH = public_tokenizers.path("byte_bpe_50k.json")
LIBRARY = Tokenizer.from_file(PATH)


@pytest.fixture(scope="module")
def counter():
    return TokenCounter(PATH)


def by_library(text):
    return len(LIBRARY.encode(text or "", add_special_tokens=False).ids)


def test_whole_tokens_are_proved(counter):
    whole = [s for s in counter.costs if counter.costs[s] == 1]
    assert len(whole) > 49_000
    for string in random.Random(1).sample(whole, 2000):
        assert len(LIBRARY.model.tokenize("".join(counter.costs.letters[b] for b in string.encode()))) == 1


def test_like_library(counter):
    r = random.Random(7)
    parts = ["a", "The", " ", "  ", "\n", "'s", "'LL", "<|endoftext|>", "1", "½", "\x1c", "\x85", "!", "中文"]
    for _ in range(3000):
        text = "".join(r.choice([*parts, chr(r.randrange(0x3000)), chr(r.randrange(0xE000, 0x110000))]) for _ in range(r.randrange(30)))
        assert counter.count(text) == by_library(text), repr(text)
    assert counter.unlike and counter.alike


@settings(max_examples=200, deadline=None)
@given(st.text())
def test_any_text(text):
    assert TOTAL.count(text) == by_library(text)


TOTAL = TokenCounter(PATH)


def test_long_texts_in_slices(counter):
    text = "the quick brown foxes' 12 jump! \n\n  a" * 40_000
    parts = list(slices(text, 1000))
    assert len(parts) > 1000 and "".join(parts) == text
    assert sum(map(by_library, parts)) == counter.count(text) == by_library(text)
    assert counter.count("x" * 50_000) == by_library("x" * 50_000)


def test_other_vocabularies_are_counted_by_the_library():
    path = public_tokenizers.path("word_bpe_49k.json")
    text = "Some Words, in CAPITALS.\n" * 50
    want = len(Tokenizer.from_file(path).encode(text, add_special_tokens=False).ids)
    assert not TokenCounter(path).proved
    assert TokenCounter(path).count(text) == want


def test_odd_tables(spark):
    schema = "doc_id long, text string, n_tokens string, row int, `a.b` int"
    rows = [(None, None, "x", 1, 1), (1, "", "x", 1, 2), (1, "", "x", 1, 2), (2, "é " * 2000, "x", 1, 3)]
    df = spark.createDataFrame(rows, schema)
    found = count_tokens(df, PATH, 1024)
    assert found.columns == ["doc_id", "row", "a.b", "n_bytes", "n_tokens", "over_limit"]
    got = sorted(map(tuple, found.select("doc_id", "n_bytes", "n_tokens", "over_limit").collect()), key=repr)
    long = by_library("é " * 2000)
    assert got == sorted([(None, 0, 0, False), (1, 0, 0, False), (1, 0, 0, False), (2, 6000, long, long > 1024)], key=repr)
    assert count_tokens(df.limit(0), PATH, 1024).count() == 0
    assert count_tokens(df.select("text"), PATH, 9).count() == 4

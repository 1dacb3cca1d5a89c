"""Substring removal and its recompression, against brute force."""

from collections import Counter

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from scourline.llm.recompression import recompress
from scourline.llm.substrings import Chunk, remove_repeats


def brute(texts, width):
    words = [(t or "").encode().split() for t in texts]
    seen = Counter(
        tuple(w[i : i + width]) for w in words for i in range(len(w) - width + 1)
    )
    out = []
    for w in words:
        gone = {
            j
            for i in range(len(w) - width + 1)
            if seen[tuple(w[i : i + width])] > 1
            for j in range(i, i + width)
        }
        kept = b" ".join(x for i, x in enumerate(w) if i not in gone).decode()
        out.append((len(w), len(gone), kept))
    return out


def texts_for_tests():
    base = " ".join(f"w{i * 7 % 61}" for i in range(300))
    words = base.split()
    return [
        base, base, " ".join(words[20:80]), " ".join(words[:34]), None, "", " \n ",
        "a " * 100, "a b " * 60, "x y z " * 12 + "q", "ä " * 35,
        "new " + " ".join(words[100:140]) + " end", " ".join(f"u{i}" for i in range(4000)),
        "nbsp joins " * 40,
    ]


@pytest.mark.parametrize("width", [35, 5, 1])
def test_like_brute_force(spark, width):
    texts = texts_for_tests()
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r.doc_id: tuple(r)[1:] for r in remove_repeats(df, width).collect()}
    assert [got[i] for i in range(len(texts))] == brute(texts, width)


def test_odd_tables(spark):
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert remove_repeats(empty).count() == 0
    same = "p " + " ".join(f"w{i}" for i in range(40))
    rows = [(None, same, 1, "x"), (7, same, 2, "y"), (7, same, 3, "z"), (8, "solo", 4, None)]
    df = spark.createDataFrame(rows, "doc_id long, text string, chunk long, keys string")
    got = sorted(map(tuple, remove_repeats(df).collect()), key=repr)
    assert got == sorted(
        [(None, 41, 41, ""), (7, 41, 41, ""), (7, 41, 41, ""), (8, 1, 0, "solo")], key=repr
    )
    with pytest.raises(ValueError):
        remove_repeats(df, 0)


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(0, 3), min_size=1, max_size=80), st.integers(0, 20), st.integers(0, 20))
def test_equal_stretches_share_symbols(core, before, after):
    """A symbol whose reach lies in a stretch stands in every copy of the stretch."""
    random = np.random.default_rng(len(core))
    names = np.array(core, np.uint64)
    text = np.concatenate(
        [random.integers(0, 4, before).astype(np.uint64), names,
         random.integers(0, 4, after).astype(np.uint64)]
    )
    for rounds in (1, 3, 6):
        wall = np.zeros(len(text), bool)
        wall[0] = True
        inside = recompress(text, wall, rounds)
        twice = np.concatenate([text, names[::-1], names])
        wall = np.zeros(len(twice), bool)
        wall[[0, len(text)]] = True
        other = recompress(twice, wall, rounds)
        shift = len(text) + len(names) - before
        places = set(zip(other.name.tolist(), other.start.tolist()))
        for name, start, low, high in zip(*inside):
            if low >= before and high <= before + len(names):
                assert (int(name), int(start) + shift) in places


def test_every_window_has_a_key():
    chunk = Chunk([t.encode() if t else None for t in texts_for_tests()], 35)
    _, low, high, alone = chunk.keys()
    held = chunk.covered(low, high)
    held[alone] = True
    assert (held == chunk.whole).all()

"""Near duplicates against brute force."""

from collections import defaultdict
from itertools import combinations

import numpy as np
import pytest

from scourline.llm import ngram_join
from scourline.llm.components import components
from scourline.llm.ngram_join import bands_for, drop_near_duplicates, near_duplicates, rows_of


def grams(text):
    words = (text or "").encode().split()
    width = min(5, len(words))
    return frozenset(tuple(words[i : i + width]) for i in range(len(words) - width + 1)) if words else None


def brute(rows):
    """Class and links of each row, by comparing all pairs of sets."""
    sets = defaultdict(list)
    for i, (_, text) in enumerate(rows):
        sets[grams(text)].append(i)
    alone = sets.pop(None, [])
    keys = list(sets)
    root = list(range(len(keys)))
    links = [0] * len(keys)

    def find(a):
        while root[a] != a:
            a = root[a]
        return a

    for a, b in combinations(range(len(keys)), 2):
        both = len(keys[a] & keys[b])
        if both >= 0.8 * (len(keys[a]) + len(keys[b]) - both) - 1e-12:
            links[a] += 1
            links[b] += 1
            root[find(b)] = find(a)
    classes = defaultdict(list)
    for k, key in enumerate(keys):
        classes[find(k)] += sets[key]
    out = [None] * len(rows)
    for members in classes.values():
        for i in members:
            out[i] = min(rows[j][0] for j in members)
    of = {i: (links[k], len(sets[key]) - 1) for k, key in enumerate(keys) for i in sets[key]}
    return [
        (rows[i][0], rows[i][0] if i in alone else out[i], *of.get(i, (0, 0)))
        for i in range(len(rows))
    ]


def corpus():
    random = np.random.default_rng(11)
    rows = []
    for _ in range(6):
        base = [f"w{k}" for k in random.integers(0, 500, 120)]
        for _ in range(9):
            words = list(base)
            for at in random.integers(0, 120, random.integers(0, 4)):
                words[at] = "x" + str(random.integers(0, 50))
            rows.append(" ".join(words))
    rows += ["one two", "one two", "one", None, "", "a b c d e", "a b c d e f", "a " * 50, "a " * 70]
    rows.append(" ".join(f"long{i}" for i in range(20000)))
    return list(enumerate(rows))


@pytest.mark.parametrize("block", [1_000_000, 400])
def test_like_brute_force(spark, monkeypatch, block):
    monkeypatch.setattr(ngram_join, "BLOCK_NGRAMS", block)
    rows = corpus()
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = near_duplicates(rows_of(df)).collect()
    assert sorted((r.doc_id, r.class_id, r.n_links, r.n_copies) for r in got) == brute(rows)
    stay = {r.doc_id for r in got if r.stays}
    assert stay == {r.class_id for r in got}


def test_odd_tables(spark):
    schema = "doc_id long, text string, row string, node int, doc string"
    rows = [
        (None, "a b c d e f", "r", 1, None), (3, "a b c d e f", "s", 2, "x"),
        (3, "a b c d e f", "s", 2, "x"), (4, None, None, 3, None), (4, "", None, 4, None),
    ]
    df = spark.createDataFrame(rows, schema)
    left = drop_near_duplicates(df)
    assert left.columns == df.columns
    assert sorted(map(tuple, left.collect()), key=repr) == sorted([rows[0], rows[3], rows[4]], key=repr)
    assert drop_near_duplicates(df.limit(0)).count() == 0


def test_bands_meet_the_recall():
    for similarity, recall in ((0.8, 0.999), (0.5, 0.9), (0.95, 0.9999)):
        bands, rows = bands_for(similarity, recall)
        assert 1 - (1 - similarity**rows) ** bands >= recall
    with pytest.raises(ValueError):
        bands_for(0.01, 0.999)


def test_components(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, 101), (101, 100), (7, 7), (None, 3), (50, 60), (60, 55)]
    got = dict(map(tuple, components(spark.createDataFrame(edges, "a long, b long")).collect()))
    want = dict.fromkeys(range(41), 0) | {100: 100, 101: 100, 50: 50, 60: 50, 55: 50}
    assert got == want
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0

"""Decontamination against brute force."""

import re

import numpy as np

from scourline.llm.decontaminate import contamination, drop_contaminated

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words(text):
    small = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    return WORD.findall(small)


def brute(docs, items):
    windows = {}
    for item, text in items:
        w = words(text)
        n = min(len(w), 10)
        for i in range(len(w) - n + 1) if w else ():
            windows.setdefault(tuple(w[i : i + n]), set()).add(item)
    out = []
    for doc, text in docs:
        w, hit, found = words(text), set(), set()
        for window, owners in windows.items():
            for i in range(len(w) - len(window) + 1):
                if tuple(w[i : i + len(window)]) == window:
                    hit.update(range(i, i + len(window)))
                    found |= owners
        out.append((doc, len(w), len(hit), sorted(str(f) for f in found if f is not None)))
    return sorted(out, key=repr)


def test_like_brute_force(spark):
    choose = np.random.default_rng(2)
    pool = [f"W{k}" for k in range(30)] + ["Été", "naïve", "42"]
    text = lambda n: " ".join(choose.choice(pool, n))
    items = [(k, text(choose.integers(12, 30))) for k in range(12)]
    items += [(20, "short one here"), (21, "Short, ONE here!"), (22, ""), (23, None), (24, "..."),
              (None, items[0][1]), (25, items[1][1]), (25, items[1][1]), (26, "solo"), (27, "a b c d e f g h i")]
    docs = []
    for k in range(40):
        parts = [text(choose.integers(0, 40))]
        if k % 2:
            w = items[k % 12][1].split()
            parts.append("; ".join(w[: choose.integers(5, len(w))]).upper())
        docs.append((k, " ".join([*parts, text(5)])))
    docs += [(100, None), (101, ""), (102, "short one here short one here"), (103, "?!"),
             (104, "A b c D e f g h i j"), (None, items[3][1]), (105, items[4][1]), (105, items[4][1]),
             (105, "other"), (106, "x " * 30000 + items[5][1])]
    df = spark.createDataFrame(docs, "doc_id long, text string")
    given = spark.createDataFrame(items, "item_id long, text string")
    got = [(r.doc_id, r.n_words, r.n_hit, list(r["items"])) for r in contamination(df, given).collect()]
    assert sorted(got, key=repr) == brute(docs, items)
    clean = sorted(((r.doc_id, r.text) for r in drop_contaminated(df, given).collect()), key=repr)
    hit = {(d, n) for d, n, h, _ in brute(docs, items) if h}
    assert clean == sorted(((d, t) for d, t in docs if (d, len(words(t))) not in hit), key=repr)


def test_odd_tables(spark):
    docs = spark.createDataFrame(
        [(1, "one two three", "k", 1), (2, "four", None, None)], "doc_id long, text string, key string, size int"
    )
    items = spark.createDataFrame([(9, "Two, three", "w")], "item_id long, text string, window string")
    assert drop_contaminated(docs, items).collect() == docs.where("doc_id = 2").collect()
    assert drop_contaminated(docs, items.limit(0)).count() == 2
    assert [r.n_hit for r in contamination(docs, items.limit(0)).collect()] == [0, 0]
    assert contamination(docs.limit(0), items).count() == 0

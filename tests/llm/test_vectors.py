"""Nearest neighbours against brute force."""

import numpy as np
from pyspark.sql import functions as F

from scourline.llm import vectors
from scourline.llm.vectors import Coded, code_products, nearest

SCHEMA = "id long, vector array<float>"


def test_error_bounds_hold():
    random = np.random.default_rng(3)
    a, b = Coded(random.normal(size=(40, 1100)) * 1e200), Coded(random.normal(size=(50, 1100)))
    near = code_products(a.codes, b.codes) * np.outer(a.scale, b.scale)
    exact = (a.vectors / a.norm[:, None]) @ (b.vectors / b.norm[:, None]).T
    slack = a.error[:, None] + (1 + a.error[:, None]) * b.error[None, :] + 1e-9
    assert (np.abs(near - exact) <= slack).all()


def test_exact_with_ties_and_small_tiles(spark, monkeypatch):
    monkeypatch.setattr(vectors, "QUERY_BLOCK", 8)
    monkeypatch.setattr(vectors, "CANDIDATE_BLOCK", 64)
    random = np.random.default_rng(4)
    rows = [(i, random.normal(size=6).astype(np.float32).tolist()) for i in range(300)]
    rows += [(1000 + i, [1.0, 0.0, 0.0, 0.0, 0.0, 0.0]) for i in range(60)]  # one frequent vector
    df = spark.createDataFrame(rows, SCHEMA)
    got = nearest(df, df.where("id % 20 = 0")).collect()
    ids = np.array([r[0] for r in rows])
    unit = np.array([r[1] for r in rows], float)
    unit /= np.linalg.norm(unit, axis=1, keepdims=True)
    for query in ids[ids % 20 == 0]:
        score = (unit * unit[ids == query]).sum(axis=1)
        score[ids == query] = -9
        best = np.lexsort((ids, -np.round(score, 12)))[:5]
        mine = sorted((r["rank"], r.vec_id, r.score) for r in got if r.query_id == query)
        assert [m[1] for m in mine] == ids[best].tolist()
        assert [m[0] for m in mine] == [1, 2, 3, 4, 5]
        assert np.allclose([m[2] for m in mine], score[best], atol=1e-12)


def test_odd_vectors(spark):
    nan, inf = float("nan"), float("inf")
    rows = [
        (1, [1.0, 0.0]), (2, [2.0, 0.0]), (2, [2.0, 0.0]), (3, None), (4, []), (5, [0.0, 0.0]),
        (6, [1.0, None]), (7, [nan, 1.0]), (8, [inf, 1.0]), (None, [1.0, 1.0]),
        (9, [1.0, 0.0, 0.0]), (10, [0.0, -1.0]),
    ]
    df = spark.createDataFrame(rows, SCHEMA).withColumn("row", F.lit(1)).withColumn("rank", F.lit("x"))
    got = sorted(tuple(r) for r in nearest(df, df).collect())
    assert got == [
        (1, 1, 2, 1.0), (1, 2, 2, 1.0), (1, 3, 10, 0.0), (2, 1, 1, 1.0), (2, 2, 2, 1.0), (2, 3, 10, 0.0),
        (10, 1, 1, 0.0), (10, 2, 2, 0.0), (10, 3, 2, 0.0),
    ]
    assert nearest(df.limit(0), df).count() == 0 and nearest(df, df.limit(0)).count() == 0


def test_rows_that_share_an_id(spark, monkeypatch):
    """Each row is a candidate and a query of its own, equal rows as candidates too."""
    monkeypatch.setattr(vectors, "CANDIDATE_BLOCK", 16)
    random = np.random.default_rng(8)
    rows = [(i % 40, random.normal(size=4).astype(np.float32).tolist()) for i in range(160)]
    rows += [(1, [0.0, 1.0, 0.0, 0.0]), (1, [1.0, 0.125, 0.0, 0.0])] + [(7, [1.0, 0.0, 0.0, 1.0])] * 9
    got = nearest(spark.createDataFrame(rows, SCHEMA), spark.createDataFrame([*rows, (99, [1.0, 0.0, 0.0, 0.0])], SCHEMA))
    found = {}
    for r in got.collect():
        found.setdefault(r.query_id, []).append((r["rank"], r.vec_id, round(r.score, 9)))
    unit = np.array([r[1] for r in rows])
    unit /= np.linalg.norm(unit, axis=1, keepdims=True)
    want = {}
    for query in {(i, tuple(v)) for i, v in rows} | {(99, (1.0, 0.0, 0.0, 0.0))}:
        score = np.round(unit @ (np.array(query[1]) / np.linalg.norm(query[1])), 9)
        others = [(-s, i) for k, (s, (i, v)) in enumerate(zip(score, rows))]
        if query[0] != 99:
            others.remove((-score[rows.index((query[0], list(query[1])))], query[0]))
        best = sorted(others)[:5]
        want.setdefault(query[0], []).extend((k + 1, i, -s) for k, (s, i) in enumerate(best))
    assert {q: sorted(v) for q, v in found.items()} == {q: sorted(v) for q, v in want.items()}
    assert (1, 1, round(1 / (1 + 0.125**2) ** 0.5, 9)) in found[99] or found[99][0][2] > 0.99

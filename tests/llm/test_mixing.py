"""Mixing: raked marginals, calibrated probabilities, odd rows."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from scourline.llm import mixing
from scourline.llm.mixing import calibrated, mix, n_tokens, rake

SCHEMA = "doc_id long, source string, lang string, topic string, tokens long"


def table(spark, n=600):
    choose = np.random.default_rng(6)
    rows = []
    for i in range(n):
        source = "big" if i % 3 == 0 else f"s{choose.integers(0, 4)}"
        rows.append((i, source, str(choose.choice(["en", "de"])), str(choose.choice(["a", "b", "c"])), int(choose.integers(1, 400))))
    return spark.createDataFrame(rows, SCHEMA)


def marginals(cells, dim):
    total = sum(c["fitted"] for c in cells)
    out = {}
    for c in cells:
        out[c[dim]] = out.get(c[dim], 0) + c["fitted"] / total
    return out


@pytest.mark.parametrize("one_task", [100_000, 0])
def test_raked_like_numpy(spark, monkeypatch, one_task):
    monkeypatch.setattr(mixing, "ONE_TASK_CELLS", one_task)
    docs = table(spark)
    cells = docs.groupBy("source", "lang", "topic").agg(F.sum("tokens").alias("tokens"))
    targets = {"source": 0.5, "lang": {"en": 3, "de": 1, "fr": 9}, "topic": {"a": 0.2, "b": 0.3, "c": 0.5}}
    got = rake(cells, targets).collect()
    assert marginals(got, "lang") == pytest.approx({"en": 0.75, "de": 0.25}, abs=1e-5)
    assert marginals(got, "topic") == pytest.approx(targets["topic"], abs=1e-5)
    size = {}
    for c in got:
        size[c.source] = size.get(c.source, 0) + c.tokens
    roots = {k: v**0.5 for k, v in size.items()}
    assert marginals(got, "source") == pytest.approx({k: v / sum(roots.values()) for k, v in roots.items()}, abs=1e-5)
    # Fitting keeps odds ratios: log(fitted / tokens) is a sum of terms of the dimensions.
    levels = sorted({(d, c[d]) for c in got for d in targets})
    design = np.array([[float(c[d] == v) for d, v in levels] for c in got])
    logs = np.log([c.fitted / c.tokens for c in got])
    assert np.abs(design @ np.linalg.lstsq(design, logs, rcond=None)[0] - logs).max() < 1e-6


def test_probabilities_meet_the_budget(spark):
    docs = table(spark)
    targets = {"source": 0.0, "lang": {"en": 0.9, "de": 0.1}}
    cells = docs.groupBy("source", "lang").agg(F.sum("tokens").alias("tokens"))
    for budget in (0.2, 0.6, 1.0):
        got = calibrated(rake(cells, targets), budget).collect()
        expected = sum(c.tokens * c.probability for c in got) / sum(c.tokens for c in got)
        assert expected == pytest.approx(budget, abs=1e-6)
        assert all(0 <= c.probability <= 1 for c in got)
        open_ = [c.probability / c.weight for c in got if c.probability < 1]
        assert np.allclose(open_, open_[:1] * len(open_))
    kept = mix(docs, targets, 0.6).where("kept").agg(F.sum("tokens")).first()[0]
    assert kept / docs.agg(F.sum("tokens")).first()[0] == pytest.approx(0.6, abs=0.08)


def test_odd_rows(spark):
    rows = [(1, None, "en", "a", 5), (1, None, "en", "a", 5), (2, "s", None, "a", 0), (None, "s", "en", None, 7), (3, "t", "de", "a", 0)]
    docs = spark.createDataFrame(rows, SCHEMA).withColumn("cell", F.lit("x")).withColumn("fitted", F.lit(1))
    docs = docs.withColumn("cell_source", F.lit(2)).withColumn("row", F.lit(3)).withColumn("a.b", F.lit(4))
    got = mix(docs, {"source": 0.5, "lang": 1.0, "topic": 0.0}, 1.0)
    assert got.columns == [*docs.columns, "weight", "probability", "kept", "gap"]
    again = mix(docs.withColumn("weight", F.lit("w")).withColumn("kept", F.lit("k")), {"source": 0.5}, 1.0)
    assert again.columns == got.columns and again.schema["kept"].dataType.simpleString() == "boolean"
    kept = {(r.doc_id, r.kept) for r in got.collect()}
    assert got.count() == 5 and (1, True) in kept and (None, True) in kept and (3, True) not in kept
    assert mix(docs.limit(0), {"source": 0.5}, 0.5).count() == 0
    with pytest.raises(ValueError):
        mix(docs, {"source": 0.5}, 0)


def test_token_counts(spark):
    texts = [(None, 0), ("", 0), ("  ", 0), ("a", 1), (" a\tb\n c\x0bd  ", 4), ("a\xa0b", 1)]
    df = spark.createDataFrame(texts, "text string, n int")
    assert all(r.n == r.m for r in df.withColumn("m", n_tokens(F.col("text"))).collect())


def test_targets_that_cannot_hold_are_told(spark, monkeypatch):
    """Source a holds all of language x, so their targets contradict each other."""
    monkeypatch.setattr(mixing, "MOST_JOBS", 2)
    rows = [(1, "a", "x", "t", 10), (2, "b", "y", "t", 10)]
    targets = {"source": {"a": 0.9, "b": 0.1}, "lang": {"x": 0.2, "y": 0.8}}
    with pytest.warns(UserWarning, match="missed"):
        got = mix(spark.createDataFrame(rows, SCHEMA), targets, 1.0).collect()
    assert all(r.gap == pytest.approx(0.7) for r in got)
    held = mix(spark.createDataFrame(rows, SCHEMA), {"lang": {"x": 0.2, "y": 0.8}}, 1.0).collect()
    assert all(r.gap <= mixing.TOLERANCE for r in held)

"""Interval joins and look-ups as of a date against all pairs."""

import random
import time

import pytest
from pyspark.sql import functions as F

import scourline as sc
from scourline.functions import intervals
from scourline.functions.intervals import as_of, interval_counts, interval_join

NAN, INF = float("nan"), float("inf")


@pytest.mark.parametrize("bins", [1 << 10, 8])
def test_like_all_pairs(spark, monkeypatch, bins):
    monkeypatch.setattr(intervals, "BINS", bins)
    r = random.Random(bins)
    draw = lambda: r.choice([None, NAN, INF, -INF, -0.0, *[r.gauss(0, 9) for _ in range(8)], *map(float, range(-3, 4))])
    points = [(i, draw(), r.choice(["a", "b", None])) for i in range(400)]
    ranges = [(j, draw(), draw(), r.choice(["a", "b", None])) for j in range(120)] + [(900, 1.0, 1.0, "a"), (901, None, None, "a")]
    left = spark.createDataFrame(points, "i int, v double, k string")
    right = spark.createDataFrame(ranges, "j int, low double, high double, k string")

    def holds(v, low, high):
        return v is not None and v == v and (low is None or v >= low) and (high is None or v <= high)

    want = sorted((i, j) for i, v, _ in points for j, low, high, _ in ranges if holds(v, low, high))
    got = interval_join(left, right.drop("k"), "v", "low", "high").select("i", "j").collect()
    assert sorted(map(tuple, got)) == want
    want = sorted((i, j) for i, v, k in points for j, low, high, m in ranges if k == m and k and holds(v, low, high))
    got = interval_join(left, right, "v", "low", "high", on=["k"])
    assert got.columns == ["i", "v", "k", "j", "low", "high"]
    assert sorted((x.i, x.j) for x in got.collect()) == want
    assert interval_join(left, right.where("false"), "v", "low", "high", on=["k"]).count() == 0
    assert interval_join(left.where("false"), right, "v", "low", "high", on=["k"]).count() == 0


def test_wide_intervals_stay_few_rows(spark):
    """Nodes that cover an interval number at most twice the levels, and no pairs are made."""
    wide = spark.range(500).selectExpr("id AS j", "cast(id as double) AS low", "cast(100000 - id as double) AS high")
    points = spark.range(2000).selectExpr("id AS i", "cast(id * 50 as double) AS v")
    found = interval_join(points, wide, "v", "low", "high")
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan
    assert found.count() == sum(j <= i * 50 <= 100000 - j for i in range(2000) for j in range(500))


def test_rules_in_a_table(spark):
    rows = [("x", 1.0, 10), ("x", 5.0, None), ("y", NAN, 30), ("y", 7.0, 40), (None, 2.0, 10)]
    df = spark.createDataFrame(rows, "g string, a double, b int")
    rules = spark.createDataFrame(
        [(1, "a", 0.0, 5.0, "x"), (2, "a", None, 6.0, "y"), (3, "b", 10.0, None, "x"), (4, "b", 50.0, 60.0, "z"), (5, "b", 35.0, 40.0, "y")],
        "rule int, variable string, low double, high double, g string",
    )
    got = sorted(map(tuple, sc.validate_range_table(df, rules, by=["g"]).collect()))
    assert got == [(1, "a", 2, 2, True), (2, "a", 2, 0, False), (3, "b", 1, 1, True), (4, "b", 0, 0, True), (5, "b", 2, 1, False)]
    with pytest.raises(ValueError):
        sc.validate_range_table(df, rules.withColumn("variable", F.lit("none")), by=["g"])


def test_as_of(spark):
    known = spark.createDataFrame([("a", 1, 1.0), ("a", 5, 5.0), ("a", 7, None), ("b", 3, 3.0), (None, 1, 9.0)], "k string, t int, x double")
    wanted = [("a", 0), ("a", 1), ("a", 4), ("a", 6), ("a", 9), ("b", 2), ("b", 3), ("c", 5), (None, 5), ("a", None)]
    got = as_of(spark.createDataFrame(wanted, "k string, t int"), known, ["k"], "t", ["x"])
    want = [None, 1.0, 1.0, 5.0, None, None, 3.0, None, None, None]
    assert sorted(map(tuple, got.collect()), key=repr) == sorted(((*w, x) for w, x in zip(wanted, want)), key=repr)


def test_rates_as_of_a_year(spark):
    rates = spark.createDataFrame([(2018, "EUR", 1.5), (2020, "EUR", 2.0), (2021, "GBP", 3.0)], "year int, currency string, rate double")
    rows = [(1, 10.0, "EUR", 2017), (2, 10.0, "EUR", 2019), (3, 10.0, "EUR", 2025), (4, 10.0, "GBP", 2020), (5, None, "GBP", 2022), (6, 10.0, None, 2022), (7, 10.0, "EUR", None), (8, 10.0, "EUR", 2020)]
    df = spark.createDataFrame(rows, "i int, salary double, salary_currency string, work_year int")
    got = {r.i: r.salary_in_usd for r in sc.convert_currency_to_usd(df, exchange_rates=rates, as_of_year=True).collect()}
    assert got == {1: None, 2: 15.0, 3: 20.0, 4: None, 5: None, 6: None, 7: None, 8: 20.0}
    plain = {r.i: r.salary_in_usd for r in sc.convert_currency_to_usd(df, exchange_rates=rates).collect()}
    assert plain[2] is None and plain[8] == 20.0


@pytest.mark.parametrize("bins", [1 << 10, 8])
def test_counts_like_all_pairs(spark, monkeypatch, bins):
    monkeypatch.setattr(intervals, "BINS", bins)
    r = random.Random(bins)
    draw = lambda: r.choice([None, NAN, INF, -INF, -0.0, *[r.gauss(0, 9) for _ in range(8)], *map(float, range(-3, 4))])
    points = [(draw(), r.choice(["a", "b", None]), r.randrange(1, 9)) for _ in range(400)]
    ranges = [(j, draw(), draw(), r.choice(["a", "b", "c", None])) for j in range(120)]
    ranges += [(900, 0.0, -0.0, "a"), (901, None, None, "a"), (901, None, None, "a"), (None, 1.0, None, "b")]
    left = spark.createDataFrame(points, "v double, k string, w long")
    right = spark.createDataFrame(ranges, "j int, low double, high double, k string")
    got = interval_counts(left, right, "v", "low", "high", "w", ["k"])

    def holds(v, low, high):
        return v == v and (low is None or v >= low) and (high is None or v <= high)

    def of(j, low, high, k):
        group = [(v, w) for v, m, w in points if m == k and k and v is not None]
        return j, low, high, k, sum(w for _, w in group), sum(w for v, w in group if holds(v, low, high))

    assert got.columns == ["j", "low", "high", "k", "n_all", "n_inside"]
    assert sorted(map(str, map(tuple, got.collect()))) == sorted(str(of(*row)) for row in ranges)
    assert interval_counts(left, right.where("false"), "v", "low", "high", "w", ["k"]).count() == 0
    none = interval_counts(left.where("false"), right, "v", "low", "high", "w", ["k"])
    assert [tuple(x) for x in none.select("n_all", "n_inside").distinct().collect()] == [(0, 0)]


def test_rules_make_no_pairs(spark):
    """Wide rules over many values: 200 million pairs would not end in time."""
    df = spark.range(20_000).selectExpr("cast(id as double) as a")
    rules = spark.range(20_000).selectExpr("id as rule", "'a' as variable", "cast(id / 4 as double) as low", "cast(19999 - id / 4 as double) as high")
    found = sc.validate_range_table(df, rules)
    began = time.time()
    got = found.selectExpr("count(*)", "min(n_values)", "sum(n_inside)", "count_if(valid_mask)").first()
    assert time.time() - began < 60
    want = [sum(1 for _ in range(-(-i // 4), int(19999 - i / 4) + 1)) for i in range(20_000)]
    assert tuple(got) == (20_000, 20_000, sum(want), 1)

import itertools
import random

import pytest
from pyspark.sql import functions as F

import scourline as sc

ROWS = [(1, 1, "a"), (2, 1, "b"), (3, 2, "b"), (4, 3, "c"), (5, 3, "d"), (6, 3, "d"), (7, 4, "e")]


@pytest.fixture
def df(spark):
    return spark.createDataFrame(ROWS, "pos int, a int, b string")


def kept(out, column="a"):
    return [r[column] for r in out.orderBy("pos").collect()]


def test_keep_first_and_drop_all(df):
    assert kept(sc.deduplicate_rows(df, "drop_all", ["a"])) == [2, 4]
    first = sc.deduplicate_rows(df, "keep_first", ["a"], order_by=["pos"])
    assert kept(first, "pos") == [1, 3, 4, 7]
    last = sc.keep_first(df, ["a"], order_by=[F.col("pos").desc()])
    assert kept(last, "pos") == [2, 3, 6, 7]
    with pytest.raises(ValueError, match="order_by"):
        sc.keep_first(df, ["a"])
    assert sc.keep_first(df.drop("pos"), ["b", "a"]).count() == 6  # all columns


def test_protected_rows(spark, df):
    assert kept(sc.drop_all(df, ["a"], protect=F.col("pos") == 1)) == [1, 2, 4]
    by_value = sc.drop_all(df, ["a"], protect_col="a", protect_values=[3])
    assert kept(by_value) == [2, 3, 3, 3, 4]
    keys = spark.createDataFrame([(1,)], "pos int")
    assert kept(sc.drop_all(df, ["a"], protect_keys=keys)) == [1, 2, 4]
    both = sc.drop_all(df, ["a"], protect=F.col("pos") == 5, protect_keys=keys)
    assert kept(both, "pos") == [1, 3, 5, 7]
    # A protected row counts as seen, an earlier one or a later one.
    first = sc.keep_first(df, ["a"], order_by=["pos"], protect=F.col("pos") == 6)
    assert kept(first, "pos") == [1, 3, 4, 6, 7]


def test_null_condition_protects_nothing(spark):
    df = spark.createDataFrame([(1, 1, None), (2, 1, "x")], "pos int, a int, b string")
    out = sc.drop_all(df, ["a"], protect_col="b", protect_values=["x"])
    assert kept(out, "pos") == [2]


def test_nulls_and_nan_equal_themselves(spark):
    nan = float("nan")
    rows = [(1, None), (2, None), (3, nan), (4, nan), (5, 1.0)]
    df = spark.createDataFrame(rows, "pos int, a double")
    assert kept(sc.drop_all(df, ["a"]), "pos") == [5]
    assert kept(sc.keep_first(df, ["a"], order_by=["pos"]), "pos") == [1, 3, 5]


def test_whole_rows(spark):
    df = spark.createDataFrame([(1, 10), (1, 10), (2, 20), (3, 30), (3, 30)], "id int, x int")
    assert sorted(r["id"] for r in sc.deduplicate_rows(df).collect()) == [1, 2, 3]
    assert [r["id"] for r in sc.drop_all(df).collect()] == [2]


def test_errors(df):
    with pytest.raises(ValueError, match="mode"):
        sc.deduplicate_rows(df, "keep_last")
    with pytest.raises(ValueError, match="Column z"):
        sc.keep_first(df, ["z"])


def brute_force(rows, mode, protected):
    seen, counts, out = set(), {}, []
    for _, a, _ in rows:
        counts[a] = counts.get(a, 0) + 1
    for pos, a, b in rows:
        if mode == "keep_first":
            stays, _ = a not in seen, seen.add(a)
        else:
            stays = counts[a] == 1
        if stays or protected(b):
            out.append(pos)
    return out


@pytest.mark.parametrize("mode", ["keep_first", "drop_all"])
def test_against_brute_force(spark, mode):
    rng = random.Random(5)
    rows = [(i, rng.choice([1, 1, 1, *range(2, 40)]), rng.choice("xyz")) for i in range(300)]
    df = spark.createDataFrame(rows, "pos int, a int, b string").repartition(5)
    for protect in (None, "x"):
        out = sc.deduplicate_rows(
            df, mode, ["a"], order_by=["pos"],
            protect=None if protect is None else F.col("b") == protect,
        )
        assert kept(out, "pos") == brute_force(rows, mode, lambda b: b == protect)


def test_hot_key_is_cut_before_the_shuffle(spark):
    df = spark.range(10).selectExpr("id % 3 as a", "id as pos")
    for out in (
        sc.keep_first(df, ["a"], order_by=["pos"]),
        sc.drop_all(df, ["a"]),
        sc.keep_first(df, ["a"], order_by=["pos"], protect=F.col("pos") == 1),
    ):
        plan = out._jdf.queryExecution().executedPlan().toString()
        before = plan.split("Exchange hashpartitioning", 1)[1]
        assert "WindowGroupLimit" in before and "Partial" in before
    assert list(itertools.chain(df.columns)) == ["a", "pos"]

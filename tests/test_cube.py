from collections import defaultdict
from itertools import product

import pytest

import scourline as sc


def brute(rows, names, dims, columns):
    cells = defaultdict(list)
    for row in rows:
        for up in product([0, 1], repeat=len(dims)):
            level = sum(u << (len(dims) - 1 - i) for i, u in enumerate(up))
            key = tuple(None if u else row[names.index(d)] for u, d in zip(up, dims))
            for column in columns:
                cells[(*key, level, column)].append(row[names.index(column)])
    return {
        (*key, len(v), sum(x is None for x in v), len({x for x in v if x is not None}))
        for key, v in cells.items()
    }


def test_cube_equals_brute_force(spark):
    names = ["a", "b", "c", "x", "s"]
    rows = [
        (i % 3, None if i % 4 == 0 else "pq"[i % 2], i % 2 == 0, float(i % 50), None if i % 6 == 0 else f"v{i % 777}")
        for i in range(3000)
    ]
    df = spark.createDataFrame(rows, "a int, b string, c boolean, x double, s string")
    found = sc.quality_cube(df, ["a", "b", "c"])
    assert found.columns == ["a", "b", "c", "level", "column", "n_rows", "n_nulls", "n_distinct"]
    assert set(map(tuple, found.collect())) == brute(rows, names, ["a", "b", "c"], ["x", "s"])


def test_more_values_than_a_bitmap_holds(spark):
    df = spark.range(200_000).selectExpr("id % 2 as half", "id div 2 as v")
    found = {(r["half"], r["level"]): r["n_distinct"] for r in sc.quality_cube(df, ["half"]).collect()}
    assert found == {(0, 0): 100_000, (1, 0): 100_000, (None, 1): 100_000}


def test_cube_odd_tables(spark):
    df = spark.createDataFrame([(1, 0.0), (1, -0.0), (None, float("nan"))], "d int, x double")
    found = {tuple(r) for r in sc.quality_cube(df, ["d"]).collect()}
    assert found == {(1, 0, "x", 2, 0, 1), (None, 0, "x", 1, 0, 1), (None, 1, "x", 3, 0, 2)}
    # A dimension may be counted as well, and there may be none.
    assert {tuple(r) for r in sc.quality_cube(df, ["d"], ["d"]).collect()} == {
        (1, 0, "d", 2, 0, 1), (None, 0, "d", 1, 1, 0), (None, 1, "d", 3, 1, 1)
    }
    assert {tuple(r) for r in sc.quality_cube(df, [], ["x"]).collect()} == {(0, "x", 3, 0, 2)}
    assert sc.quality_cube(df.limit(0), ["d"]).count() == 0
    with pytest.raises(ValueError, match="names of the result"):
        sc.quality_cube(df.withColumnRenamed("d", "level"), ["level"])


def test_rows_are_not_repeated_for_each_subset(spark):
    plan = sc.quality_cube(spark.range(10).selectExpr("id % 2 as a", "id % 3 as b", "id as v"), ["a", "b"])
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert "Expand" not in text and "bitmap_or_agg" in text

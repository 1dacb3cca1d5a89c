from collections import Counter

import pytest

import scourline as sc

SCHEMA = "k int, j string, x double, s string"


def brute(before, after, keys, names):
    """Cells and rows counted in plain Python."""
    def cells(rows):
        return Counter((tuple(r[k] for k in keys), c, r[c]) for r in rows for c in names)

    def whole(rows):
        return Counter((tuple(r[k] for k in keys), tuple(r[c] for c in names)) for r in rows)

    one, two = cells(before), cells(after)
    found = {(*c, one[c], two[c]) for c in one.keys() | two.keys() if one[c] != two[c]}
    lost, new = Counter(), Counter()
    for row, n in (whole(before) - whole(after)).items():
        lost[row[0]] += n
    for row, n in (whole(after) - whole(before)).items():
        new[row[0]] += n
    return found | {(k, None, None, lost[k], new[k]) for k in lost.keys() | new.keys()}


def listed(df, keys):
    return {(tuple(r[k] for k in keys), r["column"], r["value"], r["n_before"], r["n_after"]) for r in df.collect()}


def test_diff_equals_brute_force(spark):
    rows = [(k % 7 if k % 11 else None, "ab"[k % 2], None if k % 5 == 0 else float(k % 3), "xyz"[k % 3]) for k in range(300)]
    later = [r if i % 9 else (r[0], r[1], 5.0, None) for i, r in enumerate(rows) if i % 31] + rows[:4]
    before, after = spark.createDataFrame(rows, SCHEMA), spark.createDataFrame(later, SCHEMA)
    found = sc.cleaning_diff(before, after, ["k", "j"])
    assert found.columns == ["k", "j", "column", "value", "n_before", "n_after"]
    text = [[{**r.asDict(), "x": None if r["x"] is None else str(r["x"])} for r in df.collect()] for df in (before, after)]
    got = listed(found, ["k", "j"])
    assert got == brute(*text, ["k", "j"], ["x", "s"])
    assert found.count() == len(got) > 20


def test_swapped_values_and_nulls_are_seen(spark):
    before = spark.createDataFrame([(1, "a", 1.0, "p"), (1, "a", 2.0, "q"), (2, "b", None, "z")], SCHEMA)
    after = spark.createDataFrame([(1, "a", 2.0, "p"), (1, "a", 1.0, "q"), (2, "b", None, "z")], SCHEMA)
    assert listed(sc.cleaning_diff(before, after, ["k"]), ["k"]) == {((1,), None, None, 2, 2)}
    shifted = spark.createDataFrame([("v", None, 1), (None, "v", 2)], "a string, b string, k int")
    other = spark.createDataFrame([(None, "v", 1), (None, "v", 2)], "a string, b string, k int")
    assert len(listed(sc.cleaning_diff(shifted, other, ["k"]), ["k"])) == 5


def test_diff_odd_tables(spark):
    rows = spark.createDataFrame([(1, "a", 1.0, "p"), (1, "a", 1.0, "p")], SCHEMA)
    empty = spark.createDataFrame([], SCHEMA)
    assert sc.cleaning_diff(rows, rows, ["k"]).count() == 0
    assert sc.cleaning_diff(empty, empty, ["k"]).count() == 0
    assert listed(sc.cleaning_diff(rows.select("k"), empty.select("k"), ["k"]), ["k"]) == {((1,), None, None, 2, 0)}
    # Another type is another spelling only where the text differs.
    whole = rows.selectExpr("k", "cast(x as int) as x")
    assert listed(sc.cleaning_diff(rows.select("k", "x"), whole, ["k"]), ["k"]) == {
        ((1,), "x", "1.0", 2, 0), ((1,), "x", "1", 0, 2), ((1,), None, None, 2, 2)
    }
    with pytest.raises(ValueError, match="names of the result"):
        sc.cleaning_diff(rows.withColumnRenamed("k", "value"), rows.withColumnRenamed("k", "value"), ["value"])
    with pytest.raises(ValueError, match="key"):
        sc.cleaning_diff(rows, rows, [])

import math

import pytest

import scourline as sc
from scourline.functions import is_ordered, levels_of
from scourline.functions.levels import with_levels
from pyspark.sql import functions as F

MIXED = [(7.5, "oak", False), (None, None, None), (8.5, "oak", None), (9.5, "elm", False)]
MIXED_DDL = "height double, tree string, felled boolean"


@pytest.fixture
def mixed(spark):
    return spark.createDataFrame(MIXED, MIXED_DDL).coalesce(1)


def column(df, name):
    return [r[name] for r in df.collect()]


def one(spark, values, kind, levels=None, ordered=False, **options):
    df = spark.createDataFrame([(v,) for v in values], f"x {kind}").coalesce(1)
    if levels:
        df = df.select(with_levels(F.col("x"), "x", levels, ordered))
    out = sc.impute_missing(df, **options)
    return dict(out.dtypes)["x"], column(out, "x"), levels_of(out, "x")


def test_defaults(mixed):
    out = sc.impute_missing(mixed)
    assert column(out, "height") == [7.5, 8.5, 8.5, 9.5]
    assert column(out, "tree") == ["oak", "oak", "oak", "elm"]
    assert column(out, "felled") == [False] * 4


def test_selection(mixed):
    out = sc.impute_missing(mixed, cols=["height", "felled"])
    assert column(out, "tree")[1] is None and column(out, "height")[1] == 8.5
    assert column(sc.impute_missing(mixed, cols="tree"), "height")[1] is None
    assert column(sc.impute_missing(mixed, exclude=["height"]), "height")[1] is None
    with pytest.raises(ValueError, match="Column y not found"):
        sc.impute_missing(mixed, cols=["y"])
    with pytest.raises(ValueError, match="imputation method"):
        sc.impute_missing(mixed, num_method="median")


def test_numbers(spark):
    mean = sc.NumMean()
    assert one(spark, [1.0, None, 4.0, 4.0], "double", num_method=mean)[1][1] == 3.0
    assert one(spark, [1, None, 4], "int") == ("double", [1.0, 2.5, 4.0], None)
    assert one(spark, [1, 2], "int") == ("int", [1, 2], None)
    assert one(spark, [None, None], "double") == ("double", [None, None], None)
    zero = sc.NumConstant(0.0)
    assert one(spark, [None, 2.0, None], "double", num_method=zero)[1] == [0.0, 2.0, 0.0]
    assert one(spark, [None, 2], "int", num_method=zero) == ("int", [0, 2], None)
    assert one(spark, [None, None], "int", num_method=zero)[1] == [0, 0]
    with pytest.raises(ValueError, match="does not fit column x of type int"):
        one(spark, [None, 2], "int", num_method=sc.NumConstant(1.5))
    assert one(spark, [1.0, None], "float")[0] == "float"
    assert math.isnan(one(spark, [1.0, float("nan"), None], "double")[1][2])


def test_text(spark):
    unknown = sc.CatConstant("unknown")
    assert one(spark, ["a", None, "b", None], "string", cat_method=unknown)[1] == [
        "a", "unknown", "b", "unknown"
    ]
    assert one(spark, ["b", None, "a"], "string")[1][1] == "a"
    assert one(spark, ["b", None, "a", "b"], "string")[1][1] == "b"
    assert one(spark, [None], "string")[1] == [None]


def test_categories(spark):
    assert one(spark, ["a", None, "a", "b"], "string", ["a", "b"])[1:] == (
        ["a", "a", "a", "b"], ["a", "b"]
    )
    # A tie goes to the first level, not to the smallest text.
    assert one(spark, ["L", None, "S"], "string", ["S", "M", "L"], True)[1][1] == "S"
    new = sc.CatNewLevel("NA")
    assert one(spark, ["a", None, "b", None], "string", ["a", "b"], cat_method=new)[1:] == (
        ["a", "NA", "b", "NA"], ["a", "b", "NA"]
    )
    const = sc.CatConstant("b")
    assert one(spark, ["a", None], "string", ["a", "b"], cat_method=const)[2] == ["a", "b"]
    assert one(spark, [None, None], "string", ["a", "b"])[1] == [None, None]
    df = spark.createDataFrame([("S",), (None,)], "x string")
    ordered = df.select(with_levels(F.col("x"), "x", ["S", "M"], True))
    assert is_ordered(sc.impute_missing(ordered), "x")


def test_booleans(spark):
    assert one(spark, [True, False, None, None], "boolean")[1] == [True, False, True, True]
    assert one(spark, [False, False, True, None], "boolean")[1][3] is False
    assert one(spark, [None], "boolean")[1] == [None]


def test_other_types_and_known_values_stay(spark):
    df = spark.sql("select cast(null as date) as d, array(1) as a union all select null, null")
    assert sorted(map(str, sc.impute_missing(df).collect())) == sorted(map(str, df.collect()))


def test_report(mixed):
    report = sc.impute_report(
        mixed, sc.impute_missing(mixed, exclude=["tree"]), num_method=sc.NumMean()
    )
    assert sorted(map(tuple, report.collect())) == [
        ("felled", 2, 0, "BoolMajority"), ("height", 1, 0, "NumMean"), ("tree", 1, 1, "CatMode")
    ]


def test_constants_fit_their_column(spark):
    df = spark.createDataFrame([(None,), (1,)], "x int").withColumn(
        "price", F.col("x").cast("decimal(10,2)")
    )
    out = sc.impute_missing(df, cols=["price"], num_method=sc.NumConstant(1.25))
    assert sorted(map(str, column(out, "price"))) == ["1.00", "1.25"]
    for name, value in (("price", 1.239), ("price", 1e9), ("x", 2**31), ("x", 0.5)):
        with pytest.raises(ValueError, match=f"does not fit column {name}"):
            sc.impute_missing(df, cols=[name], num_method=sc.NumConstant(value))


def test_ties_of_modes(spark):
    values = ["b", "a", None, "b", "a", "c"]
    assert one(spark, values, "string", cat_method=sc.CatMode())[1][2] == "a"
    levels = one(spark, values, "string", ["c", "b", "a"], cat_method=sc.CatMode())
    assert levels[1][2] == "b"


def test_modes_among_very_many_values(spark, monkeypatch):
    """Sketched candidates settle skewed columns; single and tied values are counted in full."""
    from scourline.operators import heavy, impute

    monkeypatch.setattr(impute, "MANY_VALUES", 50)
    monkeypatch.setattr(heavy, "TRACKED", 256)
    rows = []
    for i in range(6000):
        skewed = "often" if i % 20 == 0 else f"v{i}"
        tied = ["b", "a"][i % 2] if i % 10 < 2 else f"w{i}"
        few = f"x{i % 7}" if i % 7 else "x1"
        rows.append((skewed if i % 3 else None, tied if i % 11 else None, f"u{i // 2}" if i % 13 else None, few if i % 5 else None))
    df = spark.createDataFrame(rows, "skewed string, tied string, pairs string, few string").repartition(5)

    def mode(k):
        seen = {}
        for r in rows:
            if r[k] is not None:
                seen[r[k]] = seen.get(r[k], 0) + 1
        most = max(seen.values())
        return min(v for v, n in seen.items() if n == most)

    settled = heavy.most_frequent(df, df.columns)
    assert settled["skewed"] == ["often"] and min(settled["tied"]) == mode(1) and "pairs" not in settled
    assert heavy.most_frequent(df.where("false"), df.columns) == {}
    filled = sc.impute_missing(df.withColumn("at", F.monotonically_increasing_id()))
    for k, name in enumerate(df.columns):
        got = filled.groupBy(name).count().collect()
        want, usual = {}, mode(k)
        for r in rows:
            v = usual if r[k] is None else r[k]
            want[v] = want.get(v, 0) + 1
        assert {r[name]: r["count"] for r in got} == want

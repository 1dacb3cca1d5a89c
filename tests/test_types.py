import math

import pytest
from pyspark.sql import functions as F

import scourline as sc
from scourline.functions import levels_of, number_sql, snake_case


def typed(spark, values, **options):
    df = spark.createDataFrame([(v,) for v in values], "x string").coalesce(1)
    out = sc.enforce_types(df, **options)
    return dict(out.dtypes)["x"], [r["x"] for r in out.collect()], levels_of(out, "x")


def test_mixed_table(spark):
    df = spark.createDataFrame(
        list(
            zip(
                ["17", "18", None, "?", "19", "18"],
                ["fir", "elm", "elm", "yew", "fir", "elm"],
                ["30", "\t", "31", "", "32", "33"],
            )
        ),
        "a string, b string, c string",
    ).coalesce(1)
    out = sc.enforce_types(df)
    assert levels_of(out, "a") == ["17", "18", "19", "?"]
    assert levels_of(out, "b") == ["elm", "fir", "yew"]
    assert dict(out.dtypes)["c"] == "bigint"
    assert [r["c"] for r in out.collect()] == [30, None, 31, None, 32, 33]


def test_numbers(spark):
    assert typed(spark, ["1.5", "\t2 ", None]) == ("double", [1.5, 2.0, None], None)
    assert typed(spark, ["1e3", "-2.", "+.0"]) == ("bigint", [1000, -2, 0], None)
    kind, found, _ = typed(spark, ["1", "NaN", "-inf"])
    assert kind == "double" and math.isnan(found[1]) and found[2] == -math.inf
    assert typed(spark, ["1", "1e300"])[0] == "double"
    assert typed(spark, ["1", "9223372036854775808"])[0] == "double"


def test_nine_in_ten_are_numbers(spark):
    nine = [str(i) for i in range(9)]
    assert typed(spark, [*nine, "n/a"]) == ("bigint", [*range(9), None], None)
    assert typed(spark, [*nine, "n/a", "?"])[0] == "string"
    assert typed(spark, ["1", "x"], num_threshold=0.5)[0] == "bigint"


@pytest.mark.parametrize("text", ["1d", "12D", "1f", "0x1p3", "1_000", "1,5", "--1", "e5", "."])
def test_not_numbers(spark, text):
    df = spark.createDataFrame([(text,)], "t string")
    assert df.selectExpr(number_sql("t")).first()[0] is None


def test_level_limit(spark):
    few, many = [f"v{i:02}" for i in range(20)], [f"v{i:02}" for i in range(21)]
    assert typed(spark, few)[2] == few
    assert typed(spark, few + ["", None])[2] == ["", *few]
    assert typed(spark, many)[2] is None
    assert typed(spark, many, max_factor_levels=21)[2] == many
    assert typed(spark, ["a", "b"], max_factor_levels=1)[2] is None
    # Few hash buckets can hold many values; the listing then decides.
    assert typed(spark, [f"w{i}" for i in range(400)], max_factor_levels=300)[2] is None


def test_text_is_stripped_and_blanks_stay(spark):
    text = [f" \t name {i}　" for i in range(30)]
    kind, found, levels = typed(spark, [*text, "  ", None])
    assert (kind, levels) == ("string", None)
    assert found == [*[f"name {i}" for i in range(30)], "", None]


def test_other_columns_stay(spark):
    df = spark.sql(
        """select 1 as i, true as b, date'2020-01-02' as d, cast(null as string) as n,
        '  ' as blank, array('x') as a, timestamp_ntz'2020-01-02 03:04:05' as t"""
    )
    out = sc.enforce_types(df)
    assert out.dtypes == df.dtypes
    assert out.first()["blank"] == "  "
    as_text = sc.enforce_types(df, stringify_temporal=True)
    assert levels_of(as_text, "d") == ["2020-01-02"]
    assert levels_of(as_text, "t") == ["2020-01-02T03:04:05"]
    again = sc.enforce_types(sc.enforce_types(as_text))
    assert levels_of(again, "d") == ["2020-01-02"]


def test_profile(spark):
    df = spark.createDataFrame(
        [(" 1", None), ("1", None), ("x", None), ("", None), (None, None)],
        "a string, b string",
    )
    rows = {r["column"]: tuple(r)[1:] for r in sc.type_profile(df).collect()}
    assert rows == {"a": (3, 2, 2), "b": (0, 0, 0)}


def test_snake_case_values(spark):
    df = spark.createDataFrame([("  My Col (1) ",), ("SALAIRE (€)",)], "t string")
    assert [r[0] for r in df.select(snake_case(F.col("t"))).collect()] == ["my_col_1", "salaire"]

import pytest

import scourline as sc


def lines(spark, *texts):
    return spark.createDataFrame([(t,) for t in texts], "line string")


def test_types_of_all_lines_together(spark):
    df = lines(
        spark,
        '{"id": 1, "v": 1, "ok": true, "who": {"name": "a", "age": 3}, "tags": [1, 2]}',
        '{"id": 2, "v": 2.5, "mixed": 1, "who": {"name": "NA"}, "empty": null, "none": {}}',
        '{"id": 9007199254740993, "mixed": "one", "tags": [1.5], "who": null}',
        "  ", None,
    )
    out = sc.import_json_lines(df, missing_strings=["NA"])
    assert dict(out.dtypes) == {
        "id": "bigint", "v": "double", "ok": "boolean", "who_age": "bigint", "who_name": "string",
        "tags": "array<double>", "mixed": "string", "empty": "string", "none": "string",
    }
    rows = {r["id"]: r.asDict() for r in out.collect()}
    assert len(rows) == 3 and 9007199254740993 in rows
    assert rows[1]["who_name"] == "a" and rows[2]["who_name"] is None and rows[2]["v"] == 2.5
    assert rows[1]["v"] == 1.0 and rows[1]["tags"] == [1.0, 2.0] and rows[1]["mixed"] is None
    assert rows[2]["mixed"] == "1" and rows[9007199254740993]["mixed"] == "one"


def test_arrays_of_objects_and_mixed_arrays(spark):
    out = sc.import_json_lines(lines(spark, '{"a": [{"x": 1}, {"y": "t"}], "b": [1, "t"]}'))
    row = out.first()
    assert [tuple(x) for x in row["a"]] == [(1, None), (None, "t")]
    assert row["b"] == ["1", "t"]


def test_odd_names(spark):
    out = sc.import_json_lines(lines(spark, '{"a b": 1, "x.y": 2, "OBJECT": {"it`s": 3}, "o_p": 4, "o": {"p": 5}, "é": 6}'))
    assert sorted(out.columns) == sorted(["a b", "x.y", "OBJECT_it`s", "o_p", "o_p_1", "é"])
    assert sorted(out.first()) == [1, 2, 3, 4, 5, 6]


def test_malformed_lines(spark):
    for bad in ("{broken", "3", "null", "[1]", '{"a": 1, "a": 2}'):
        df = lines(spark, '{"a": 1}', bad)
        with pytest.raises(Exception, match="Not a JSON object"):
            sc.import_json_lines(df)
        assert [tuple(r) for r in sc.import_json_lines(df, malformed="drop").collect()] == [(1,)]
    with pytest.raises(ValueError, match="empty"):
        sc.import_json_lines(lines(spark, " "))
    with pytest.raises(ValueError, match="no fields"):
        sc.import_json_lines(lines(spark, "{}"))
    with pytest.raises(ValueError, match="Unknown way"):
        sc.import_json_lines(lines(spark, "{}"), malformed="skip")


def test_joins_the_cleaning_steps(spark):
    df = lines(spark, *[f'{{"work_year": 2022, "salary": {k}, "salary_currency": "EUR"}}' for k in (10, 20)])
    out = sc.convert_currency_to_usd(sc.import_json_lines(df))
    assert sorted(round(r["salary_in_usd"], 6) for r in out.collect()) == [9.5, 19.0]

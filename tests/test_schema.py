import pytest

from pyspark.sql import functions as F

import scourline as sc

SALARY_DDL = """work_year int, experience_level string, employment_type string,
    job_title string, salary int, salary_currency string, salary_in_usd int,
    employee_residence string, remote_ratio int, company_location string,
    company_size string"""
SALARIES = [
    (2023, "MI", "FT", "Data Scientist", 50000, "USD", 50000, "US", 0, "US", "M"),
    (2023, "SE", "FT", "ML Engineer", 75000, "EUR", 82000, "FR", 50, "FR", "L"),
    (2024, "EN", "CT", "Analyst", 45000, "GBP", 58000, "UK", 100, "UK", "S"),
    (2024, "EX", "FL", "Director", 120000, "USD", 120000, "US", 25, "US", "M"),
]


def test_required_columns(spark):
    df = spark.createDataFrame([(1, 2)], "a int, b int")
    assert sc.validate_schema(df, ["a", "b"]) is True
    assert sc.validate_schema(df, ("a", "b")) is True
    with pytest.raises(ValueError, match="Missing required columns: c, d"):
        sc.validate_schema(df, ["a", "c", "b", "d"])
    assert sc.validate_schema(df, ["a", "b", "c"], strict=False) == ["c"]
    assert sc.missing_columns(df, ["A", "b"]) == ["A"]


def test_salary_contract(spark):
    df = spark.createDataFrame(SALARIES, SALARY_DDL)
    assert sc.salary_table(df) is df
    with pytest.raises(ValueError, match="Missing required columns: work_year"):
        sc.salary_table(df.drop("work_year"))


def test_standard_names(spark):
    df = spark.createDataFrame([(1, 10)], "`  My Col (1) ` int, `SALAIRE (€)` int")
    assert sc.standardize_colnames(df).columns == ["my_col_1", "salaire"]
    accents = spark.createDataFrame([(1, 2)], "`Été--Prix__x` int, `É²` int")
    assert sc.standardize_colnames(accents).columns == ["été_prix_x", "é²"]


def test_standard_names_of_many_and_collisions(spark):
    one = spark.createDataFrame([(1,)], "`My Col` int")
    two = spark.createDataFrame([(1,)], "`Other Col` int")
    named = sc.standardize_colnames([one, two])
    assert [d.columns for d in named] == [["my_col"], ["other_col"]]
    with pytest.raises(ValueError, match="collide"):
        sc.standardize_colnames(spark.createDataFrame([(1, 2)], "`a b` int, `A-B` int"))
    with pytest.raises(ValueError, match="Nothing is left"):
        sc.standardize_colnames(spark.createDataFrame([(1,)], "`€` int"))


def test_names_with_dots_survive_every_step(spark):
    df = spark.createDataFrame(
        [(1.0, "a"), (None, "a"), (3.0, None)], "`a.b` double, `c d` string"
    )
    out = sc.impute_missing(sc.enforce_types(sc.keep_first(df, ["a.b"], order_by=[F.col("`c d`")])))
    out = sc.winsorize(out)
    assert sorted(out.collect()) == [(1.1, "a"), (2.0, "a"), (2.9, "a")]

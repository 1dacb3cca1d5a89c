import pytest
from pyspark.sql import functions as F

import scourline as sc

DDL = "salary int, salary_currency string, work_year int"


def usd(spark, rows, ddl=DDL, **options):
    df = spark.createDataFrame(rows, ddl).coalesce(1)
    return [r["salary_in_usd"] for r in sc.convert_currency_to_usd(df, **options).collect()]


def test_rates_by_year_and_currency(spark):
    rows = [
        (50000, "EUR", 2022), (60000, "GBP", 2022), (70000, "USD", 2023),
        (None, "CAD", 2021), (60000, "XYZ", 2022), (1, "USD", 2024), (1, None, 2022),
        (1, "USD", None), (1, "usd", 2022), (50000, "EUR", 2020), (50000, "EUR", 2023),
    ]
    assert usd(spark, rows) == [
        47500.0, 45600.0, 70000.0, None, None, None, None, None, None, 44000.0, 46000.0
    ]


def test_year_of_another_type(spark):
    rows = [(100, "USD", "2022"), (100, "USD", "x"), (100, "USD", "2022.5")]
    ddl = "salary int, salary_currency string, work_year string"
    assert usd(spark, rows, ddl) == [100.0, None, None]
    rows = [(100, "USD", 2022.0), (100, "USD", 2022.5)]
    assert usd(spark, rows, ddl.replace("work_year string", "work_year double")) == [100.0, None]


def test_columns_and_order(spark):
    df = spark.createDataFrame(
        [(1.5, 1, 100, "EUR", 2022)],
        "rate double, salary_in_usd int, salary int, salary_currency string, work_year int",
    )
    out = sc.convert_currency_to_usd(df)
    assert out.columns == df.columns
    assert tuple(out.first()) == (1.5, 95.0, 100, "EUR", 2022)
    renamed = spark.createDataFrame(
        [(50000, "EUR", 2022)], "mon_salaire int, ma_devise string, annee int"
    )
    out = sc.convert_currency_to_usd(renamed, "mon_salaire", "ma_devise", "annee", "salaire_usd")
    assert out.first()["salaire_usd"] == 47500.0


def test_custom_rates(spark):
    rates = spark.createDataFrame(
        [(2022, "EUR", 2.0), (2022, "GBP", 3.0)], "year int, currency string, rate double"
    )
    rows = [(100, "EUR", 2022), (100, "GBP", 2022)]
    assert usd(spark, rows, exchange_rates=rates) == [200.0, 300.0]
    with pytest.raises(ValueError, match="repeated keys"):
        usd(spark, rows, exchange_rates=rates.union(rates))


def test_absent_columns(spark):
    df = spark.createDataFrame([(1,)], "salary int")
    with pytest.raises(ValueError, match="Column salary_currency not found in DataFrame"):
        sc.convert_currency_to_usd(df)


def test_one_broadcast_join_and_no_shuffle(spark):
    df = spark.range(10).selectExpr(
        "id as salary", "if(id < 5, 'EUR', 'GBP') as salary_currency", "2020 + id as work_year"
    )
    plan = sc.convert_currency_to_usd(df)._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "Exchange hashpartitioning" not in plan


def test_rates_table(spark):
    rates = sc.exchange_rates(spark)
    assert rates.dtypes == [("year", "int"), ("currency", "string"), ("rate", "double")]
    assert rates.count() == 164 and rates.select("currency").distinct().count() == 41
    usd_rates = rates.where("currency = 'USD'").agg(F.min("rate"), F.max("rate")).first()
    assert tuple(usd_rates) == (1.0, 1.0)

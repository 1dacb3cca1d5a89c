import scourline as sc


def test_cleaning_report(spark):
    before = spark.createDataFrame(
        [(1, 1.0, None), (1, 2.0, "a"), (2, None, "a"), (3, 9.0, "b")], "k int, x double, s string"
    )
    after = sc.impute_missing(sc.drop_all(before, ["k"]))
    report = sc.cleaning_report(before, after, {"x": (1.5, 5.0)})
    assert sorted(map(tuple, report.collect())) == [
        ("k", 4, 2, 0, 0, None), ("s", 4, 2, 1, 0, None), ("x", 4, 2, 1, 0, 2)
    ]


def test_usd_check(spark):
    df = spark.createDataFrame(
        [(100, "EUR", 2022, 96.0), (100, "EUR", 2022, 120.0), (100, "XYZ", 2022, 1.0), (1, "USD", 2020, None)],
        "salary int, salary_currency string, work_year int, salary_in_usd double",
    ).coalesce(1)
    out = sc.check_usd(df)
    assert out.columns == [*df.columns, "usd_consistent"]
    assert [r["usd_consistent"] for r in out.collect()] == [True, False, None, None]

import pytest

import scourline as sc
from scourline.functions import is_ordered, levels_of
from scourline.sources.scratch import scratch_root

DDL = "x_num double, x_str string, x_bool boolean"


def rows(df, *columns):
    return sorted(map(tuple, df.select(*columns or df.columns).collect()), key=repr)


def test_minimal(spark):
    df = spark.createDataFrame([(2020, 100.0), (2021, 200.0)], "work_year int, salary double")
    out = sc.pipeline(df, "minimal")
    assert out.dtypes == df.dtypes and rows(out) == rows(df)
    raw = spark.createDataFrame([("1",), ("2",)], "`My Col` string")
    out = sc.pipeline(raw, "minimal", required_columns=["My Col"])
    assert out.dtypes == [("my_col", "bigint")]
    with pytest.raises(ValueError, match="Missing required columns: my_col"):
        sc.pipeline(raw, "minimal", required_columns=["my_col"])
    sc.pipeline(raw, "minimal", required_columns=["my_col"], strict=False)


def test_light_clean(spark):
    df = spark.createDataFrame([(1.0, "a", True), (None, None, None), (3.0, "b", False)], DDL)
    out = sc.pipeline(
        df, "light_clean", num_method=sc.NumMean(), cat_method=sc.CatConstant("z"),
        bool_method=sc.BoolMajority(),
    )
    assert rows(out) == [(1.0, "a", True), (2.0, "z", True), (3.0, "b", False)]
    assert levels_of(out, "x_str") == ["a", "b", "z"]


def test_duplicates(spark):
    df = spark.createDataFrame(
        [(1, 10), (1, 10), (2, 20), (3, 30), (3, 30)], "id int, x int"
    )
    assert rows(sc.pipeline(df, "light_clean"), "id") == [(1,), (2,), (3,)]
    assert rows(sc.pipeline(df, "no_impute", dedup_mode="drop_all"), "id") == [(2,)]
    by_id = sc.pipeline(df, "no_impute", dedup_by=["id"], order_by=["x"])
    assert rows(by_id, "id") == [(1,), (2,), (3,)]


def test_strict_clean(spark):
    df = spark.createDataFrame([("a",), (None,), ("b",), ("c",)], "x_str string")
    out = sc.pipeline(df, "strict_clean")
    assert rows(out) == [("NA",), ("a",), ("b",), ("c",)]
    numbers = spark.createDataFrame([(i, i) for i in (1, 2, 3, 100, 200)], "k int, v int")
    assert rows(sc.pipeline(numbers, "strict_clean"), "v")[0] == (1.2,)


def test_ml_ready_sizes(spark):
    df = spark.createDataFrame([("S",), ("M",), ("L",)], "company_size string")
    up = sc.pipeline(df, "ml_ready", do_currency=False)
    down = sc.pipeline(df, "ml_ready", do_currency=False, company_size_order="descending")
    # The imputation has added its level, whether or not a size was missing.
    assert levels_of(up, "company_size") == ["S", "M", "L", "NA"]
    assert levels_of(down, "company_size") == ["L", "M", "S", "NA"]
    assert is_ordered(up, "company_size") and is_ordered(down, "company_size")


def test_ml_ready_normalises_every_known_field(spark):
    df = spark.createDataFrame(
        [
            (2020, "FT", "Data Analyst", 100.0, "EUR", 20, "S", "fr"),
            (2021, "PT", "Chef", 200.0, "EUR", 60, None, "UK"),
            (2022, None, "MLOps Engineer", None, None, None, "L", None),
        ],
        "work_year int, employment_type string, job_title string, salary double,"
        "salary_currency string, remote_ratio int, company_size string, country string",
    )
    out = sc.pipeline(df, "ml_ready")
    assert rows(out, "work_year", "employment_type", "job_title", "company_size", "country") == [
        (2020, "Full-time", "Analyst", "S", "FR"),
        (2021, "Part-time", "Chef", "NA", "GB"),
        (2022, "NA", "ML Engineer", "L", "NA"),
    ]
    assert rows(out, "work_year", "remote_ratio", "salary_in_usd") == [
        (2020, 0.0, pytest.approx(105 * 0.88)),
        (2021, 50.0, pytest.approx(195 * 0.85)),
        (2022, 50.0, None),
    ]
    assert levels_of(out, "company_size") == ["S", "M", "L", "NA"]


def test_currency_focus(spark):
    df = spark.createDataFrame(
        [(1000.0, "USD", 2020), (2000.0, "EUR", 2021)],
        "salary double, salary_currency string, work_year int",
    )
    out = sc.pipeline(df, "currency_focus")
    assert rows(out, "salary", "salary_in_usd") == [(1000.0, 1000.0), (2000.0, 1700.0)]


def test_export_from_path_and_frame(spark, tmp_path):
    df = spark.createDataFrame([(1.0, "a", True), (None, None, None), (3.0, "a", False)], DDL)
    raw, out = str(tmp_path / "raw"), str(tmp_path / "clean")
    sc.export_cleaned(df, raw, "|")
    cleaned = sc.export_pipeline(
        raw, "light_clean", out, spark=spark, load_delim="|", export_delim=";"
    )
    assert rows(cleaned) == [(1.0, "a", True), (2.0, "a", True), (3.0, "a", False)]
    assert rows(sc.import_data(spark, out, ";")) == rows(cleaned)
    again = str(tmp_path / "again")
    cleaned = sc.export_pipeline(df, "light_clean", again)
    assert rows(sc.import_data(spark, again)) == rows(cleaned)
    with pytest.raises(ValueError, match="read_options"):
        sc.pipeline(df, "minimal", read_options={"delim": ";"})


def test_path_options_are_kept_apart(spark, tmp_path):
    path = tmp_path / "raw.csv"
    path.write_text("a;b\n1;x\n")
    out = sc.pipeline(
        str(path), "minimal", read_options={"delim": ";"}, required_columns=["a", "b"]
    )
    assert rows(out) == [(1, "x")]


def test_unknown_mode(spark):
    with pytest.raises(ValueError, match="No pipeline defined for mode: tidy"):
        sc.pipeline(spark.range(1), "tidy")


def test_steps_are_written_in_the_shared_folder(spark):
    root = scratch_root(spark)
    df = spark.createDataFrame([(1.0, "a", True), (None, "b", None)], DDL)
    out = sc.pipeline(df, "light_clean")
    assert all(root.split(":", 1)[-1].lstrip("/") in f for f in out.inputFiles())


def test_written_steps_can_be_discarded(spark):
    sc.discard_written(spark)
    out = sc.pipeline(spark.createDataFrame([(1.0, "a", True)], DDL), "light_clean")
    assert rows(out) == [(1.0, "a", True)]
    assert sc.discard_written(spark) == 1
    with pytest.raises(Exception, match="does not exist|NOT_EXIST|not exist"):
        out.collect()

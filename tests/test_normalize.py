import pytest

import scourline as sc
from scourline.functions import is_ordered, levels_of
from scourline.functions import reference_values as ref
from scourline.functions.lookup import needed_variants


def column(spark, name, values, kind="string"):
    return spark.createDataFrame([(v,) for v in values], f"{name} {kind}").coalesce(1)


def got(df, name):
    return [r[name] for r in df.collect()]


def test_fixed_tables():
    assert len(ref.JOB_TITLE_BUCKETS) == 93 and len(ref.JOB_TITLES_BY_BUCKET) == 13
    assert len(ref.COUNTRY_TO_ISO2) == 222
    assert len(set(ref.COUNTRY_TO_ISO2.values())) == 106
    assert len(ref.REGION_BY_ISO2) == 105 and "HN" not in ref.REGION_BY_ISO2
    assert len(ref.EXCHANGE_RATES) == 164


def test_employment_type(spark):
    df = column(spark, "employment_type", ["CT", None, "FL", "ft", "FT", "XX", "PT"])
    out = sc.normalize(df, "employment_type")
    assert got(out, "employment_type") == [
        "Contract", None, "Freelance", "ft", "Full-time", "XX", "Part-time"
    ]
    assert levels_of(out, "employment_type") == list(ref.EMPLOYMENT_TYPES)
    assert not is_ordered(out, "employment_type")
    typed = sc.normalize_employment_type(sc.enforce_types(df))
    assert levels_of(typed, "employment_type") == [
        "Contract", "Freelance", "Full-time", "Part-time", "XX", "ft"
    ]


def test_company_size(spark):
    up = sc.normalize_company_size(
        column(spark, "company_size", ["L", None, "M", "S", "L"]), ordinal_col="o"
    )
    assert levels_of(up, "company_size") == ["S", "M", "L"] and is_ordered(up, "company_size")
    assert got(up, "o") == [2, None, 1, 0, 2]
    down = sc.normalize_company_size(
        column(spark, "company_size", ["S", "M", "L", "S"]), "descending", ordinal_col="o"
    )
    assert levels_of(down, "company_size") == ["L", "M", "S"]
    assert got(down, "o") == [2, 1, 0, 2]


def test_invalid_company_size(spark):
    df = column(spark, "company_size", ["S", "XL"])
    with pytest.raises(Exception, match="Invalid company_size: XL"):
        sc.normalize_company_size(df).collect()
    assert got(sc.normalize_company_size(df, on_invalid="null"), "company_size") == ["S", None]
    kept = sc.normalize_company_size(df, on_invalid="keep")
    assert got(kept, "company_size") == ["S", "XL"]
    with pytest.raises(ValueError):
        sc.normalize_company_size(df, "sideways")


def test_experience_level(spark):
    df = column(spark, "experience_level", ["EX", "EN", "XX"])
    out = sc.normalize_experience_level(df, on_invalid="null", ordinal_col="o")
    assert got(out, "o") == [3, 0, None]
    assert levels_of(out, "experience_level") == ["EN", "MI", "SE", "EX"]


def test_remote_ratio(spark):
    df = column(spark, "remote_ratio", [20, 40, 80, 0, 50, 100, None, 25, 75, 150, -5], "int")
    out = sc.normalize_remote_ratio(df)
    assert dict(out.dtypes)["remote_ratio"] == "double"
    assert got(out, "remote_ratio") == [
        0.0, 50.0, 100.0, 0.0, 50.0, 100.0, None, 0.0, 50.0, 100.0, 0.0
    ]
    other = sc.normalize_remote_ratio(
        column(spark, "r", [25.0, 75.0, float("nan")], "double"), "r", allowed=(100, 50, 0)
    )
    assert got(other, "r") == [50.0, 100.0, 100.0]
    one = sc.normalize_remote_ratio(column(spark, "r", [3, None], "int"), "r", allowed=[7])
    assert got(one, "r") == [7.0, None]


def test_job_title(spark):
    df = column(spark, "job_title", ["Data Analyst", "Unknown title", None, "data analyst"])
    assert got(sc.normalize_job_title(df), "job_title") == [
        "Analyst", "Unknown title", None, "data analyst"
    ]
    mapping = {"data analyst": "DA", "Chief": "C"}
    assert got(sc.normalize_job_title(df, mapping=mapping), "job_title") == [
        "DA", "Unknown title", None, "DA"
    ]
    every = column(spark, "job_title", list(ref.JOB_TITLE_BUCKETS))
    assert got(sc.normalize_job_title(every), "job_title") == list(
        ref.JOB_TITLE_BUCKETS.values()
    )


def test_country_and_region(spark):
    df = column(
        spark, "country",
        ["US", "fr", "UnknownLand", None, "türkiye", "Côte d'Ivoire", "HN", "uk", " FR"],
    )
    out = sc.normalize_country(df, region_col="region")
    assert got(out, "country") == [
        "US", "FR", "UnknownLand", None, "TR", "CI", "HN", "GB", " FR"
    ]
    assert got(out, "region") == [
        "North America", "Europe", None, None, "Asia", "Africa", None, "Europe", None
    ]
    assert sc.normalize_country(df).columns == ["country"]


def test_custom_country_mappings(spark):
    df = column(spark, "country", ["Gaule", "gaule", "GAULE", "us", "x"])
    records = {
        "Gaule": {"code": "FR", "region": "ignored"}, "gaule": {"note": "no code"},
        "US": "US",
    }
    out = sc.normalize_country(df, mapping=records, region_col="r")
    assert got(out, "country") == ["FR", "gaule", "GAULE", "US", "x"]
    assert got(out, "r") == ["Europe", None, None, "North America", None]
    table = spark.createDataFrame([("GAULE", "FR"), ("us", "US")], "key string, code string")
    mapped = sc.normalize_country(df, mapping=table)
    assert got(mapped, "country") == ["FR", "FR", "FR", "US", "x"]
    with pytest.raises(ValueError, match="repeated keys"):
        sc.normalize_country(df, mapping=table.union(table))


def test_only_useful_variants_are_looked_up():
    three = ("exact", "upper", "lower")
    assert needed_variants(ref.COUNTRY_TO_ISO2, three) == ["upper"]
    assert needed_variants(ref.JOB_TITLE_BUCKETS, ("exact", "lower")) == ["exact"]
    assert needed_variants({"a": 1, "B": 2, "Cc": 3}, three) == ["exact", "upper", "lower"]
    assert needed_variants({"a1": 1}, ("exact", "lower")) == ["exact", "lower"]


@pytest.mark.parametrize(
    "field",
    ["employment_type", "company_size", "remote_ratio", "job_title", "country", "experience_level"],
)
def test_absent_column(spark, field):
    with pytest.raises(ValueError, match="not found"):
        sc.normalize(spark.createDataFrame([(1,)], "other int"), field)


def test_unknown_field(spark):
    with pytest.raises(ValueError, match="No normalisation"):
        sc.normalize(spark.range(1), "salary")

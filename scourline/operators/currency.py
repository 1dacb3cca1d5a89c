"""Amounts to USD by currency and year."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.columns import col
from ..functions.intervals import as_of
from ..functions.lookup import checked_dimension
from ..sources.rates import exchange_rates as builtin_rates
from .schema import require_columns


def convert_currency_to_usd(
    df: DataFrame,
    salary_col: str = "salary",
    currency_col: str = "salary_currency",
    year_col: str = "work_year",
    usd_col: str = "salary_in_usd",
    exchange_rates: DataFrame | None = None,
    as_of_year: bool = False,
) -> DataFrame:
    """Set ``usd_col`` to salary times the rate of its currency and year.

    Null where the salary or its rate is missing.  ``exchange_rates`` needs the
    columns ``year``, ``currency`` and ``rate``; a repeated (year, currency) is an
    error, so every row stays one row.  With ``as_of_year`` a year without a rate takes
    the last earlier one of its currency: each (currency, year) of the rows is looked up
    once, and the rows are joined with what was found.
    """
    require_columns(df, salary_col, currency_col, year_col)
    if exchange_rates is None:
        rates = F.broadcast(builtin_rates(df.sparkSession))
    else:
        require_columns(exchange_rates, "year", "currency", "rate")
        rates = checked_dimension(
            exchange_rates.select("year", "currency", "rate"),
            ["year", "currency"],
            "exchange_rates",
        )
    rates = rates.select(
        F.col("currency").cast("string").alias("__rate_currency"),
        F.col("year").cast("bigint").alias("__rate_year"),
        F.col("rate").cast("double").alias("__rate"),
    )
    same_currency = col(currency_col).cast("string") == F.col("__rate_currency")
    same_year = _whole_year(df, year_col) == F.col("__rate_year")
    usd = col(salary_col).cast("double") * F.col("__rate")
    if as_of_year:
        rates = _as_of_years(df, rates, currency_col, year_col)
    joined = df.join(rates, same_currency & same_year, "left")
    columns = [usd.alias(c) if c == usd_col else col(c) for c in df.columns]
    if usd_col not in df.columns:
        columns.append(usd.alias(usd_col))
    return joined.select(*columns)


def _as_of_years(df: DataFrame, rates: DataFrame, currency_col: str, year_col: str) -> DataFrame:
    """The rate of each currency and year that ``df`` holds, the last earlier one if need be."""
    wanted = df.select(
        col(currency_col).cast("string").alias("__rate_currency"),
        _whole_year(df, year_col).alias("__rate_year"),
    ).distinct()
    found = as_of(wanted.dropna(), rates.dropna(), ["__rate_currency"], "__rate_year", ["__rate"])
    return checked_dimension(found, ["__rate_currency", "__rate_year"], "rates")


def check_usd(
    df: DataFrame,
    tolerance: float = 0.05,
    usd_col: str = "salary_in_usd",
    out_col: str = "usd_consistent",
    **conversion,
) -> DataFrame:
    """Add whether a given USD amount agrees with the converted one, up to a share of
    the converted amount; null where one of them is missing.  Further arguments are
    those of :func:`convert_currency_to_usd`."""
    require_columns(df, usd_col)
    converted = convert_currency_to_usd(df, usd_col="__converted", **conversion)
    given, expected = col(usd_col).cast("double"), F.col("__converted")
    agrees = F.abs(given - expected) <= F.abs(expected) * tolerance
    return converted.withColumn(out_col, agrees).drop("__converted")


def _whole_year(df: DataFrame, year_col: str) -> Column:
    year = col(year_col)
    if isinstance(df.schema[year_col].dataType, T.IntegralType):
        return year.cast("bigint")
    number = year.try_cast("double")
    return F.when(number == F.floor(number), number.try_cast("bigint"))

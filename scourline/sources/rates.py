"""The built-in yearly exchange rates as a DataFrame."""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from ..functions.reference_values import EXCHANGE_RATES


def exchange_rates(spark: SparkSession) -> DataFrame:
    """``(year int, currency string, rate double)``: 41 currencies, 2020 to 2023.

    Built from an Arrow table, so the plan holds a local relation of known size.
    """
    years, currencies, rates = zip(*EXCHANGE_RATES)
    return spark.createDataFrame(
        pa.table(
            {
                "year": pa.array(years, pa.int32()),
                "currency": pa.array(currencies, pa.string()),
                "rate": pa.array(rates, pa.float64()),
            }
        )
    )

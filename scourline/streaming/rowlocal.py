"""Normalisation and USD conversion of a stream of salary rows."""

from __future__ import annotations

from pyspark.sql import DataFrame

from ..operators.currency import convert_currency_to_usd
from ..operators.normalize import normalize
from ..operators.schema import standardize_colnames

_FIELDS = ("employment_type", "company_size", "remote_ratio", "job_title", "country")


def clean_stream(
    stream: DataFrame, do_currency: bool = True, on_invalid_size: str = "keep"
) -> DataFrame:
    """Standard names, every known field that is there normalised, then USD."""
    stream = standardize_colnames(stream)
    for field in _FIELDS:
        if field in stream.columns:
            extra = {"on_invalid": on_invalid_size} if field == "company_size" else {}
            stream = normalize(stream, field, **extra)
    return convert_currency_to_usd(stream) if do_currency else stream

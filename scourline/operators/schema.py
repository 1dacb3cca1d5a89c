"""Required columns, the salary-table contract and column names."""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterable, Sequence

from pyspark.sql import DataFrame

from ..functions.reference_values import SALARY_COLUMNS
from ..functions.text import snake_case_name


#: Where a row stood in its source, as :func:`scourline.import_data` notes it down.
ROW_ORDER = "__row_order"


def missing_columns(df: DataFrame, required: Iterable[str]) -> list[str]:
    """Required names that ``df`` lacks, in the order required (case-sensitive)."""
    present = set(df.columns)
    return [name for name in required if name not in present]


def require_columns(df: DataFrame, *names: str) -> None:
    for name in missing_columns(df, names):
        raise ValueError(f"Column {name} not found in DataFrame")


def validate_schema(
    df: DataFrame, required: Iterable[str], strict: bool = True
) -> bool | list[str]:
    """Strict: true, or an error naming what is missing.  Lenient: the list."""
    absent = missing_columns(df, required)
    if not strict:
        return absent
    if absent:
        raise ValueError(f"Missing required columns: {', '.join(absent)}")
    return True


def salary_table(df: DataFrame) -> DataFrame:
    """``df`` itself, once it is known to have the eleven salary columns."""
    validate_schema(df, SALARY_COLUMNS)
    return df


def standardize_colnames(
    df: DataFrame | Sequence[DataFrame],
) -> DataFrame | list[DataFrame]:
    """Snake-case all column names of one DataFrame, or of each in a list."""
    if not isinstance(df, DataFrame):
        return [standardize_colnames(one) for one in df]
    names = [n if n == ROW_ORDER else snake_case_name(n) for n in df.columns]
    nameless = [old for old, new in zip(df.columns, names) if not new]
    if nameless:
        raise ValueError(f"Nothing is left of column names once standardised: {nameless}")
    repeated = [name for name, n in Counter(names).items() if n > 1]
    if repeated:
        raise ValueError(f"Column names collide once standardised: {repeated}")
    return df.toDF(*names)

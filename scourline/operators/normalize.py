"""Coded values brought to a common form.  All of these are projections or
lookups in small fixed tables, so they run on a stream as well as on a table."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.columns import col as by_name
from ..functions.levels import level_ordinal, levels_of, with_levels
from ..functions.lookup import add_lookup
from ..functions.reference_values import (
    COMPANY_SIZES,
    COUNTRY_TO_ISO2,
    EMPLOYMENT_LABELS,
    EMPLOYMENT_TYPES,
    EXPERIENCE_LEVELS,
    JOB_TITLE_BUCKETS,
    REGION_BY_ISO2,
    REMOTE_RATIOS,
)
from .schema import require_columns

_CODE = "__code"
_REGION = "__region"


def normalize(df: DataFrame, field: str, **kwargs) -> DataFrame:
    """Normalise one field, named as the functions below without ``normalize_``."""
    fields = {
        "employment_type": normalize_employment_type,
        "company_size": normalize_company_size,
        "remote_ratio": normalize_remote_ratio,
        "job_title": normalize_job_title,
        "country": normalize_country,
        "experience_level": normalize_experience_level,
    }
    if field not in fields:
        raise ValueError(f"No normalisation for field: {field}")
    return fields[field](df, **kwargs)


def normalize_employment_type(
    df: DataFrame, col: str = "employment_type"
) -> DataFrame:
    """Codes to labels, exact case; other values stay.  Unordered categorical."""
    require_columns(df, col)
    known = levels_of(df, col)
    if known is None:
        levels = list(EMPLOYMENT_TYPES)
    else:
        levels = sorted({EMPLOYMENT_LABELS.get(level, level) for level in known})
    looked_up = add_lookup(df, by_name(col), EMPLOYMENT_LABELS, {_CODE: "code"})
    label = F.coalesce(F.col(_CODE), by_name(col))
    return _replaced(looked_up, df, {col: with_levels(label, col, levels)})


def normalize_company_size(
    df: DataFrame,
    order: str = "ascending",
    col: str = "company_size",
    on_invalid: str = "error",
    ordinal_col: str | None = None,
) -> DataFrame:
    """Ordered categorical S < M < L, or L < M < S with ``descending``.

    A value other than S, M, L fails the job when it is reached; ``on_invalid`` may
    be ``null`` or ``keep`` instead.  ``ordinal_col`` adds the 0-based position.
    """
    if order not in ("ascending", "descending"):
        raise ValueError(f"Unknown order: {order}")
    levels = COMPANY_SIZES if order == "ascending" else COMPANY_SIZES[::-1]
    return _ordered(df, col, levels, on_invalid, ordinal_col)


def normalize_experience_level(
    df: DataFrame,
    col: str = "experience_level",
    on_invalid: str = "error",
    ordinal_col: str | None = None,
) -> DataFrame:
    """Ordered categorical EN < MI < SE < EX, as for the company size."""
    return _ordered(df, col, EXPERIENCE_LEVELS, on_invalid, ordinal_col)


def normalize_remote_ratio(
    df: DataFrame,
    col: str = "remote_ratio",
    allowed: Sequence[float] = REMOTE_RATIOS,
) -> DataFrame:
    """The nearest allowed value as double; a tie goes to the one listed first."""
    require_columns(df, col)
    if not allowed:
        raise ValueError("allowed must not be empty")
    allowed = [float(a) for a in dict.fromkeys(allowed)]
    ascending = sorted(allowed)
    x = by_name(col).cast("double")
    nearest = F.lit(ascending[-1])
    # Walking up, the first value at least as near as the next one is the nearest.
    for low, high in reversed(list(zip(ascending, ascending[1:]))):
        to_low, to_high = F.abs(x - low), F.abs(x - high)
        first = allowed.index(low) < allowed.index(high)
        near = to_low <= to_high if first else to_low < to_high
        nearest = F.when(near, F.lit(low)).otherwise(nearest)
    if isinstance(df.schema[col].dataType, (T.DoubleType, T.FloatType)):
        nearest = F.when(F.isnan(x), F.lit(allowed[0])).otherwise(nearest)
    return df.withColumn(col, F.when(x.isNotNull(), nearest))


def normalize_job_title(
    df: DataFrame,
    col: str = "job_title",
    mapping: Mapping[str, str] | DataFrame | None = None,
) -> DataFrame:
    """Titles to buckets: the title as it is, then lower-cased, else unchanged."""
    require_columns(df, col)
    mapping = JOB_TITLE_BUCKETS if mapping is None else mapping
    looked_up = add_lookup(
        df, by_name(col), _codes(mapping), {_CODE: "code"}, ("exact", "lower")
    )
    return _replaced(looked_up, df, {col: F.coalesce(F.col(_CODE), by_name(col)).alias(col)})


def normalize_country(
    df: DataFrame,
    col: str = "country",
    mapping: Mapping | DataFrame | None = None,
    region_col: str | None = None,
) -> DataFrame:
    """Country names and codes to ISO2: as it is, upper-cased, lower-cased, else
    unchanged.  ``region_col`` adds the region of the resulting code, or null."""
    require_columns(df, col)
    mapping = COUNTRY_TO_ISO2 if mapping is None else mapping
    looked_up = add_lookup(
        df, by_name(col), _codes(mapping), {_CODE: "code"}, ("exact", "upper", "lower")
    )
    code = F.coalesce(F.col(_CODE), by_name(col)).alias(col)
    if region_col is None:
        return _replaced(looked_up, df, {col: code})
    with_region = add_lookup(looked_up, code, REGION_BY_ISO2, {_REGION: "code"})
    region = F.col(_REGION).alias(region_col)
    return _replaced(with_region, df, {col: code, region_col: region})


def _codes(mapping):
    """Records in a dict are reduced to their ``code``; a record without one is
    found but empty, so that the raw value stays."""
    if not isinstance(mapping, Mapping):
        return mapping
    codes = {k: v.get("code") if isinstance(v, Mapping) else v for k, v in mapping.items()}
    return {key: None if code is None else str(code) for key, code in codes.items()}


def _ordered(df, col, levels, on_invalid, ordinal_col) -> DataFrame:
    require_columns(df, col)
    value = by_name(col).cast("string")
    valid = value.isNull() | value.isin(list(levels))
    if on_invalid == "error":
        refuse = F.raise_error(
            F.concat(F.lit(f"Invalid {col}: "), value)
        )
        result = F.when(valid, value).otherwise(refuse.cast("string"))
    elif on_invalid == "null":
        result = F.when(valid, value)
    elif on_invalid == "keep":
        result = value
        levels = [*levels, *[v for v in levels_of(df, col) or [] if v not in levels]]
    else:
        raise ValueError(f"Unknown on_invalid: {on_invalid}")
    added = {col: with_levels(result, col, levels, ordered=True)}
    if ordinal_col is not None:
        added[ordinal_col] = level_ordinal(result, levels).alias(ordinal_col)
    return _replaced(df, df, added)


def _replaced(source: DataFrame, like: DataFrame, added: dict[str, Column]) -> DataFrame:
    """The columns of ``like`` in their order, some replaced, new ones at the end."""
    columns = [added.get(name, by_name(name)) for name in like.columns]
    columns += [column for name, column in added.items() if name not in like.columns]
    return source.select(*columns)

"""The six preset pipelines, from a DataFrame or a CSV path, with export."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, FloatType, NumericType

from ..functions.columns import col
from ..operators.currency import convert_currency_to_usd
from ..operators.dedup import ROW_ORDER, deduplicate_rows
from ..operators.impute import (
    BoolMajority,
    CatMode,
    CatNewLevel,
    NumMedian,
    impute_missing,
)
from ..operators.normalize import (
    normalize_company_size,
    normalize_country,
    normalize_employment_type,
    normalize_job_title,
    normalize_remote_ratio,
)
from ..operators.quality import clamp, winsor_bounds
from ..operators.schema import standardize_colnames, validate_schema
from ..operators.typing import enforce_types
from ..sources.csv import export_cleaned, import_data, infer_csv_types
from ..sources.scratch import discard_written, written, written_so_far


def pipeline(
    source: DataFrame | str,
    mode: str,
    *,
    spark: SparkSession | None = None,
    read_options: Mapping | None = None,
    **options,
) -> DataFrame:
    """Run a preset: ``minimal``, ``light_clean``, ``strict_clean``, ``ml_ready``,
    ``currency_focus`` or ``no_impute``.

    ``source`` is a DataFrame or the path of a CSV; ``read_options`` go to
    :func:`import_data`, all other options to the preset.  Rows of a path keep their order
    for ``keep_first``.  The presets that scan their rows several times write them to the
    shared folder first; :func:`scourline.discard_written` deletes that once the result is
    used.
    """
    if mode not in PRESETS:
        raise ValueError(f"No pipeline defined for mode: {mode}")
    if not isinstance(source, DataFrame):
        spark = spark or SparkSession.getActiveSession()
        source = _imported(spark, source, dict(read_options or {}))
    elif read_options:
        raise ValueError("read_options apply to a path only")
    return PRESETS[mode](source, **options)


def export_pipeline(
    source: DataFrame | str,
    mode: str,
    out_path: str,
    *,
    load_delim: str = ",",
    export_delim: str = ",",
    spark: SparkSession | None = None,
    read_options: Mapping | None = None,
    write_options: Mapping | None = None,
    **options,
) -> DataFrame:
    """Run a preset, write the result as CSV and return it as read from there.

    Tables written on the way are deleted.  The result has the types of the cleaned rows;
    empty texts come back as nulls, as from any CSV.
    """
    mark = written_so_far()
    if not isinstance(source, DataFrame):
        read_options = {"delim": load_delim, **(read_options or {})}
    cleaned = pipeline(source, mode, spark=spark, read_options=read_options, **options)
    session, schema = cleaned.sparkSession, cleaned.schema
    export_cleaned(cleaned, out_path, export_delim, **(write_options or {}))
    discard_written(session, mark)
    if (write_options or {}).get("format", "csv") != "csv":
        return session.read.schema(schema).parquet(out_path)
    plain = {"header": True, "sep": export_delim, "quote": '"', "escape": '"', "multiLine": True}
    given = {k: v for k, v in (write_options or {}).items() if k not in ("mode", "format", "partition_by")}
    return session.read.options(**{**plain, **given}).schema(schema).csv(out_path)


def _imported(spark: SparkSession, path: str, options: dict) -> DataFrame:
    """The CSV is parsed once and written as columns; types are inferred on those, and
    so is all that follows."""
    infer = options.pop("infer", True) and options.get("schema") is None
    raw = import_data(spark, path, infer=False, **{"keep_order": True, **options})
    df = written(raw)
    return infer_csv_types(df) if infer else df


def minimal(
    df: DataFrame, required_columns: Sequence[str] | None = None, strict: bool = True
) -> DataFrame:
    """Required columns (by their raw names), column names, types."""
    return _minimal(df, required_columns, strict).drop(ROW_ORDER)


def _minimal(df: DataFrame, required_columns, strict: bool) -> DataFrame:
    """``minimal``, with the noted order of the rows."""
    if required_columns is not None:
        validate_schema(df, required_columns, strict)
    return enforce_types(standardize_colnames(df))


def light_clean(
    df: DataFrame,
    required_columns: Sequence[str] | None = None,
    strict: bool = True,
    dedup_mode: str = "keep_first",
    dedup_by: Sequence[str] | None = None,
    order_by: Sequence | None = None,
    num_method=NumMedian(),
    cat_method=CatMode(),
    bool_method=BoolMajority(),
) -> DataFrame:
    """Minimal, duplicates, soft imputation."""
    deduplicated = no_impute(
        df, required_columns, strict, dedup_mode, dedup_by, order_by
    )
    return impute_missing(
        written(deduplicated),
        num_method=num_method,
        cat_method=cat_method,
        bool_method=bool_method,
    )


def strict_clean(
    df: DataFrame,
    required_columns: Sequence[str] | None = None,
    strict: bool = True,
    dedup_by: Sequence[str] | None = None,
    winsorize_exclude: Sequence[str] = (),
    nan_as_null: bool = False,
) -> DataFrame:
    """Minimal, no duplicated key at all, winsorised, imputed with a level "NA".

    A NaN is an error, unless ``nan_as_null`` makes it a missing value.
    """
    # The statistics below scan the deduplicated rows several times: they are
    # written once, so the shuffle is not repeated and each scan reads few columns.
    df = no_impute(df, required_columns, strict, dedup_mode="drop_all", dedup_by=dedup_by)
    if nan_as_null:
        floats = [f.name for f in df.schema if isinstance(f.dataType, (FloatType, DoubleType))]
        df = df.withColumns({n: F.when(~F.isnan(col(n)), col(n)) for n in floats})
    df = written(df)
    # Clamping to the 5 % and 95 % quantiles leaves the median where it is, so one
    # search finds all three.
    numeric = [f.name for f in df.schema if isinstance(f.dataType, NumericType)]
    bounds, medians = winsor_bounds(df, exclude=winsorize_exclude, medians_of=numeric)
    return impute_missing(
        clamp(df, bounds), cat_method=CatNewLevel("NA"), medians=medians
    )


def ml_ready(
    df: DataFrame,
    required_columns: Sequence[str] | None = None,
    strict: bool = True,
    company_size_order: str = "ascending",
    do_currency: bool = True,
    dedup_by: Sequence[str] | None = None,
    winsorize_exclude: Sequence[str] = ("work_year",),
    on_invalid_size: str = "keep",
    nan_as_null: bool = False,
) -> DataFrame:
    """Strict clean, then each known field that is there normalised, then USD.

    The year is not winsorised, since it is a key of the exchange rates.  Missing
    sizes have become "NA" by then, so sizes other than S, M, L are kept.
    """
    df = strict_clean(
        df, required_columns, strict, dedup_by, winsorize_exclude, nan_as_null
    )
    if "employment_type" in df.columns:
        df = normalize_employment_type(df)
    if "company_size" in df.columns:
        df = normalize_company_size(df, company_size_order, on_invalid=on_invalid_size)
    if "remote_ratio" in df.columns:
        df = normalize_remote_ratio(df)
    if "job_title" in df.columns:
        df = normalize_job_title(df)
    if "country" in df.columns:
        df = normalize_country(df)
    return convert_currency_to_usd(df) if do_currency else df


def currency_focus(
    df: DataFrame, required_columns: Sequence[str] | None = None, strict: bool = True
) -> DataFrame:
    """Minimal, then USD."""
    return convert_currency_to_usd(minimal(df, required_columns, strict))


def no_impute(
    df: DataFrame,
    required_columns: Sequence[str] | None = None,
    strict: bool = True,
    dedup_mode: str = "keep_first",
    dedup_by: Sequence[str] | None = None,
    order_by: Sequence | None = None,
) -> DataFrame:
    """Minimal, then duplicates; nulls are kept."""
    df = _minimal(df, required_columns, strict)
    return deduplicate_rows(df, dedup_mode, dedup_by, order_by=order_by)


PRESETS = {
    "minimal": minimal,
    "light_clean": light_clean,
    "strict_clean": strict_clean,
    "ml_ready": ml_ready,
    "currency_focus": currency_focus,
    "no_impute": no_impute,
}

"""Filling missing values.

All statistics of a table are found before one projection fills every column: one
aggregation for counts, means and majorities, the exact quantile search for medians,
and one grouped count for the modes, but for columns with very many values where a sketch of
the frequent ones and a count of those settle it.  Columns without a null are not looked at
again, and constants need no statistics at all.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from decimal import Decimal

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.columns import col, quoted
from ..functions.columns import cols as columns_of
from ..functions.levels import is_categorical, is_ordered, level_ordinal, levels_of
from ..functions.levels import with_levels
from .heavy import most_frequent
from .quantiles import exact_quantiles
from .schema import require_columns

#: Columns with more distinct values than about this have their frequent ones sketched.
MANY_VALUES = 10_000


@dataclass(frozen=True)
class NumMedian:
    """Median of the observed values."""


@dataclass(frozen=True)
class NumMean:
    """Mean of the observed values."""


@dataclass(frozen=True)
class NumConstant:
    value: float


@dataclass(frozen=True)
class CatMode:
    """Most frequent value; a tie goes to the first level, or the smallest text."""


@dataclass(frozen=True)
class CatConstant:
    value: str


@dataclass(frozen=True)
class CatNewLevel:
    label: str


@dataclass(frozen=True)
class BoolMajority:
    """More frequent value; a tie goes to true."""


def impute_missing(
    df: DataFrame,
    cols: str | Sequence[str] | None = None,
    exclude: Sequence[str] = (),
    num_method: NumMedian | NumMean | NumConstant = NumMedian(),
    cat_method: CatMode | CatConstant | CatNewLevel = CatMode(),
    bool_method: BoolMajority = BoolMajority(),
    medians: Mapping[str, float] | None = None,
) -> DataFrame:
    """Fill the nulls of ``cols`` (default: all) by the method for their type.

    Columns of other types, and columns without any value where a statistic is
    asked for, stay as they are.  A whole-number column that has nulls becomes
    double when filled with its median or mean.  ``medians`` holds those already
    known, so that they are not searched for again.
    """
    methods = _methods(df, cols, exclude, num_method, cat_method, bool_method)
    fills = _fills(df, methods, medians or {})
    columns = []
    for field in df.schema:
        column = col(field.name)
        if field.name in fills:
            value = fills[field.name]
            kind = field.dataType
            if isinstance(methods[field.name], (NumMedian, NumMean)):
                kind = kind if isinstance(kind, T.FloatType) else T.DoubleType()
            filled = F.coalesce(column.cast(kind), F.lit(value).cast(kind))
            if is_categorical(field):
                levels = levels_of(df, field.name)
                if value not in levels:
                    levels = [*levels, value]
                column = with_levels(
                    filled, field.name, levels, is_ordered(df, field.name)
                )
            else:
                column = filled.alias(field.name)
        columns.append(column)
    return df.select(*columns)


def impute_report(
    before: DataFrame,
    after: DataFrame,
    num_method=NumMedian(),
    cat_method=CatMode(),
    bool_method=BoolMajority(),
) -> DataFrame:
    """``(column, nulls_before, nulls_after, method)``, one row per column."""
    names = [c for c in before.columns if c in after.columns]
    methods = _methods(before, names, (), num_method, cat_method, bool_method)
    label = F.lit(None).cast("string")
    for name, method in methods.items():
        label = F.when(F.col("column") == name, type(method).__name__).otherwise(label)
    counted = _null_counts(before, names, "nulls_before").join(
        _null_counts(after, names, "nulls_after"), "column"
    )
    return counted.select(
        "column",
        "nulls_before",
        "nulls_after",
        F.coalesce(label, F.lit("none")).alias("method"),
    )


def _methods(df, selected, exclude, num_method, cat_method, bool_method) -> dict:
    for method, kinds in (
        (num_method, (NumMedian, NumMean, NumConstant)),
        (cat_method, (CatMode, CatConstant, CatNewLevel)),
        (bool_method, (BoolMajority,)),
    ):
        if not isinstance(method, kinds):
            raise ValueError(f"Unknown imputation method: {method}")
    if isinstance(selected, str):
        selected = [selected]
    require_columns(df, *(selected or ()))
    methods = {}
    for field in df.schema:
        if selected is not None and field.name not in selected:
            continue
        if field.name in exclude:
            continue
        if isinstance(field.dataType, T.BooleanType):
            methods[field.name] = bool_method
        elif isinstance(field.dataType, T.NumericType):
            methods[field.name] = num_method
        elif isinstance(field.dataType, T.StringType):
            methods[field.name] = cat_method
    return methods


def _fills(df: DataFrame, methods: dict, known: Mapping[str, float]) -> dict:
    """Fill value of each column that is to be filled."""
    fills, searched = {}, []
    for name, method in methods.items():
        if isinstance(method, NumConstant):
            fills[name] = _constant(df, name, method.value)
        elif isinstance(method, CatConstant):
            fills[name] = method.value
        elif isinstance(method, CatNewLevel):
            fills[name] = method.label
        else:
            searched.append(name)
    if not searched:
        return fills
    stats = []
    for i, name in enumerate(searched):
        value = quoted(name)
        stats.append(f"count_if({value} IS NULL) AS nulls{i}")
        stats.append(f"count({value}) AS seen{i}")
        if isinstance(methods[name], NumMean):
            stats.append(f"avg(CAST({value} AS DOUBLE)) AS mean{i}")
        elif isinstance(methods[name], BoolMajority):
            stats.append(f"count_if({value}) AS true{i}")
        elif isinstance(methods[name], CatMode) and not is_categorical(df.schema[name]):
            stats.append(f"approx_count_distinct({value}, 0.05) AS distinct{i}")
    row = df.selectExpr(*stats).first()
    row = row.asDict()
    medians, modes, wide = [], [], []
    for i, name in enumerate(searched):
        seen, method = row[f"seen{i}"], methods[name]
        if row[f"nulls{i}"] == 0 or seen == 0:
            continue
        if isinstance(method, NumMean):
            fills[name] = row[f"mean{i}"]
        elif isinstance(method, BoolMajority):
            fills[name] = 2 * row[f"true{i}"] >= seen
        elif isinstance(method, NumMedian) and name in known:
            fills[name] = known[name]
        elif isinstance(method, NumMedian):
            medians.append(name)
        elif row.get(f"distinct{i}", 0) > MANY_VALUES:
            wide.append(name)
        else:
            modes.append(name)
    for name, found in exact_quantiles(df, {n: [0.5] for n in medians}).items():
        # NaN is a value that has no place in an order: it makes the median NaN.
        fills[name] = float("nan") if found.nans else found.values[0]
    settled = {name: min(values) for name, values in most_frequent(df, wide).items()} if wide else {}
    fills.update(settled)
    fills.update(_modes(df, [*modes, *(name for name in wide if name not in settled)]))
    return fills


def _constant(df: DataFrame, name: str, value: float):
    """``value`` in the type of the column; an error where it does not fit."""
    kind = df.schema[name].dataType
    misfit = ValueError(f"{value} does not fit column {name} of type {kind.simpleString()}")
    if isinstance(kind, T.IntegralType):
        size = _BYTES[type(kind)] * 8 - 1
        if value != int(value) or not -(2**size) <= value < 2**size:
            raise misfit
        return int(value)
    if isinstance(kind, T.DecimalType):
        exact = Decimal(str(value))
        step = Decimal(1).scaleb(-kind.scale)
        if not exact.is_finite() or exact % step or abs(exact) >= 10 ** (kind.precision - kind.scale):
            raise misfit
        return exact
    return value


_BYTES = {T.ByteType: 1, T.ShortType: 2, T.IntegerType: 4, T.LongType: 8}


def _modes(df: DataFrame, names: Sequence[str]) -> dict[str, str]:
    """Most frequent value of each column, counted in one shuffle.

    Values are counted before the shuffle, so a very frequent one costs a row per
    task, and one row per column reaches the driver.
    """
    if not names:
        return {}
    place = F.lit(0)
    for name in names:
        levels = levels_of(df, name)
        if levels:
            ordinal = F.coalesce(level_ordinal(F.col("value"), levels), F.lit(0))
            place = F.when(F.col("column") == name, ordinal).otherwise(place)
    counted = (
        df.select(*columns_of(names))
        .unpivot([], columns_of(names), "column", "value")
        .where(F.col("value").isNotNull())
        .groupBy("column", "value")
        .agg(F.count(F.lit(1)).alias("n"))
    )
    # The highest count by a hash aggregate; only the few values that have it are ordered.
    most = counted.groupBy("column").agg(F.max("n").alias("n"))
    best = counted.join(F.broadcast(most), ["column", "n"]).groupBy("column").agg(
        F.min(F.struct(place.alias("place"), F.col("value"))).alias("best")
    )
    return {
        r["column"]: r["value"] for r in best.select("column", "best.value").collect()
    }


def _null_counts(df: DataFrame, names: Sequence[str], out: str) -> DataFrame:
    counted = df.selectExpr(
        *[f"count_if({n} IS NULL) AS {n}" for n in map(quoted, names)]
    )
    return counted.unpivot([], columns_of(names), "column", out)

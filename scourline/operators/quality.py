"""Range checks and winsorising."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.columns import col, double_literal, quoted
from ..functions.intervals import interval_counts
from ..functions.reference_values import (
    COMPANY_SIZES,
    EMPLOYMENT_TYPES,
    EXPERIENCE_LEVELS,
)
from .quantiles import exact_quantiles
from .schema import require_columns, salary_table

Test = Callable[[Column], Column]


def validate_range(
    df: DataFrame, columns: Sequence[str], tests: Sequence[Test]
) -> DataFrame:
    """``(variables, valid_mask)``: do all non-null values of the i-th column pass
    the i-th test.  One aggregation for all columns; surplus tests are ignored."""
    if len(tests) < len(columns):
        raise ValueError(f"{len(columns)} columns but only {len(tests)} tests")
    require_columns(df, *columns)
    masks = [
        _all_pass(col(c), test).alias(f"m{i}")
        for i, (c, test) in enumerate(zip(columns, tests))
    ]
    report = F.explode(
        F.array(
            *[
                F.struct(F.lit(c).alias("variables"), F.col(f"m{i}").alias("valid_mask"))
                for i, c in enumerate(columns)
            ]
        )
    ).alias("check")
    return df.agg(*masks).select(report).select("check.*")


def validate_range_table(
    df: DataFrame, rules: DataFrame, by: Sequence[str] = ()
) -> DataFrame:
    """Range rules held in a table: how many values each rule holds for, and how many not.

    ``rules`` has ``rule`` (unique), ``variable`` (a numeric column of ``df``), ``low`` and
    ``high`` (null: no bound), and the columns ``by``, which restrict a rule to the rows of
    that group.  Returns ``rule``, ``variable``, ``n_values`` (non-null values of its group),
    ``n_inside`` and ``valid_mask`` (all inside; true without values).  NaN lies in no range.

    Rules are counted by running sums of the values, so many overlapping rules cost no pairs.
    """
    require_columns(rules, "rule", "variable", "low", "high", *by)
    require_columns(df, *by)
    names = [r[0] for r in rules.select("variable").distinct().collect()]
    require_columns(df, *names)
    keys = ["variable", *by]
    values = df.select(*[col(c) for c in by], *[col(n).cast("double").alias(n) for n in names])
    long = values.unpivot([col(c) for c in by], [col(n) for n in names], "variable", "value")
    # Equal values are counted first: rules see each value of a group once.
    counted = long.where(F.col("value").isNotNull()).groupBy(*keys, "value").agg(F.count(F.lit(1)).alias("n"))
    bounds = rules.select("rule", *keys, F.col("low").cast("double").alias("low"), F.col("high").cast("double").alias("high"))
    met = interval_counts(counted, bounds, "value", "low", "high", "n", on=keys)
    # The rows of a rule that is not unique are one rule.
    of_rule = F.when(F.col("rule").isNotNull(), F.sum("n_inside").over(Window.partitionBy("rule")))
    return met.select(
        "rule", "variable", F.col("n_all").alias("n_values"), F.coalesce(of_rule, F.lit(0)).alias("n_inside")
    ).withColumn("valid_mask", F.col("n_values") == F.col("n_inside"))


def validate_salary_ranges(df: DataFrame) -> DataFrame:
    """The six rules of the salary table, as :func:`validate_range` reports them."""
    salary_table(df)

    def number(column: str, test: Test) -> Test:
        # NaN passes "> 0" in Spark; it is not a plausible amount.
        if isinstance(df.schema[column].dataType, (T.DoubleType, T.FloatType)):
            return lambda c: test(c) & ~F.isnan(c)
        return test

    rules = {
        "employment_type": lambda c: c.isin(list(EMPLOYMENT_TYPES)),
        "experience_level": lambda c: c.isin(list(EXPERIENCE_LEVELS)),
        "salary": number("salary", lambda c: c > 0),
        "salary_in_usd": number("salary_in_usd", lambda c: c > 0),
        "remote_ratio": number("remote_ratio", lambda c: (c >= 0) & (c <= 100)),
        "company_size": lambda c: c.isin(list(COMPANY_SIZES)),
    }
    return validate_range(df, list(rules), list(rules.values()))


def check_column(df: DataFrame, column: str, test: Test) -> bool:
    """Do all non-null values of one column pass; true where there are none."""
    require_columns(df, column)
    return df.agg(_all_pass(col(column), test).alias("ok")).first()["ok"]


def plausible_year(first: int, last: int) -> Test:
    return lambda c: (c >= first) & (c <= last)


def _all_pass(value: Column, test: Test) -> Column:
    passes = F.when(value.isNotNull(), F.coalesce(test(value), F.lit(False)))
    return F.coalesce(F.bool_and(passes), F.lit(True))


def winsorize(
    df: DataFrame,
    lower_quantile: float = 0.05,
    upper_quantile: float = 0.95,
    cols: Sequence[str] | None = None,
    exclude: Sequence[str] = (),
    on_nulls: str = "ignore",
    nan_as_null: bool = False,
) -> DataFrame:
    """Clamp numeric columns to two of their quantiles; the results are doubles.

    Nulls do not count for the quantiles and stay null; ``on_nulls="skip_column"``
    leaves columns with a null alone.  A table of at most one row is left as it is.
    NaN is an error unless ``nan_as_null``.
    """
    bounds, _ = winsor_bounds(
        df, lower_quantile, upper_quantile, cols, exclude, on_nulls, nan_as_null
    )
    return clamp(df, bounds, nan_as_null)


def clamp(
    df: DataFrame, bounds: Mapping[str, tuple[float, float]], nan_as_null: bool = False
) -> DataFrame:
    """Clamp columns to known bounds; nulls stay null."""
    columns = []
    for name in df.columns:
        if name not in bounds:
            columns.append(col(name))
            continue
        value = _number(df, name, nan_as_null)
        low, high = map(double_literal, bounds[name])
        # Without the condition a null would come out as a bound.
        clamped = f"greatest(least({value}, {high}), {low})"
        columns.append(
            F.expr(f"CASE WHEN {value} IS NOT NULL THEN {clamped} END").alias(name)
        )
    return df.select(*columns)


def winsor_bounds(
    df: DataFrame,
    lower_quantile: float = 0.05,
    upper_quantile: float = 0.95,
    cols: Sequence[str] | None = None,
    exclude: Sequence[str] = (),
    on_nulls: str = "ignore",
    nan_as_null: bool = False,
    medians_of: Sequence[str] = (),
) -> tuple[dict[str, tuple[float, float]], dict[str, float]]:
    """The clamps :func:`winsorize` applies, by column, and with them the medians of
    ``medians_of`` as they are before clamping, found in the same search."""
    if on_nulls not in ("ignore", "skip_column"):
        raise ValueError(f"Unknown on_nulls: {on_nulls}")
    require_columns(df, *(cols or ()))
    numeric = [
        f.name
        for f in df.schema
        if isinstance(f.dataType, T.NumericType)
        and (cols is None or f.name in cols)
        and f.name not in exclude
    ]
    wanted = {n: [lower_quantile, upper_quantile] for n in numeric}
    for name in medians_of:
        wanted[name] = [*wanted.get(name, []), 0.5]
    found = exact_quantiles(df, wanted)
    nan = [name for name in numeric if found[name].nans]
    if nan and not nan_as_null:
        raise ValueError(f"NaN in columns to winsorize: {', '.join(nan)}")
    bounds = {
        name: tuple(found[name].values[:2])
        for name in numeric
        if found[name].rows > 1
        and found[name].values
        and (on_nulls == "ignore" or found[name].count == found[name].rows)
    }
    medians = {
        name: found[name].values[-1]
        for name in medians_of
        if found[name].values and not found[name].nans
    }
    return bounds, medians


def _number(df: DataFrame, name: str, nan_as_null: bool) -> str:
    value = f"CAST({quoted(name)} AS DOUBLE)"
    if nan_as_null and isinstance(
        df.schema[name].dataType, (T.DoubleType, T.FloatType)
    ):
        value = f"nullif({value}, double('NaN'))"
    return value

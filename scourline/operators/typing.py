"""Type inference on text columns.

Two passes at most decide the types, whatever the number of columns:

1. one aggregation by column counts, for every text column, the non-blank and the numeric
   values, and marks which of a fixed number of hash buckets occur.  The number of
   marked buckets is a lower bound of the number of distinct values, so a column of
   free text is told apart here, with constant state and no shuffle of its values;
2. for the few columns left, the distinct values are listed, at most one more than
   the allowed number of levels per column.

One projection then converts.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.columns import col, cols, double_literal, quoted
from ..functions.levels import is_categorical, with_levels
from ..functions.text import number_sql, stripped_sql

_WORD = 64
_WORDS_MAX = 16


def enforce_types(
    df: DataFrame,
    num_threshold: float = 0.9,
    max_factor_levels: int = 20,
    stringify_temporal: bool = False,
) -> DataFrame:
    """Turn text columns into numbers, categories or stripped text.

    * numeric if at least ``num_threshold`` of the non-blank values are numbers:
      bigint when all of them are whole, else double; anything else becomes null;
    * else categorical if there are at most ``max_factor_levels`` distinct
      non-blank values;
    * else stripped text.

    Columns without a non-blank value, and columns that are not text, stay as they
    are; ``stringify_temporal`` treats dates and timestamps as text.
    """
    if stringify_temporal:
        df = _stringified(df)
    names = _text_columns(df)
    if not names:
        return df
    kinds = _kinds(df, names, num_threshold, max_factor_levels)
    levels = _levels(
        df, [n for n in names if kinds[n] == "few"], max_factor_levels
    )
    changed = [n for n in names if kinds[n] != "unchanged"]
    # Stripped in a projection of its own, so that it is done once per value.
    stripped = df.select(
        *[
            F.expr(stripped_sql(quoted(n))).alias(n) if n in changed else col(n)
            for n in df.columns
        ]
    )
    columns = []
    for name in df.columns:
        column = col(name)
        if name in levels:
            column = with_levels(column, name, levels[name])
        elif kinds.get(name) in ("bigint", "double"):
            number = f"CAST({number_sql(quoted(name))} AS {kinds[name]})"
            column = F.expr(number).alias(name)
        columns.append(column)
    return stripped.select(*columns)


def type_profile(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """``(column, n_valid, n_numeric, n_unique)`` of text columns.

    One shuffle of the distinct values, counted before it, so a value that fills
    most of a column costs one row per task; numbers are parsed once per value.
    """
    names = _text_columns(df) if columns is None else list(columns)
    values = _stacked(df, names).groupBy("column", "value").agg(
        F.count(F.lit(1)).alias("n")
    )
    return _profiled(values)


def _profiled(values: DataFrame) -> DataFrame:
    """The profile of counted values ``(column, value, n)``."""
    valid = F.col("value") != ""
    return values.groupBy("column").agg(
        F.coalesce(F.sum(F.when(valid, F.col("n"))), F.lit(0)).alias("n_valid"),
        F.coalesce(
            F.expr(f"sum(CASE WHEN {number_sql('value')} IS NOT NULL THEN n END)"),
            F.lit(0),
        ).alias("n_numeric"),
        F.count_if(valid).alias("n_unique"),
    )


def _text_columns(df: DataFrame) -> list[str]:
    return [
        f.name
        for f in df.schema
        if isinstance(f.dataType, T.StringType) and not is_categorical(f)
    ]


def _stringified(df: DataFrame) -> DataFrame:
    columns = []
    for field in df.schema:
        column = col(field.name)
        if isinstance(field.dataType, T.DateType):
            column = column.cast("string").alias(field.name)
        elif isinstance(field.dataType, (T.TimestampType, T.TimestampNTZType)):
            column = F.translate(column.cast("string"), " ", "T").alias(field.name)
        columns.append(column)
    return df.select(*columns)


def _stacked(df: DataFrame, names: Sequence[str]) -> DataFrame:
    """Stripped values of several columns as ``(column, value)`` rows."""
    values = df.select(*cols(names)).unpivot([], cols(names), "column", "value")
    return values.selectExpr("`column`", f"{stripped_sql('value')} AS value")


def _kinds(df, names, num_threshold, max_factor_levels) -> dict[str, str]:
    words = min(_WORDS_MAX, max(1, -(-4 * max_factor_levels // _WORD)))
    # One row per value, so that the generated code is as small for a hundred columns
    # as for one.
    values = _stacked(df, names).withColumnRenamed("value", "t")
    values = values.selectExpr(
        "*", f"{number_sql('t')} AS v", f"pmod(xxhash64(t), {_WORD * words}) AS h"
    )
    stats = [
        "count_if(t <> '') AS valid",
        "count(v) AS numeric",
        f"bool_and(v = floor(v) AND abs(v) < {double_literal(2.0**63)}) AS whole",
    ]
    for w in range(words):
        here = f"t <> '' AND h DIV {_WORD} = {w}"
        stats.append(f"bit_or(CASE WHEN {here} THEN shiftleft(1L, int(h % {_WORD})) END) AS seen{w}")
    rows = values.groupBy("column").agg(*map(F.expr, stats)).collect()
    found = {r["column"]: r for r in rows}
    kinds = {}
    for name in names:
        row = found.get(name)
        if row is None:  # a table without rows
            kinds[name] = "unchanged"
            continue
        valid, numeric = row["valid"], row["numeric"]
        seen = sum(
            ((row[f"seen{w}"] or 0) & (2**_WORD - 1)).bit_count() for w in range(words)
        )
        if valid == 0:
            kinds[name] = "unchanged"
        elif numeric / valid >= num_threshold:
            # No number at all only passes a threshold of 0: nothing speaks
            # against whole numbers then.
            kinds[name] = "double" if row["whole"] is False else "bigint"
        else:
            kinds[name] = "few" if seen <= max_factor_levels else "text"
    return kinds


def _levels(df, names, max_factor_levels) -> dict[str, list[str]]:
    """Sorted values of the columns that have few enough, a blank one included."""
    if not names:
        return {}
    by_value = Window.partitionBy("column").orderBy("value")
    # Blank values are levels too but do not count, hence room for two more rows.
    listed = (
        _stacked(df, names)
        .where(F.col("value").isNotNull())
        .distinct()
        .withColumn("nth", F.row_number().over(by_value))
        .where(F.col("nth") <= max_factor_levels + 2)
        .select("column", "value")
        .collect()
    )
    found: dict[str, list[str]] = {name: [] for name in names}
    for row in listed:
        found[row["column"]].append(row["value"])
    return {
        name: sorted(values)
        for name, values in found.items()
        if len([v for v in values if v != ""]) <= max_factor_levels
    }

"""Duplicate rows by key.

Equal keys meet in one task, but at most two rows per key and input task are sent
there: the row-number filters below let Spark cut each key's rows before the
shuffle.  A key that fills a third of the table therefore costs no more than any
other.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.columns import col, cols
from ..sources.scratch import written_if_costly
from .schema import ROW_ORDER, require_columns

_NTH = "__nth"
_COUNT = "__count"


def deduplicate_rows(
    df: DataFrame,
    mode: str = "keep_first",
    by: Sequence[str] | None = None,
    *,
    order_by: Sequence[str | Column] | None = None,
    protect: Column | None = None,
    protect_col: str | None = None,
    protect_values: Iterable | None = None,
    protect_keys: DataFrame | None = None,
) -> DataFrame:
    """Remove rows whose key ``by`` (default: all columns) occurs more than once.

    ``keep_first`` keeps the first row of each key, in the order ``order_by``, or in the
    order of the source where :func:`scourline.import_data` has noted it down.  Rows of
    any other DataFrame have no order that holds, so without ``order_by`` a key of some
    columns is refused.  ``drop_all`` keeps only the keys that occur once.  Nulls equal
    each other in keys.  The noted order is dropped from the result.

    Protected rows always stay, and count as occurrences of their key.  They are
    given as a condition (``protect``), as values of a column (``protect_col`` and
    ``protect_values``), or as a table of values of some columns (``protect_keys``);
    a null is never protected by value.
    """
    named = [c for c in df.columns if c != ROW_ORDER]
    by = list(by) if by is not None else named
    require_columns(df, *by)
    if set(by) == set(named):
        df = df.select(*cols(named))  # equal rows need no order
    elif mode == "keep_first" and order_by is None and ROW_ORDER not in df.columns:
        raise ValueError(
            "keep_first by some columns needs order_by, or rows imported with keep_order"
        )
    if protect is None and (protect_keys is not None or protect_col is not None):
        # Read two or three times below, so what is more than a scan is written once.  (A
        # condition may be bound to the frame as it is.)
        df = written_if_costly(df)
    if mode == "keep_first":
        kept = _first_rows(df, by, order_by)
    elif mode == "drop_all":
        kept = _single_rows(df, by)
    else:
        raise ValueError(f"Unknown deduplication mode: {mode}")
    condition = _protection(df, protect, protect_col, protect_values)
    if condition is not None:
        # Protected rows pass straight from the scan, which the plain condition may
        # reach.  A window with the condition in its filter would have to hold every
        # row of every key.
        others = ~F.coalesce(condition, F.lit(False))
        kept, always = kept.where(others), df.where(condition)
        if protect_keys is not None:
            always = always.union(_matching(df.where(others), protect_keys))
    elif protect_keys is not None:
        always = _matching(df, protect_keys)
    else:
        return kept.drop(ROW_ORDER)
    if protect_keys is not None:
        kept = _matching(kept, protect_keys, how="left_anti")
    return always.union(kept).drop(ROW_ORDER)


def keep_first(df: DataFrame, by: Sequence[str] | None = None, **kwargs) -> DataFrame:
    return deduplicate_rows(df, "keep_first", by, **kwargs)


def drop_all(df: DataFrame, by: Sequence[str] | None = None, **kwargs) -> DataFrame:
    return deduplicate_rows(df, "drop_all", by, **kwargs)


def _first_rows(df, by, order_by) -> DataFrame:
    if set(by) == set(df.columns):
        # Rows with equal keys are equal: a plain hash aggregate, no order needed.
        return df.dropDuplicates()
    order_by = [ROW_ORDER] if order_by is None else order_by
    first = Window.partitionBy(*cols(by)).orderBy(*order_by)
    return (
        df.withColumn(_NTH, F.row_number().over(first))
        .where(F.col(_NTH) == 1)
        .drop(_NTH)
    )


def _single_rows(df, by) -> DataFrame:
    if set(by) == set(df.columns):
        return (
            df.groupBy(*cols(df.columns))
            .agg(F.count(F.lit(1)).alias(_COUNT))
            .where(F.col(_COUNT) == 1)
            .drop(_COUNT)
        )
    # Two rows are enough to know that a key is not single.
    key = Window.partitionBy(*cols(by))
    return (
        df.withColumn(_NTH, F.row_number().over(key.orderBy(*cols(by))))
        .where(F.col(_NTH) <= 2)
        .withColumn(_COUNT, F.count(F.lit(1)).over(key))
        .where(F.col(_COUNT) == 1)
        .drop(_NTH, _COUNT)
    )


def _protection(df, protect, protect_col, protect_values) -> Column | None:
    conditions = []
    if protect is not None:
        conditions.append(protect)
    if protect_col is not None and protect_values is not None:
        require_columns(df, protect_col)
        conditions.append(col(protect_col).isin(list(protect_values)))
    if not conditions:
        return None
    return reduce(lambda one, other: one | other, conditions)


def _matching(df: DataFrame, keys: DataFrame, how: str = "left_semi") -> DataFrame:
    require_columns(df, *keys.columns)
    side = keys.select(*[col(c).alias(f"__key_{c}") for c in keys.columns])
    on = [col(c).eqNullSafe(col(f"__key_{c}")) for c in keys.columns]
    return df.join(side, on, how)

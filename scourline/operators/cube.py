"""Counts and exact distinct counts over all combinations of dimensions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.columns import col, cols
from ..sources.scratch import written
from .schema import require_columns

_OUT = ("level", "column", "n_rows", "n_nulls", "n_distinct")


def quality_cube(
    df: DataFrame, dims: Sequence[str], columns: Sequence[str] | None = None
) -> DataFrame:
    """``(*dims, level, column, n_rows, n_nulls, n_distinct)`` for each cell of the cube.

    There is one row for each column of ``columns`` (default: all others) in each cell of
    each subset of ``dims``.  A dimension that is summed over is null, and its bit in
    ``level`` is set (the last dimension has bit 0), which tells it from a null of the data.
    Distinct values are counted exactly; nulls are none of them, and NaN is one.  An empty
    table gives no rows.

    Values are counted in the finest cells once and numbered; numbers that lie together are
    one bitmap in each cell.  Each dimension is then summed over by one shuffle in which
    bitmaps are merged, so there are as many shuffles as dimensions and the rows are not
    repeated for every subset.
    """
    dims = list(dims)
    columns = [c for c in df.columns if c not in dims] if columns is None else list(columns)
    require_columns(df, *dims, *columns)
    taken = [d for d in dims if d in _OUT]
    if taken:
        raise ValueError(f"dimensions have names of the result: {taken}")
    if not columns:
        raise ValueError("no column to count")
    # Dimensions go by numbered names, for a column may be one of them, too.
    axes = [f"__dim{i}" for i in range(len(dims))]
    named = [col(d).alias(a) for d, a in zip(dims, axes)]
    values = [_as_text(df, c) for c in columns]
    stacked = df.select(*named, *values).unpivot(cols(axes), cols(columns), "column", "value")
    counted = written(stacked.groupBy(*axes, "column", "value").agg(F.count("*").alias("n")))
    # Numbers must not change when a lost task is run again, so they are written.
    numbers = written(
        counted.where("value IS NOT NULL").select("column", "value").distinct()
        .withColumn("number", F.monotonically_increasing_id())
    )
    cells = counted.join(numbers, ["column", "value"], "left").groupBy(
        *axes, "column", F.bitmap_bucket_number("number").alias("bucket")
    ).agg(
        F.sum("n").alias("n"),
        F.bitmap_construct_agg(F.bitmap_bit_position("number")).alias("bits"),
    )
    cells = cells.withColumn("level", F.lit(0))
    for place, axis in enumerate(axes):
        bit = 1 << (len(axes) - 1 - place)
        cells = cells.withColumn("over", F.explode(F.array(F.lit(False), F.lit(True))))
        cells = cells.withColumn(axis, F.when(~F.col("over"), F.col(axis)))
        cells = cells.withColumn("level", F.col("level") + F.when(F.col("over"), bit).otherwise(0))
        cells = cells.groupBy(*axes, "level", "column", "bucket").agg(
            F.sum("n").alias("n"), F.bitmap_or_agg("bits").alias("bits")
        )
    found = cells.groupBy(*axes, "level", "column").agg(
        F.sum("n").alias("n_rows"),
        F.sum(F.when(F.col("bucket").isNull(), F.col("n")).otherwise(0)).alias("n_nulls"),
        F.sum(F.bitmap_count("bits")).alias("n_distinct"),
    )
    return found.select(*[F.col(a).alias(d) for a, d in zip(axes, dims)], *_OUT)


def _as_text(df: DataFrame, name: str) -> Column:
    value = col(name)
    if isinstance(df.schema[name].dataType, (T.DoubleType, T.FloatType)):
        value = value + F.lit(0.0)  # -0.0 and 0.0 are one value
    return value.cast("string").alias(name)

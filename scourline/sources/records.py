"""CSV records of files whose quoted values may hold line ends, read in parallel.

A line can only be cut into fields once it is known whether it starts inside quotes, which
depends on all lines before it.  But each line is a function of two states: where it ends
if it starts outside, and where if inside.  Such functions are chained in any grouping, so
each block of a file is summed up to one, the sums of a file's blocks are chained, and then
every block knows its start.  Only a row for each block is looked at in order; the lines
stay where their block is.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions.columns import cols
from ..operators.schema import ROW_ORDER
from .scratch import written

_BLOCK = ["__file", "__block"]


def whole_field(delim: str, quote: str) -> str:
    """Pattern of a complete field and the delimiter or end behind it.

    A quote opens a value only where a field starts; behind the closing quote, and in a
    value without quotes, it is a character like any other.  All repetitions are possessive,
    so that long values need no deep stack.
    """
    d, q = re.escape(delim), re.escape(quote)
    other = f"[^{d}]" if len(delim) == 1 else f"(?:(?!{d})[\\s\\S])"
    value = f"{q}[^{q}]*+(?:{q}{q}[^{q}]*+)*+{q}{other}*+"
    return f"(?:{value}|(?!{q}){other}*+)(?:{d}|(?![\\s\\S]))"


def ends_open(text: Column, delim: str, quote: str) -> Column:
    """Whether a line that starts outside quotes ends inside them."""
    rest = F.regexp_replace(text, F.lit("\\G" + whole_field(delim, quote)), F.lit(""))
    return F.when(F.contains(text, F.lit(quote)), rest != "").otherwise(False)


def is_open(text: str, delim: str, quote: str) -> bool:
    """:func:`ends_open` for a text at hand."""
    field, at = re.compile(whole_field(delim, quote)), 0
    while at < len(text):
        found = field.match(text, at)
        if not found:
            return True
        at = found.end()
    return False


def _chained(window, if_outside: Column, if_inside: Column) -> tuple[Column, Column, Column]:
    """Chains functions of the two states (0 outside, 1 inside) along a window.

    A function keeps the state, swaps it, or gives the same for both.  So the state at a row
    is that of the last row with one result, swapped as often as rows since then do so.
    Returns that result (null if there is none yet) with the swaps before it taken off, for
    the rows up to this one and for those before it, and the swaps before this row.
    """
    swaps = (if_outside & ~if_inside).cast("int")
    so_far = F.sum(swaps).over(window)
    mark = F.when(if_outside == if_inside, (if_outside.cast("int") + so_far) % 2)
    return mark, so_far, so_far - swaps


def _lines(spark: SparkSession, source: str, delim: str, quote: str) -> tuple[DataFrame, list[str]]:
    read = spark.read.option("lineSep", "\n").text(source)
    folders = read.columns[1:]
    text = F.col("value")
    lines = read.select(
        "value", *cols(folders),
        F.col("_metadata.file_path").alias("__file"),
        F.col("_metadata.file_block_start").alias("__block"),
        F.monotonically_increasing_id().alias("__row"),
        ends_open(text, delim, quote).alias("__out"),
        F.when(F.contains(text, F.lit(quote)), ends_open(F.concat(F.lit(quote), text), delim, quote))
        .otherwise(True)
        .alias("__in"),
        (F.trim(F.rtrim(text)) != "").alias("__some"),
    )
    return lines, folders


def _with_states(lines: DataFrame) -> DataFrame:
    """Number the lines of a block, and chain them from the block's start."""
    block = Window.partitionBy(*_BLOCK).orderBy("__row")
    mark, so_far, before = _chained(block, F.col("__out"), F.col("__in"))
    earlier = block.rowsBetween(Window.unboundedPreceding, -1)
    return (
        lines.withColumn("__at", F.row_number().over(block))
        .withColumn("__swaps", so_far)
        .withColumn("__swaps_before", before)
        .withColumn("__mark", mark)
        .withColumn("__mark_before", F.last("__mark", ignorenulls=True).over(earlier))
    )


def _state(start: Column, mark: str, swaps: str) -> Column:
    return (F.coalesce(F.col(mark), start) + F.col(swaps)) % 2


def _blocks(lines: DataFrame) -> DataFrame:
    """A row for each block: the state it starts in, and where the record open at its start
    and the first record of its file begin."""
    states = _with_states(lines.select(*_BLOCK, "__row", "__out", "__in", "__some"))
    begins = [_state(F.lit(s), "__mark_before", "__swaps_before") == 0 for s in (0, 1)]
    ends = [_state(F.lit(s), "__last_mark", "__all_swaps") for s in (0, 1)]
    sums = (
        states.groupBy(*_BLOCK)
        .agg(
            F.max_by("__mark", F.when(F.col("__mark").isNotNull(), F.col("__at"))).alias("__last_mark"),
            F.max("__swaps").alias("__all_swaps"),
            *[F.max(F.when(b, F.col("__at"))).alias(f"__begins{s}") for s, b in enumerate(begins)],
            F.min(F.when(F.col("__some"), F.col("__at"))).alias("__first"),
        )
        .withColumns({f"__ends{s}": end == 1 for s, end in enumerate(ends)})
    )
    order = Window.partitionBy("__file").orderBy("__block")
    earlier = order.rowsBetween(Window.unboundedPreceding, -1)
    mark, _, before = _chained(order, F.col("__ends0"), F.col("__ends1"))
    head = F.when(F.col("__first").isNotNull(), F.struct("__block", F.col("__first").alias("__at")))
    chained = (
        sums.withColumn("__mark", mark)
        .withColumn("__swaps_before", before)
        .withColumn("__mark_before", F.last("__mark", ignorenulls=True).over(earlier))
        .withColumn("__start", _state(F.lit(0), "__mark_before", "__swaps_before"))
        .withColumn("__open", F.when(F.col("__start") == 0, F.col("__ends0")).otherwise(F.col("__ends1")))
    )
    last = F.when(F.col("__start") == 0, F.col("__begins0")).otherwise(F.col("__begins1"))
    begun = F.when(last.isNotNull(), F.struct("__block", last.alias("__at")))
    return chained.select(
        *_BLOCK, "__start", "__open",
        F.last(begun, ignorenulls=True).over(earlier).alias("__carried"),
        F.min(head).over(Window.partitionBy("__file")).alias("__head"),
        (F.lead("__block").over(order).isNull()).alias("__final"),
    )


def split_records(spark: SparkSession, source: str, delim: str, quote: str) -> DataFrame:
    """``value`` (a record, line ends in quotes included), ``ROW_ORDER`` and the columns of
    partition folders; without blank records and without the first record of each file.

    Lines end with ``\\n`` or ``\\r\\n``; within quotes both are kept as they are.  A file
    may be cut into any splits.  Its text is shuffled once, by block; only the lines of
    records of several lines move again.  A file that ends inside quotes is an error, as
    all that follows a forgotten quote would be one value.
    """
    lines, folders = _lines(spark, source, delim, quote)
    blocks = written(_blocks(lines))
    broken = blocks.where("__final and __open").select("__file").take(1)
    if broken:
        raise ValueError(f"A quoted value is never closed in {broken[0][0]}")
    block = Window.partitionBy(*_BLOCK).orderBy("__row")
    begins = _state(F.col("__start"), "__mark_before", "__swaps_before") == 0
    begun = F.when(F.col("__begins"), F.struct("__block", "__at"))
    placed = (
        _with_states(lines)
        .join(blocks.drop("__open", "__final"), _BLOCK)
        .withColumn("__begins", begins)
        .withColumn("__begun", F.coalesce(F.last(begun, ignorenulls=True).over(block), "__carried"))
        .withColumn("__whole", F.col("__begins") & ~F.col("__out"))
        .where("__begun <> __head")
        .select("value", *cols(folders), "__file", "__block", "__at", "__begun", "__whole")
    )
    single = placed.where("__whole").select("value", *cols(folders), "__file", "__begun")
    parts = F.array_sort(F.collect_list(F.struct("__block", "__at", "value")))
    joined = F.array_join(F.transform(parts, lambda p: p["value"]), "\n")
    several = (
        placed.where("not __whole")
        .groupBy(*cols(folders), "__file", "__begun")
        .agg(joined.alias("value"))
        .select("value", *cols(folders), "__file", "__begun")
    )
    place = F.struct(
        F.col("__file").alias("file_path"),
        F.col("__begun.__block").alias("file_block_start"),
        F.col("__begun.__at").alias("row"),
    )
    bare = F.when(F.col("value").endswith("\r"), F.expr("left(value, length(value) - 1)"))
    return (
        single.unionByName(several)
        .select(F.coalesce(bare, "value").alias("value"), *cols(folders), place.alias(ROW_ORDER))
        .where(F.trim("value") != "")
    )

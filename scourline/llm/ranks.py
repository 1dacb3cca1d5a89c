"""Places of rows in their groups, without any group in one task."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .work import stored

_ROW_BITS = 33  # of monotonically_increasing_id


def ranked(df: DataFrame, group: str, order: list, label: str = "ranked") -> DataFrame:
    """``df`` with ``place``, counting from 0 in each ``group`` by ``order``, and ``n``, the
    rows of the group.

    The rows are cut into ranges of ``group`` and ``order`` and written, so a group of any
    size is spread over as many parts as it fills.  What meets by group is one count for
    each part that holds rows of it.  ``df`` is read twice (ranges are found by a sample of
    ``order``, which should be short).  Rows equal in ``group`` and ``order`` share a part
    and are numbered as they come.  ``group`` must not be null.
    """
    keys = [F.col(group).asc(), *order]
    placed = stored(
        df.repartitionByRange(*keys)
        .sortWithinPartitions(*keys)
        .withColumn("_at", F.monotonically_increasing_id()),
        label,
    ).withColumn("_part", F.shiftright("_at", _ROW_BITS))
    whole = Window.partitionBy(group)
    starts = (
        placed.groupBy(group, "_part")
        .agg(F.min("_at").alias("_first"), F.count(F.lit(1)).alias("_rows"))
        .withColumn("n", F.sum("_rows").over(whole))
        .withColumn("_to", F.sum("_rows").over(whole.orderBy("_part")))
        .select(group, "_part", "n", (F.col("_to") - F.col("_rows") - F.col("_first")).alias("_shift"))
    )
    return (
        placed.join(starts, [group, "_part"])
        .withColumn("place", F.col("_at") + F.col("_shift"))
        .drop("_at", "_part", "_shift")
    )

"""Joins of values with intervals, and look-ups as of a date, without a product of rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..sources.scratch import scratch_root, written
from .columns import col, cols, double_literal

#: Bins of the values, a power of two; an interval falls into at most 2 * log2 of them.
BINS = 1 << 12


def _edges(intervals: DataFrame, low: str, high: str) -> list[float]:
    """Values that cut the bounds of the intervals into about equal parts: BINS - 1 at most."""
    bounds = intervals.select(F.explode(F.array(col(low).cast("double"), col(high).cast("double"))).alias("v"))
    shares = [i / BINS for i in range(1, BINS)]
    found = bounds.where("v IS NOT NULL AND NOT isnan(v)").agg(F.percentile_approx("v", shares, 10 * BINS)).first()[0]
    return sorted(set(found or []))


def _bin(value: Column, edges: list[float]) -> Column:
    """Number of the bin: how many edges are at most ``value``, by halving."""
    if not edges:
        return F.lit(0)
    sorted_edges = F.expr(f"array({', '.join(map(double_literal, edges))})")
    halves = [1 << k for k in reversed(range(len(edges).bit_length()))]
    return F.aggregate(
        F.array(*map(F.lit, halves)),
        F.lit(0),
        lambda at, step: F.when(
            F.coalesce(F.get(sorted_edges, at + step - 1) <= value, F.lit(False)), at + step
        ).otherwise(at),
    )


def _cover(first: Column, last: Column, levels: int) -> Column:
    """The nodes ``(level, node)`` of a binary tree that cover the bins ``first`` to ``last``.

    From the leaves up: the first node of a level is taken if it is a right child, the last
    if it is a left one, and the rest is left to their parents.
    """
    kind = "array<struct<level:int,node:int>>"

    def node(take: Column, level: Column, at: Column) -> Column:
        return F.when(take, F.array(F.struct(level.alias("level"), at.alias("node")))).otherwise(F.array().cast(kind))

    def up(held: Column, level: Column) -> Column:
        a, b = held["a"], held["b"]
        take_a, take_b = (a < b) & (a % 2 == 1), (a < b) & (b % 2 == 1)
        return F.struct(
            F.shiftright(a + 1, 1).alias("a"),
            F.shiftright(b, 1).alias("b"),
            F.concat(held["nodes"], node(take_a, level, a), node(take_b, level, b - 1)).alias("nodes"),
        )

    begin = F.struct(first.alias("a"), (last + 1).alias("b"), F.array().cast(kind).alias("nodes"))
    return F.aggregate(F.array(*map(F.lit, range(levels))), begin, up)["nodes"]


def interval_join(
    points: DataFrame, intervals: DataFrame, value: str, low: str, high: str, on: Sequence[str] = ()
) -> DataFrame:
    """Each row of ``points`` with each interval that holds its ``value``, bounds included.

    The columns of both sides, but those of ``on`` once; other names must differ.  A null
    bound is open.  Null and NaN values lie in no interval; an interval whose bounds are NaN
    or the wrong way round holds nothing.  ``on`` are columns that must be equal as well.

    Values are cut into bins by the bounds.  Bins form a binary tree; an interval is held by
    the few nodes that cover it, a value looks in the nodes over its bin, so both sides meet
    by equality, and a wide interval costs no more rows than a narrow one.  Only levels that
    hold an interval are looked in.  A node is joined together with ``on``, and Spark splits
    a node that is frequent among the values.
    """
    edges = _edges(intervals, low, high)
    lowest, highest = F.lit(0), F.lit(len(edges))
    first = F.when(col(low).isNull(), lowest).otherwise(_bin(col(low).cast("double"), edges))
    last = F.when(col(high).isNull(), highest).otherwise(_bin(col(high).cast("double"), edges))
    sound = F.coalesce(~F.isnan(col(low).cast("double")), F.lit(True)) & F.coalesce(~F.isnan(col(high).cast("double")), F.lit(True))
    held = intervals.withColumn("__first", first).withColumn("__last", last)
    held = held.where(sound & (F.coalesce(col(low) <= col(high), F.lit(True))))
    own = [c for c in intervals.columns if c not in on]
    nodes = _cover(F.col("__first"), F.col("__last"), len(edges).bit_length() + 2)
    held = held.select(*cols(on), *cols(own), F.explode(nodes).alias("__node"))
    used = [r[0] for r in held.select("__node.level").distinct().collect()]
    over = [
        F.struct(F.lit(level).alias("level"), F.shiftright("__bin", level).cast("int").alias("node"))
        for level in sorted(used)
    ]
    found = points.withColumn("__bin", _bin(col(value).cast("double"), edges))
    found = found.where(col(value).isNotNull() & ~F.isnan(col(value).cast("double")))
    found = found.withColumn("__node", F.explode(F.array(*over)) if over else F.lit(None))
    if not over:
        return found.limit(0).crossJoin(intervals.limit(0).drop(*on)).drop("__bin", "__node")
    joined = found.join(held, ["__node", *on])
    inside = F.coalesce(col(value) >= col(low), F.lit(True)) & F.coalesce(col(value) <= col(high), F.lit(True))
    return joined.where(inside).select(*cols(points.columns), *cols(own))


def interval_counts(
    points: DataFrame, intervals: DataFrame, value: str, low: str, high: str, weight: str, on: Sequence[str]
) -> DataFrame:
    """``intervals`` with the weight of all points of their group ``on`` (``n_all``), and of
    those that an interval holds (``n_inside``): what :func:`interval_join` finds, summed up.

    No pairs are made.  A count is the difference of two running sums along the values, one
    up to the upper bound and one below the lower.  Values and bounds, equal ones as one row,
    are dealt by bins of about equal size; the sums of a group's bins are run through first,
    then each bin goes on from its own start.  So neither a group nor a bin with many
    intervals is held by one task, and the work grows with the rows of both sides.  Points
    whose value is null count nowhere, those with NaN in ``n_all`` only.
    """
    first = F.coalesce(col(low).cast("double"), F.lit(float("-inf"))) + F.lit(0.0)  # no negative zero
    last = F.coalesce(col(high).cast("double"), F.lit(float("inf"))) + F.lit(0.0)
    bounded = intervals.withColumn("__low", first).withColumn("__high", last)
    ends = bounded.select(*cols(on), F.explode(F.array("__low", "__high")).alias("__x"))
    seen = points.where(col(value).isNotNull())
    seen = seen.select(*cols(on), (col(value).cast("double") + F.lit(0.0)).alias("__x"), col(weight).alias("__n"), F.lit(False).alias("__end"))
    both = seen.unionByName(ends.withColumn("__n", F.lit(0).cast("long")).withColumn("__end", F.lit(True)))
    places = both.groupBy(*cols(on), "__x").agg(F.sum("__n").alias("__n"), F.max("__end").alias("__end"))
    places = written(places) if scratch_root(places.sparkSession) else places  # else each use reads the points again
    places = places.withColumn("__bin", _bin(F.col("__x"), _edges(places, "__x", "__x")))
    group = Window.partitionBy(*cols(on))
    sums = places.groupBy(*cols(on), "__bin").agg(F.sum("__n").alias("__of_bin"))
    sums = sums.withColumn("__before", F.sum("__of_bin").over(group.orderBy("__bin")) - F.col("__of_bin"))
    sums = sums.withColumn("__all", F.sum("__of_bin").over(group)).drop("__of_bin")
    run = F.sum("__n").over(Window.partitionBy(*cols(on), "__bin").orderBy("__x"))
    known = places.withColumn("__run", run).where("__end").join(sums, [*on, "__bin"])
    upto = F.col("__before") + F.col("__run")
    lower = known.select(*cols(on), F.col("__x").alias("__low"), (upto - F.col("__n")).alias("__below"), "__all")
    upper = known.select(*cols(on), F.col("__x").alias("__high"), upto.alias("__upto"))
    found = bounded.join(lower, [*on, "__low"], "left").join(upper, [*on, "__high"], "left")
    sound = ~F.isnan("__low") & ~F.isnan("__high") & (F.col("__low") <= F.col("__high"))
    inside = F.when(sound, F.col("__upto") - F.col("__below"))
    return found.select(
        *cols(intervals.columns),
        F.coalesce("__all", F.lit(0)).alias("n_all"),
        F.coalesce(inside, F.lit(0)).alias("n_inside"),
    )


def as_of(wanted: DataFrame, known: DataFrame, on: Sequence[str], at: str, values: Sequence[str]) -> DataFrame:
    """``wanted`` (``on`` and ``at``) with the ``values`` of the last row of ``known`` up to ``at``.

    Rows of both sides are put in one order for each key, and the last known row is carried
    on: one shuffle by key, no pairs.  Of several known rows with one key and date any may
    be taken, so these should be refused before.  Null where there is no earlier row, or
    where a key or date is null.
    """
    carried = F.struct(*cols(values)).alias("__known")
    nothing = F.lit(None).cast(known.select(carried).schema["__known"].dataType).alias("__known")
    both = known.select(*cols(on), col(at), carried, F.lit(0).alias("__side")).unionByName(
        wanted.select(*cols(on), col(at), nothing, F.lit(1).alias("__side"))
    )
    before = Window.partitionBy(*cols(on)).orderBy(col(at), "__side")
    both = both.withColumn("__known", F.last("__known", ignorenulls=True).over(before))
    usable = F.lit(True)
    for name in [*on, at]:
        usable = usable & col(name).isNotNull()
    return both.where("__side = 1").select(
        *cols(on), col(at), *[F.when(usable, F.col("__known").getField(v)).alias(v) for v in values]
    )

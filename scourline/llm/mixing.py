"""Mixing by iterative proportional fitting, in DataFrame functions alone.

Documents are summed to cells (one for each source, language and topic that occurs
together).  The tokens of the cells are raked: scaled in turn to the target shares of each
dimension until all hold.  A document is then kept with a probability proportional to the
weight of a token of its cell.
"""

from __future__ import annotations

import warnings
from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .work import stored


SWEEPS = 4  # of all dimensions in one job
MOST_JOBS = 25
TOLERANCE = 1e-6
ONE_TASK_CELLS = 100_000

_BLANK = r"[\x20\x09-\x0D]+"


def n_tokens(text: Column) -> Column:
    """Number of blank-separated tokens; none in a null text."""
    found = F.size(F.array_remove(F.split(text, _BLANK), ""))
    return F.when(text.isNull(), 0).otherwise(found).cast("long")


def topic_of(tokens: Column) -> Column:
    """A stand-in for a topic where a table has none: how long the text is."""
    return F.when(tokens < 100, "note").when(tokens < 1000, "article").otherwise("book")


def _shared(cells: DataFrame, dim: str, target) -> DataFrame:
    """``cells`` with ``share_<dim>``, the target share of each cell's level."""
    level = Window.partitionBy(dim)
    if isinstance(target, Mapping):
        given = F.lit(None).cast("double")
        for name, share in target.items():
            given = F.when(F.col(dim) == name, float(share)).otherwise(given)
        raw = F.coalesce(given, F.lit(0.0))
    else:  # an exponent: shares between those of the data (1) and equal ones (0)
        raw = F.pow(F.sum("tokens").over(level), F.lit(float(target)))
    cells = cells.withColumn("raw", raw).withColumn("one", F.row_number().over(level.orderBy("cell")))
    whole = F.sum(F.when(F.col("one") == 1, F.col("raw"))).over(Window.partitionBy(F.lit(1)))
    return cells.withColumn(f"share_{dim}", F.col("raw") / whole).drop("raw", "one")


def rake(cells: DataFrame, targets: Mapping[str, object]) -> DataFrame:
    """``cells`` (the dimensions and ``tokens``) with ``fitted``, their tokens in the mix, and
    ``gap``, the most by which a share of one of their levels differs from its target.

    ``targets`` gives for each dimension a dictionary of shares (levels that it lacks get
    nothing) or an exponent for the shares of the data.  Shares are scaled to the levels
    that occur.  Where the targets cannot all hold, as some cells do not occur, the last
    dimension does after the last sweep, and ``gap`` stays above ``TOLERANCE``.  Cells without tokens stay at none.
    """
    cells = stored(cells.select("*", F.monotonically_increasing_id().alias("cell")), "cells")
    # Few rows are raked in one task without any exchange; more of them by Spark's windows.
    few = cells.count() <= ONE_TASK_CELLS
    together = (lambda df: df.coalesce(1)) if few else (lambda df: df)
    cells = together(cells)
    for dim, target in targets.items():
        cells = _shared(cells, dim, target)
    total = F.sum("tokens").over(Window.partitionBy(F.lit(1)))
    cells = cells.withColumn("total", total).withColumn("fitted", F.col("tokens").cast("double"))
    for _ in range(MOST_JOBS):
        for _ in range(SWEEPS):
            for dim in targets:
                sum_now = F.sum("fitted").over(Window.partitionBy(dim))
                scale = F.when(sum_now > 0, F.col(f"share_{dim}") * F.col("total") / sum_now)
                cells = cells.withColumn("fitted", F.col("fitted") * F.coalesce(scale, F.lit(0.0)))
        off = F.lit(0.0)
        for dim in targets:
            sum_now = F.sum("fitted").over(Window.partitionBy(dim))
            off = F.greatest(off, F.abs(sum_now / F.col("total") - F.col(f"share_{dim}")))
        cells = together(stored(cells.withColumn("off", off), "raked"))
        worst = cells.agg(F.max("off")).first()[0]
        if worst is None or worst <= TOLERANCE:
            break
        cells = cells.drop("off")
    else:
        warnings.warn(f"targets are missed by up to {worst:.2g} of all tokens", stacklevel=2)
        cells = cells.withColumn("off", off)
    return cells.withColumnRenamed("off", "gap")


def calibrated(cells: DataFrame, budget: float) -> DataFrame:
    """``cells`` with ``weight`` (of a token) and ``probability`` of a document.

    Probabilities are ``c * weight``, one at most, with ``c`` such that the expected tokens
    are ``budget`` of all; if the cells with weight have fewer, all of these are kept.
    """
    weight = F.when(F.col("tokens") > 0, F.col("fitted") / F.col("tokens")).otherwise(0.0)
    cells = stored(cells.withColumn("weight", weight), "weights")
    factor, capped = 0.0, -1
    while True:
        full = F.col("weight") * F.lit(factor) >= 1 if capped >= 0 else F.lit(False)
        row = cells.agg(
            F.count(F.when(full, 1)).alias("capped"),
            F.coalesce(F.sum(F.when(full, F.col("tokens"))), F.lit(0)).alias("taken"),
            F.coalesce(F.sum(F.when(~full, F.col("fitted"))), F.lit(0.0)).alias("open"),
            F.coalesce(F.sum("tokens"), F.lit(0)).alias("all"),
        ).first()
        if row.capped == capped or row.open <= 0:
            break
        capped, factor = row.capped, max((budget * row.all - row.taken) / row.open, factor)
    if row.open <= 0 and capped >= 0:
        probability = F.when(F.col("weight") > 0, 1.0).otherwise(0.0)
    else:
        probability = F.least(F.lit(1.0), F.col("weight") * F.lit(factor))
    return cells.withColumn("probability", probability)


def mix(docs: DataFrame, targets: Mapping[str, object], budget: float, seed: int = 17) -> DataFrame:
    """``docs`` with ``weight`` (of a token), ``probability``, ``kept`` and ``gap`` (of its
    cell, see :func:`rake`: above ``TOLERANCE`` where the targets cannot all hold).

    ``docs`` has ``doc_id``, ``tokens`` and the dimensions that ``targets`` names.  A row
    is kept if a uniform hash of ``seed`` and its ``doc_id`` is below its probability, so
    the choice is the same in every run and rows with equal ids share it.

    A null level is a level of its own (a dictionary gives it nothing).  Rows without
    tokens take the probability of their cell, those of a cell without tokens get none.
    Columns of ``docs`` that bear one of the four new names are replaced, all others stay.
    An empty table gives an empty one.
    """
    if not 0 < budget <= 1:
        raise ValueError("budget is a share of all tokens: above 0, at most 1")
    dims = list(targets)
    cells = docs.groupBy(*dims).agg(F.sum("tokens").alias("tokens"))
    fate = calibrated(rake(cells, targets), budget)
    fate = stored(fate.select(F.struct(*dims).alias("cell"), "weight", "probability", "gap"), "fate")
    own = [c for c in docs.columns if c not in ("weight", "probability", "kept", "gap")]
    whole = docs.select(
        F.struct(*[F.col(f"`{c}`") for c in own]).alias("row"),
        F.struct(*dims).alias("of_cell"), F.col("doc_id").alias("id"),
    )
    chance = F.shiftrightunsigned(F.xxhash64(F.lit(seed), "id"), 11) / F.lit(float(1 << 53))
    found = whole.join(fate, F.col("of_cell").eqNullSafe(F.col("cell")))
    return found.select(
        *[F.col("row").getField(c).alias(c) for c in own], "weight", "probability",
        (chance < F.col("probability")).alias("kept"), "gap",
    )

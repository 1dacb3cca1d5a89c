"""Exact interpolated quantiles of many columns at once, in bounded memory.

Spark's ``percentile`` keeps every distinct value of a column in one map, which a
continuous column of a large table outgrows.  Here each wanted order statistic is closed in
on instead, for all columns in the same two passes:

* a mergeable quantile sketch of each column proposes two cut values around each wanted
  rank, at the error bound of the sketch;
* one exact count of the values below, at and between the cuts.  The few values between the
  two cuts of a rank are counted one by one, so that the running count shows which of them
  has the rank.

The sketch only proposes cuts: bad ones cost two more passes within a smaller bracket, never
the result.  So do tables so large that more than ``settle`` values lie between two cuts;
each pair of passes narrows a bracket by a factor of some hundred.
"""

from __future__ import annotations

import math
from bisect import bisect_left
from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.columns import double_literal, quoted
from ..sources.scratch import written_if_costly

#: Size parameter of the sketches: about 20 bytes of it for each column and task.
_SKETCH = 2048


def _error() -> float:
    """Share of the ranks by which a sketch is off at most, in 99 of 100 cases."""
    return 2.296 / _SKETCH**0.9021


@dataclass
class _Bracket:
    """Values of a column strictly between ``low`` and ``high``: ``inside`` of them, after
    ``below`` others; some wanted ranks (from 0, in the whole column) lie there."""

    column: str
    ranks: list[int]
    below: int
    inside: int
    low: float | None = None
    high: float | None = None

    def values(self) -> str:
        conditions = []
        if self.low is not None:
            conditions.append(f"{self.column} > {double_literal(self.low)}")
        if self.high is not None:
            conditions.append(f"{self.column} < {double_literal(self.high)}")
        if not conditions:
            return self.column
        return f"CASE WHEN {' AND '.join(conditions)} THEN {self.column} END"

    def fractions(self, rank: int) -> tuple[float, float]:
        """Where in the bracket a rank lies at least and at most, by the sketch."""
        at, slack = (rank - self.below) / self.inside, _error() + 2 / self.inside
        return max(0.0, at - slack), min(1.0, at + slack)


@dataclass
class Quantiles:
    """What is known of one column: its quantiles in the order asked for (empty if
    it holds no number), its numbers, its NaNs and the rows of the table."""

    count: int
    nans: int
    rows: int
    values: list[float] = field(default_factory=list)


def exact_quantiles(
    df: DataFrame, probabilities: Mapping[str, Sequence[float]], settle: int = 250_000
) -> dict[str, Quantiles]:
    """Linearly interpolated quantiles (type 7) of numeric columns.

    Nulls and NaN are left out; NaNs are counted, for the caller to decide.  ``settle`` is
    how many values of a column may be sorted one by one.
    """
    names = list(probabilities)
    if not names:
        return {}
    for p in (p for ps in probabilities.values() for p in ps):
        if not 0.0 <= p <= 1.0:
            raise ValueError(f"Quantile outside [0, 1]: {p}")
    # Short names keep the generated code readable and free of quoting.
    short = {name: f"c{i}" for i, name in enumerate(names)}
    columns = []
    for name in names:
        value = f"CAST({quoted(name)} AS DOUBLE)"
        if isinstance(df.schema[name].dataType, (T.DoubleType, T.FloatType)):
            columns.append(f"isnan({quoted(name)}) AS nan_{short[name]}")
            value = f"CASE WHEN NOT isnan({quoted(name)}) THEN {value} END"
        columns.append(f"{value} AS {short[name]}")
    # Every pass reads the input anew: a plan beyond a scan runs once and is written, with
    # the columns that count.
    values = written_if_costly(df.selectExpr(*columns))
    wanted = {short[name]: list(ps) for name, ps in probabilities.items()}
    found, grids = _summaries(values, wanted)
    known: dict[tuple[str, int], float] = {}
    brackets = []
    for column, ps in wanted.items():
        n = found[column].count
        ranks = sorted({r for p in ps for r in _ranks(n, p)})
        if ranks:
            brackets.append(_Bracket(column, ranks, 0, n))
    while brackets:
        if grids is None:
            grids = _sketched(values, brackets, settle)
        cuts = [_cuts(b, grids.get(i), settle) for i, b in enumerate(brackets)]
        brackets = _counted(values, brackets, cuts, settle, known)
        grids = None
    for column, ps in wanted.items():
        n = found[column].count
        found[column].values = [
            _interpolate(n, p, [known[column, r] for r in _ranks(n, p)]) for p in ps if n
        ]
    return {name: found[short[name]] for name in names}


def _ranks(n: int, p: float) -> list[int]:
    if n == 0:
        return []
    position = (n - 1) * p
    return sorted({math.floor(position), math.ceil(position)})


def _interpolate(n: int, p: float, found: list[float]) -> float:
    low, high = found[0], found[-1]
    if low == high:
        return low
    part = (n - 1) * p - math.floor((n - 1) * p)
    if math.isinf(low) or math.isinf(high):
        return (1.0 - part) * low + part * high
    return low + part * (high - low)


def _long(values: DataFrame, columns: Sequence[str]) -> DataFrame:
    """One row ``(i, v)`` for each of some expressions, without those that are null."""
    rows = ", ".join(f"struct({i} AS i, {c} AS v)" for i, c in enumerate(columns))
    return values.selectExpr(f"inline(array({rows}))").where("v IS NOT NULL")


def _quantiles_of_sketch(fractions: Sequence[float]) -> str:
    listed = ", ".join(map(double_literal, fractions))
    sketch = f"kll_sketch_agg_double(v, {_SKETCH})"
    return f"if(count(v) > 0, kll_sketch_get_quantile_double({sketch}, array({listed})), NULL) AS cuts"


Grid = dict[float, float]


def _summaries(values: DataFrame, wanted) -> tuple[dict[str, Quantiles], dict[int, Grid]]:
    """Rows, numbers and NaNs of each column, and its sketch at the fractions to cut at."""
    error = _error()
    near = {f for ps in wanted.values() for p in ps for f in (p - error, p + error)}
    fractions = sorted({0.0, 1.0, *(min(1.0, max(0.0, f)) for f in near)})
    nan = [f"nan_{c}" if f"nan_{c}" in values.columns else "false" for c in wanted]
    rows = ", ".join(f"struct({i} AS i, {c} AS v, {n} AS nan)" for i, (c, n) in enumerate(zip(wanted, nan)))
    summed = values.selectExpr(f"inline(array({rows}))").groupBy("i").agg(
        F.count(F.lit(1)).alias("rows"), F.count("v").alias("n"),
        F.count_if("nan").alias("nans"), F.expr(_quantiles_of_sketch(fractions)),
    )
    found = {c: Quantiles(0, 0, 0) for c in wanted}
    grids, names = {}, list(wanted)
    for row in summed.collect():
        found[names[row["i"]]] = Quantiles(row["n"], row["nans"], row["rows"])
        if row["n"]:
            grids[names[row["i"]]] = dict(zip(fractions, row["cuts"]))
    some = [c for c in wanted if found[c].count and wanted[c]]
    return found, {i: grids[c] for i, c in enumerate(some)}


def _sketched(values: DataFrame, brackets: list[_Bracket], settle: int) -> dict[int, Grid]:
    """The sketches of brackets that are too large to be sorted, at the fractions to cut at."""
    large = [i for i, b in enumerate(brackets) if b.inside > settle]
    if not large:
        return {}
    fractions = sorted({f for i in large for r in brackets[i].ranks for f in brackets[i].fractions(r)})
    rows = _long(values, [brackets[i].values() for i in large]).groupBy("i")
    found = rows.agg(F.expr(_quantiles_of_sketch(fractions))).collect()
    return {large[row["i"]]: dict(zip(fractions, row["cuts"])) for row in found}


def _cuts(bracket: _Bracket, grid: Grid | None, settle: int) -> list[tuple[float, float]]:
    """A pair of values around each wanted rank; none where all values may be sorted."""
    if bracket.inside <= settle or not grid:
        return []
    fractions = sorted(grid)
    pairs = []
    for rank in bracket.ranks:
        low, high = bracket.fractions(rank)
        under = [f for f in fractions if f <= low]
        over = [f for f in fractions if f >= high]
        pairs.append((grid[under[-1] if under else fractions[0]], grid[over[0] if over else fractions[-1]]))
    return pairs


def _bucket(cuts: list[float]) -> str:
    """Number of the bucket of ``v``: 2k under the k-th cut (from 0), 2k + 1 at it."""
    whens = [
        f"WHEN v < {cut} THEN {2 * k} WHEN v = {cut} THEN {2 * k + 1}"
        for k, cut in enumerate(map(double_literal, cuts))
    ]
    return f"CASE {' '.join(whens)} ELSE {2 * len(cuts)} END" if cuts else "0"


def _counted(values, brackets, pairs, settle, known) -> list[_Bracket]:
    """Count all brackets exactly; what has its value goes to ``known``, the rest comes back.

    Values are counted by bucket, and one by one in the buckets between the cuts of a rank.
    Counts come together by bracket; the running count of a bracket passes each rank once.
    """
    cuts = [sorted({c for pair in of for c in pair}) for of in pairs]
    single = []
    for bracket, own, of in zip(brackets, cuts, pairs):
        if not own:
            single.append([0])
            continue
        # Values between two cuts are as many as the sketch is off, about; if those are too
        # many to be sorted, the next pair of passes works between them.
        few = 2 * (_error() * bracket.inside + 2) <= settle
        spans = [range(2 * bisect_left(own, low) + 2, 2 * bisect_left(own, high) + 1, 2) for low, high in of]
        single.append(sorted({b for span in spans for b in span}) if few else [])
    per_bracket = " ".join(f"WHEN {i} THEN {_bucket(own)}" for i, own in enumerate(cuts))
    alone = " ".join(
        f"WHEN {i} THEN bucket IN ({', '.join(map(str, of))})" for i, of in enumerate(single) if of
    )
    alone = f"CASE WHEN CASE i {alone} ELSE false END THEN v END" if alone else "CAST(NULL AS DOUBLE)"
    running = Window.partitionBy("i").orderBy("bucket", "v")
    ranks = " ".join(
        f"WHEN {i} THEN array({', '.join(f'{r - b.below}L' for r in b.ranks)})" for i, b in enumerate(brackets)
    )
    hits = (
        _long(values, [b.values() for b in brackets])
        .selectExpr("i", "v", f"CASE i {per_bracket} END AS bucket")
        .selectExpr("i", "bucket", f"{alone} AS v")
        .groupBy("i", "bucket", "v")
        .agg(F.count(F.lit(1)).alias("n"))
        .withColumn("upto", F.sum("n").over(running))
        .withColumn("hit", F.expr(f"filter(CASE i {ranks} END, r -> r >= upto - n AND r < upto)"))
        .where("size(hit) > 0")
    )
    left = []
    for row in hits.collect():
        bracket, own, bucket = brackets[row["i"]], cuts[row["i"]], row["bucket"]
        ranks_here = [r + bracket.below for r in row["hit"]]
        value = own[bucket // 2] if bucket % 2 else row["v"]
        if value is not None:
            known.update({(bracket.column, r): value for r in ranks_here})
            continue
        low = own[bucket // 2 - 1] if bucket else bracket.low
        high = own[bucket // 2] if bucket // 2 < len(own) else bracket.high
        below = bracket.below + row["upto"] - row["n"]
        left.append(_Bracket(bracket.column, ranks_here, below, row["n"], low, high))
    return left

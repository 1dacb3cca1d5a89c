"""Candidates for the most frequent values of text columns with very many values.

A sketch of bounded size finds the values that may be frequent, with a bound on how
frequent any other can be; the candidates are then counted exactly.  A column whose best
candidate is above the bound is settled without a shuffle of its values.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.columns import quoted

#: Values that a sketch keeps count of, and of these the candidates that are counted anew.
TRACKED = 8192
CANDIDATES = 64


def _hashed(df: DataFrame, names: Sequence[str]) -> DataFrame:
    """``(i, value, h)`` for each value of some columns; sketches keep hashes, not texts."""
    rows = ", ".join(f"struct({i} AS i, CAST({quoted(n)} AS STRING) AS value)" for i, n in enumerate(names))
    long = df.selectExpr(f"inline(array({rows}))").where("value IS NOT NULL")
    return long.withColumn("h", F.xxhash64("value"))


def most_frequent(df: DataFrame, names: Sequence[str]) -> dict[str, list[str]]:
    """All values with the highest count, for the columns where candidates settle it.

    A value that is no candidate is rarer than twice the error of the sketch, or than the
    last candidate where there are as many as asked for.  Where the best exact count of a
    candidate does not exceed that, as in a column of single values, the column is left out.
    """
    long = _hashed(df, names)
    sketch = f"approx_top_k(h, {CANDIDATES}, {TRACKED})"
    bounds, chosen = {}, {}
    for row in long.groupBy("i").agg(F.count("h").alias("n"), F.expr(sketch).alias("top")).collect():
        error = 2 * 3.5 / TRACKED * row["n"]
        last = row["top"][-1]["count"] if len(row["top"]) == CANDIDATES else 0
        bounds[row["i"]] = max(error, last)
        chosen[row["i"]] = [t["item"] for t in row["top"]]
    listed = {i: of for i, of in chosen.items() if of}
    if not listed:
        return {}
    tests = " ".join(f"WHEN {i} THEN h IN ({', '.join(f'{h}L' for h in of)})" for i, of in listed.items())
    counted = long.where(f"CASE i {tests} ELSE false END").groupBy("i", "value").agg(F.count("h").alias("n"))
    best: dict[int, tuple[int, list[str]]] = {}
    for row in counted.collect():  # as many rows as candidates, but for equal hashes
        most, values = best.get(row["i"], (0, []))
        if row["n"] > most:
            best[row["i"]] = (row["n"], [row["value"]])
        elif row["n"] == most:
            values.append(row["value"])
    return {names[i]: values for i, (most, values) in best.items() if most > bounds[i]}

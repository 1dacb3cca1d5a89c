"""What a cleaning run changed, in numbers."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.columns import double_literal, quoted, text_literal


def cleaning_report(
    before: DataFrame,
    after: DataFrame,
    bounds: Mapping[str, tuple[float, float]] | None = None,
) -> DataFrame:
    """``(column, rows_before, rows_after, nulls_before, nulls_after, capped)``.

    One row for each column that both tables have.  ``bounds`` are the clamps that
    were applied; ``capped`` counts the values of ``before`` outside them, and is null
    for a column that was not clamped.  One aggregation per table.
    """
    names = [c for c in before.columns if c in after.columns]
    bounds = bounds or {}
    capped = {}
    for name, (low, high) in bounds.items():
        value = f"CAST({quoted(name)} AS DOUBLE)"
        capped[name] = (
            f"count_if({value} < {double_literal(low)} OR {value} > {double_literal(high)})"
        )
    first = _counted(before, names, "before", capped)
    return first.join(_counted(after, names, "after", None), "column").select(
        "column", "rows_before", "rows_after", "nulls_before", "nulls_after", "capped"
    )


def _counted(df, names, suffix, capped) -> DataFrame:
    counters, structs = [f"count(1) AS rows_{suffix}"], []
    for i, name in enumerate(names):
        counters.append(f"count_if({quoted(name)} IS NULL) AS n{i}")
        fields = [
            f"{text_literal(name)} AS `column`", f"rows_{suffix}", f"n{i} AS nulls_{suffix}"
        ]
        if capped is not None:
            counters.append(f"{capped.get(name, 'CAST(NULL AS BIGINT)')} AS k{i}")
            fields.append(f"k{i} AS capped")
        structs.append(f"struct({', '.join(fields)})")
    return df.selectExpr(*counters).select(F.expr(f"inline(array({', '.join(structs)}))"))

"""Categorical columns: a string column whose metadata lists its levels.

Spark has no factor type.  A categorical column here is a ``StringType`` column
with field metadata ``{"levels": [...], "ordered": bool}``; the metadata survives
projections by name, joins and Parquet, but not expressions, so operators put it
back with :func:`with_levels` as the last step.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def with_levels(
    column: Column, name: str, levels: Sequence[str], ordered: bool = False
) -> Column:
    return column.alias(name, metadata={"levels": list(levels), "ordered": ordered})


def is_categorical(field: T.StructField) -> bool:
    return isinstance(field.dataType, T.StringType) and "levels" in field.metadata


def levels_of(df: DataFrame, name: str) -> list[str] | None:
    field = df.schema[name]
    return list(field.metadata["levels"]) if is_categorical(field) else None


def is_ordered(df: DataFrame, name: str) -> bool:
    return bool(df.schema[name].metadata.get("ordered", False))


def level_ordinal(column: Column, levels: Sequence[str]) -> Column:
    """0-based position of a value in ``levels``; -1 if absent, null if null."""
    known = F.array(*[F.lit(level) for level in levels])
    return (F.array_position(known, column) - 1).cast("int")

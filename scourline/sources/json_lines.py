"""Records of JSON, one in a line, as typed columns."""

from __future__ import annotations

import re
from collections.abc import Iterator, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.columns import col
from .csv import _distinct

_OBJECT = re.compile(r"`(?:[^`]|``)*`|\bOBJECT(?=<)")


def import_json_lines(
    lines: DataFrame, *, missing_strings: Sequence[str] = ("",), malformed: str = "error"
) -> DataFrame:
    """Typed columns from a DataFrame of JSON objects in its first column.

    Each line is parsed once into a variant.  One mergeable aggregate finds the types of all
    fields over all lines, so a field may be missing anywhere and no line is a header.  Whole
    numbers become bigint, other numbers double; a field that is a number in one line and
    another type in another becomes text.  Objects in objects become columns ``outer_inner``,
    with ``_1`` and so on where two names are the same; arrays stay arrays.  A field that is
    always null, or holds only empty objects, is a text column of nulls.  ``missing_strings``
    are null in text columns.

    Blank lines and null lines are passed over.  A line that is no object, is broken or names a
    field twice fails the job, or is left out with ``malformed="drop"``.  No record at all
    is an error.
    """
    if malformed not in ("error", "drop"):
        raise ValueError(f"Unknown way with malformed lines: {malformed}")
    text = lines.select(col(lines.columns[0]).alias("value")).where(F.trim("value") != "")
    records = text.select("value", F.try_parse_json("value").alias("record"))
    sound = F.coalesce(F.schema_of_variant("record").startswith("OBJECT<"), F.lit(False))
    if malformed == "error":
        message = F.concat(F.lit("Not a JSON object: "), "value")
        sound = F.when(sound, True).otherwise(F.raise_error(message).cast("boolean"))
    records = records.where(sound).select("record")
    found = records.agg(F.schema_of_variant_agg("record"), F.count("record")).first()
    if not found[1]:
        raise ValueError("JSON text is empty")
    record = _plain(_parsed(found[0]))
    typed = records.select(F.col("record").cast(record).alias("record"))
    leaves = list(_leaves(record, F.col("record"), ""))
    if not leaves:
        raise ValueError("JSON records have no fields")
    names = _distinct([name for name, _, _ in leaves], lines.sparkSession)
    columns = []
    for name, (_, kind, value) in zip(names, leaves):
        if isinstance(kind, T.StringType) and missing_strings:
            value = F.when(~value.isin(*missing_strings), value)
        columns.append(value.alias(name))
    return typed.select(*columns)


def _parsed(schema: str) -> T.StructType:
    """The type that the aggregate spells, with OBJECT for a struct."""
    return T.DataType.fromDDL(_OBJECT.sub(lambda m: "STRUCT" if m[0] == "OBJECT" else m[0], schema))


def _plain(kind: T.DataType) -> T.DataType:
    """Types that a cleaning run works on."""
    if isinstance(kind, T.StructType):
        return T.StructType([T.StructField(f.name, _plain(f.dataType)) for f in kind])
    if isinstance(kind, T.ArrayType):
        return T.ArrayType(_plain(kind.elementType))
    if isinstance(kind, (T.DecimalType, T.FloatType)):
        return T.DoubleType()
    if isinstance(kind, (T.NullType, T.VariantType)):
        return T.StringType()
    return kind


def _leaves(kind: T.StructType, value: Column, prefix: str) -> Iterator[tuple[str, T.DataType, Column]]:
    for field in kind:
        name, inner = prefix + field.name, value.getField(field.name)
        if isinstance(field.dataType, T.StructType) and len(field.dataType):
            yield from _leaves(field.dataType, inner, f"{name}_")
        elif isinstance(field.dataType, T.StructType):
            yield name, T.StringType(), F.lit(None).cast("string")
        else:
            yield name, field.dataType, inner

"""Column references by exact name, dots and spaces included, and SQL spellings.

Operators that need many generated expressions spell them in SQL: building each of
them from Column calls costs a few milliseconds per call on the driver.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F


def quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def text_literal(value: str) -> str:
    return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"


def double_literal(value: float) -> str:
    return f"double('{float(value)!r}')"


def col(name: str) -> Column:
    return F.col(quoted(name))


def cols(names: Iterable[str]) -> list[Column]:
    return [col(name) for name in names]

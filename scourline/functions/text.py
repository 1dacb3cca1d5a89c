"""Column expressions on text: stripping, snake case, guarded number parsing."""

from __future__ import annotations

import unicodedata

from pyspark.sql import Column
from pyspark.sql import functions as F

from .columns import text_literal

# The characters stripped from both ends of a text value
# (ASCII white space, NEL and the Unicode space separators).
BLANKS = (
    " \t\n\u000b\f\r\u0085  "
    "           "
    "  　"
)

# What counts as a number.  The guard keeps out suffixed Java literals such as
# "1d", and it means text values never reach the cast and its error path.
NUMBER_PATTERN = r"^[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?$"
NUMBER_WORDS = ("INF", "+INF", "-INF", "INFINITY", "+INFINITY", "-INFINITY", "NAN")


def stripped_sql(text: str) -> str:
    """A text column without the blanks at its ends.

    Trimming a set of characters is slow, so it is left to values that begin or end
    with an ASCII blank or hold a character beyond ASCII.
    """
    ends = " OR ".join(f"endswith({text}, {text_literal(c)})" for c in " \t\n\x0b\f\r")
    return (
        f"CASE WHEN {text} < '!' OR {ends} OR octet_length({text}) <> char_length({text})"
        f" THEN trim(BOTH {text_literal(BLANKS)} FROM {text}) ELSE {text} END"
    )


def number_sql(text: str) -> str:
    """Double value of an already stripped text, null where it is not a number.

    Signs, dots and digits all sort before ":", so most words are told apart by one
    comparison, without the pattern.
    """
    words = ", ".join(map(text_literal, NUMBER_WORDS))
    return (
        f"CASE WHEN {text} < ':' AND {text} RLIKE r'{NUMBER_PATTERN}'"
        f" OR length({text}) BETWEEN 3 AND 9 AND upper({text}) IN ({words})"
        f" THEN try_cast({text} AS DOUBLE) END"
    )


def snake_case(text: Column) -> Column:
    """The column-name rules of ``standardize_colnames`` applied to values."""
    return F.trim(F.regexp_replace(F.lower(text), r"[^\p{L}\p{N}]+", "_"), F.lit("_"))


def snake_case_name(name: str) -> str:
    """Lower-case a name and join its runs of letters and digits with ``_``."""
    kept = [
        ch if unicodedata.category(ch)[0] in "LN" else " " for ch in name.lower()
    ]
    return "_".join("".join(kept).split())

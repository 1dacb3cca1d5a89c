"""Column-level building blocks and the fixed tables they use."""

from .levels import is_categorical, is_ordered, level_ordinal, levels_of, with_levels
from .lookup import add_lookup
from .text import number_sql, snake_case, snake_case_name, stripped_sql

__all__ = [
    "add_lookup",
    "is_categorical",
    "is_ordered",
    "level_ordinal",
    "levels_of",
    "number_sql",
    "snake_case",
    "snake_case_name",
    "stripped_sql",
    "with_levels",
]

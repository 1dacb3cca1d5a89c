"""Cleaning of tabular data on Spark: every operator takes and returns DataFrames."""

from .operators import *  # noqa: F401,F403
from .plans import export_pipeline, pipeline
from .sources import discard_written, exchange_rates, export_cleaned, import_data
from .sources import import_json_lines, import_lines

__all__ = [name for name in dir() if not name.startswith("_")]

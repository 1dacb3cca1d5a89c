"""Where data comes from and goes to."""

from .csv import export_cleaned, import_data, import_lines, infer_csv_types
from .json_lines import import_json_lines
from .rates import exchange_rates
from .scratch import discard_written, written

__all__ = [
    "discard_written",
    "exchange_rates",
    "export_cleaned",
    "import_data",
    "import_json_lines",
    "import_lines",
    "infer_csv_types",
    "written",
]

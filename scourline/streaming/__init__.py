"""The row-local steps on a stream.

Column names, normalisation, lookups, constants and the exchange-rate join look at
one row at a time, so they need no state and work on a streaming DataFrame as they
are.  Steps that need a statistic of the whole table (types, duplicates, quantiles,
medians, modes) do not.  Keeping the first row of each key works with a watermark.
"""

from .dedup import keep_first_stream
from .rowlocal import clean_stream

__all__ = ["clean_stream", "keep_first_stream"]

"""What a cleaning run changed, cell by cell."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.columns import col, cols, quoted
from ..sources.scratch import written
from .schema import require_columns

_OUT = ("column", "value", "n_before", "n_after")


def cleaning_diff(before: DataFrame, after: DataFrame, keys: Sequence[str]) -> DataFrame:
    """``(*keys, column, value, n_before, n_after)``: where two tables differ.

    Rows belong together by ``keys``, which may repeat and may be null.  For each key, each
    column that both tables have and each value as text (null is a value, too) stands how
    many rows of the key hold it before and after, if the numbers differ.  A changed cell
    of a single row so gives its old value with 1 and 0 and its new one with 0 and 1.  One
    row more for each key that differs has a null ``column``: how many of its rows have no
    equal row on the other side.  It is there even if two rows only swapped their values.
    Equal tables give no row, repeated rows are counted.

    Only two hashes of 64 bits of each row are shuffled, with equal rows counted before
    that.  Whole rows are looked at for the keys that differ, and these are joined by
    Spark's own choice: by broadcast as long as they are few.
    """
    keys = list(keys)
    require_columns(before, *keys)
    require_columns(after, *keys)
    if not keys:
        raise ValueError("rows can only be told apart by a key")
    taken = [k for k in keys if k in _OUT]
    if taken:
        raise ValueError(f"keys have names of the result: {taken}")
    kinds, others = dict(before.dtypes), dict(after.dtypes)
    names = [c for c in before.columns if c in others and c not in keys]
    as_text = {
        c for c in names
        if kinds[c] != others[c] or not isinstance(before.schema[c].dataType, T.AtomicType)
    }
    gaps = _gaps(before, after, keys, names, as_text)
    rows = gaps.select(
        *cols(keys), F.lit(None).cast("string").alias("column"),
        F.lit(None).cast("string").alias("value"), "n_before", "n_after",
    )
    if not names:
        return rows
    sides = []
    for df, here, there in ((before, "n_before", "n_after"), (after, "n_after", "n_before")):
        texts = [F.expr(f"CAST({quoted(c)} AS STRING)").alias(c) for c in names]
        cells = _of_keys(df.select(*cols(keys), *texts), gaps, keys)
        cells = cells.unpivot(cols(keys), cols(names), "column", "value")
        sides.append(cells.select("*", F.lit(1).alias(here), F.lit(0).alias(there)))
    counted = sides[0].unionByName(sides[1]).groupBy(*cols(keys), "column", "value").agg(
        F.sum("n_before").alias("n_before"), F.sum("n_after").alias("n_after")
    )
    return counted.where("n_before <> n_after").unionByName(rows)


def _gaps(before, after, keys, names, as_text) -> DataFrame:
    """Keys with rows that one side has more often, and how many such rows each side has."""
    parts = []
    for name in names:
        # A null does not change a hash, so whether there is one is hashed, too.
        value = f"CAST({quoted(name)} AS STRING)" if name in as_text else quoted(name)
        parts += [f"{quoted(name)} IS NULL", value]
    hashed = ", ".join(parts or ["0"])
    digests = []
    for df, sign in ((before, 1), (after, -1)):
        digests.append(
            df.select(
                *cols(keys),
                F.expr(f"xxhash64({hashed})").alias("__first"),
                F.expr(f"xxhash64(1, {hashed})").alias("__second"),
                F.lit(sign).alias("__sign"),
            )
        )
    net = digests[0].unionByName(digests[1]).groupBy(*cols(keys), "__first", "__second").agg(
        F.sum("__sign").alias("__net")
    )
    gaps = net.where("__net <> 0").groupBy(*cols(keys)).agg(
        F.sum(F.greatest("__net", F.lit(0))).alias("n_before"),
        F.sum(F.greatest(-F.col("__net"), F.lit(0))).alias("n_after"),
    )
    return written(gaps)


def _of_keys(df: DataFrame, gaps: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows whose key is one of ``gaps``; null keys are equal."""
    wanted = gaps.select(*[col(k).alias(f"__key{i}") for i, k in enumerate(keys)])
    same = F.lit(True)
    for i, key in enumerate(keys):
        same = same & df[quoted(key)].eqNullSafe(wanted[f"__key{i}"])
    return df.join(wanted, same, "left_semi")

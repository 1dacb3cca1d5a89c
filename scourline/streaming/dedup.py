"""The first row of each key of a stream, by event time.

A row may only leave once no earlier row of its key can come, so the best row so far waits
in the state until the watermark has passed it.  Keys are dealt to a fixed number of groups,
and the rows of a group are looked at together: a call of Python costs some milliseconds,
which a call for each key and batch would pay for every key.
"""

from __future__ import annotations

import pickle
from collections.abc import Iterator, Sequence

import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from ..functions.columns import col
from ..operators.schema import require_columns

_GROUP, _KEYS, _TIME = "__group", "__key", "__micros"


def keep_first_stream(
    stream: DataFrame,
    by: Sequence[str],
    event_time: str,
    delay: str,
    ties: Sequence[str] = (),
    groups: int = 1024,
) -> DataFrame:
    """The first row of each key ``by``, in the order of ``event_time`` and then ``ties``.

    As :func:`scourline.keep_first` with ``order_by=[event_time, *ties]`` gives it for all
    rows that were in time.  ``delay`` (such as ``"2 hours"``) is how late a row may come:
    rows behind the watermark are late and are left out, whether their key is known or not.
    A key's row leaves, once, when the watermark passes it.  Rows that have not been passed
    when a stream ends stay in its state.  Rows without event time are left out; null keys
    are equal, null ties come first.

    The state holds one row of each key that waits, and each key that is done.  It has one
    entry for each of ``groups`` groups of keys, and a batch writes the entries anew that it
    has rows of; streams of very many keys in small batches take more groups.  The number
    must stay the same as long as a checkpoint is used.
    """
    require_columns(stream, *by, event_time, *ties)
    rows = stream.where(col(event_time).isNotNull()).withWatermark(event_time, delay)
    key = F.to_json(F.struct(*[col(c).alias(f"k{i}") for i, c in enumerate(by)]), {"ignoreNullFields": "false"})
    # pandas makes whole numbers with nulls double, so these go with a mark and a zero.
    columns, back, fields, order = [], [], [], {}
    for i, field in enumerate(stream.schema):
        value, kind, marked = col(field.name), field.dataType, field.nullable and isinstance(field.dataType, T.IntegralType)
        if marked:
            columns.append(value.isNotNull().alias(f"has{i}"))
            fields.append(T.StructField(f"has{i}", T.BooleanType()))
            given = F.when(F.col(f"has{i}"), F.col(f"c{i}"))
            back.append(given.alias(field.name, **({"metadata": field.metadata} if field.metadata else {})))
        else:
            back.append(F.col(f"c{i}").alias(field.name))
        columns.append((F.coalesce(value, F.lit(0).cast(kind)) if marked else value).alias(f"c{i}"))
        fields.append(T.StructField(f"c{i}", kind, field.nullable, field.metadata))
        order[field.name] = [f"has{i}", f"c{i}"] if marked else [f"c{i}"]
    names = [f.name for f in fields]
    sorting = [_TIME, *[c for tie in ties for c in order[tie]]]
    micros = F.unix_micros(col(event_time).cast("timestamp")).alias(_TIME)
    rows = rows.select(*columns, key.alias(_KEYS), micros)
    rows = rows.withColumn(_GROUP, F.pmod(F.xxhash64(_KEYS), F.lit(groups)))
    kept = [*names, _KEYS, _TIME]
    held = T.StructType([T.StructField("waiting", T.BinaryType()), T.StructField("done", T.BinaryType())])

    def firsts(frames: list[pd.DataFrame]) -> pd.DataFrame:
        whole = pd.concat(frames, ignore_index=True) if len(frames) > 1 else frames[0]
        return whole.sort_values(sorting, na_position="first", kind="stable").drop_duplicates(_KEYS)

    def first(k: tuple, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        waiting, done = map(_thawed, state.get) if state.exists else (None, pa.array([], pa.string()))
        passed = 1000 * state.getCurrentWatermarkMs()
        if waiting is not None:  # new rows that are in time come after those passed
            leaves = (waiting[_TIME] <= passed).to_numpy()
            if leaves.any():
                leaving, waiting = waiting[leaves], waiting[~leaves]
                done = pa.concat_arrays([done, pa.array(leaving[_KEYS], pa.string())])
                yield leaving[names]
        best: list[pd.DataFrame] = []
        if not state.hasTimedOut:
            for b in batches:
                b = b.loc[b[_TIME] > passed, kept]  # what is left out is late
                b = b[~pc.is_in(pa.array(b[_KEYS], pa.string()), value_set=done).to_numpy(zero_copy_only=False)]
                best = [firsts([*best, b])] if len(b) else best
        if waiting is not None and len(waiting):
            best = [firsts([*best, waiting])] if best else [waiting]
        state.update((_frozen(best[0] if best else None), _frozen(done)))
        if best:
            state.setTimeoutTimestamp(int(best[0][_TIME].min()) // 1000 + 1)

    found = rows.groupBy(_GROUP).applyInPandasWithState(
        first, T.StructType(fields), held, "append", GroupStateTimeout.EventTimeTimeout
    )
    return found.select(*back)


def _frozen(part: pd.DataFrame | pa.Array | None) -> bytes:
    return pickle.dumps(part)


def _thawed(data: bytes) -> pd.DataFrame | pa.Array | None:
    """What this state itself has frozen."""
    return pickle.loads(data)

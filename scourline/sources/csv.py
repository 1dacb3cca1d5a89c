"""CSV in and out."""

from __future__ import annotations

import csv
import re
from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.columns import col, cols, quoted, text_literal
from ..functions.text import number_sql
from ..operators.schema import ROW_ORDER
from .records import ends_open, is_open, split_records

_INTEGER = r"^[+-]?\d+$"
_DATE = r"^\d{4}-\d{2}-\d{2}$"
_QUOTES = {"quote": '"', "escape": '"'}
_SURPLUS = "__surplus"
#: Options of Spark's reader under which lines and quoted values are not what they are here.
_OWN_LINES = {"lineSep", "encoding", "charset", "comment", "ignoreLeadingWhiteSpace", "unescapedQuoteHandling"}
_TIMESTAMP = r"^\d{4}-\d{2}-\d{2}[T ]\d{2}:\d{2}:\d{2}(\.\d+)?$"


def import_data(
    spark: SparkSession,
    source: str,
    delim: str = ",",
    *,
    from_text: bool = False,
    missing_strings: Sequence[str] = ("",),
    ignore_repeated: bool = False,
    schema: T.StructType | str | None = None,
    infer: bool = True,
    multi_line: bool = False,
    keep_order: bool = False,
    surplus: str = "error",
    **options,
) -> DataFrame:
    """Read a headed CSV file or folder, or with ``from_text`` the CSV text itself.

    Quotes inside quoted values are doubled, as usual; a quote inside a value that does not
    start with one is a plain character.  Values with line ends need ``multi_line``, and are
    refused without it.  Such files are read in parallel, too (see
    :func:`scourline.sources.records.split_records`), unless an option of Spark's reader
    changes what a line or a quoted value is: then one task reads a whole file.  Header
    names that occur again get ``_1``, ``_2`` and so on; empty ones are ``_c0``, ``_c1``.
    Values listed in ``missing_strings`` become null before types are inferred.
    ``ignore_repeated`` treats a run of delimiters outside quotes as one.  Types come from
    ``schema``, whose names are those of the header, or from one pass over the data unless
    ``infer`` is off.  A value that ``schema`` cannot hold fails the job, and so does a
    record with more fields than the header (``surplus="drop"`` cuts it).  ``keep_order``
    adds the column ``ROW_ORDER``, by which :func:`scourline.keep_first` knows the rows'
    order.  Any other option goes to Spark's reader.
    """
    if surplus not in ("error", "drop"):
        raise ValueError(f"Unknown way with surplus fields: {surplus}")
    options = {**_QUOTES, **options}
    common = {
        "missing_strings": missing_strings, "ignore_repeated": ignore_repeated,
        "schema": schema, "infer": infer, "surplus": surplus, **options,
    }
    if from_text:
        records = list(enumerate(_records(source, delim, options["quote"])))
        lines = spark.createDataFrame(
            [(record, at) for at, record in records], f"value string, {ROW_ORDER} long"
        )
        df = import_lines(lines.coalesce(1), delim, **common)
        return df if keep_order else df.drop(ROW_ORDER)
    try:
        if not multi_line:
            _refuse_open_quotes(spark.read.text(source), delim, options["quote"])
        if ignore_repeated:
            if multi_line:
                raise ValueError("ignore_repeated works line by line, without multi_line")
            lines = _in_order(spark.read.text(source)).where(F.trim("value") != "")
            of_file = F.col(f"{ROW_ORDER}.file_path")
            heads = lines.groupBy(of_file).agg(F.min(ROW_ORDER).alias("head"))
            first = lines.orderBy(ROW_ORDER).first()
            if first is None:
                raise ValueError("CSV text is empty")
            lines = lines.join(heads, F.col(ROW_ORDER) == F.col("head"), "left_anti")
            df = import_lines(lines, delim, header=first["value"], **common)
            return df if keep_order else df.drop(ROW_ORDER)
        options = {"sep": delim, "multiLine": multi_line, **options}
        names = _file_names(spark, source, options)
        folders = spark.read.schema(f"{_SURPLUS} string").csv(source).columns[1:]
        wide = ", ".join(f"{quoted(n)} string" for n in [*names, _SURPLUS])
        if multi_line and options["quote"] == options["escape"] and not _OWN_LINES & options.keys():
            records = split_records(spark, source, delim, options["quote"])
            kept = [*folders, ROW_ORDER]
            parsed = F.from_csv("value", wide, {k: str(v) for k, v in options.items()})
            raw = records.select(parsed.alias("record"), *cols(kept)).select("record.*", *cols(kept))
            raw = raw if keep_order else raw.drop(ROW_ORDER)
        else:
            raw = spark.read.options(**options, header=True, enforceSchema=True).schema(wide).csv(source)
            raw = _in_order(raw) if keep_order else raw
    except AnalysisException as error:
        if error.getCondition() == "PATH_NOT_FOUND":
            raise ValueError(f"CSV file not found at: {source}") from error
        raise
    return _typed(_cut(raw, surplus), missing_strings, schema, infer)


def import_lines(
    lines: DataFrame,
    delim: str = ",",
    *,
    missing_strings: Sequence[str] = ("",),
    ignore_repeated: bool = False,
    schema: T.StructType | str | None = None,
    infer: bool = True,
    header: str | None = None,
    repeated_header: bool = False,
    surplus: str = "error",
    **options,
) -> DataFrame:
    """Parse a DataFrame of CSV records in its first column.

    The first record is the header unless ``header`` gives it.  Only that one record is
    left out; with ``repeated_header`` all records equal to the header are, as in the parts
    of a split file.  A column ``ROW_ORDER`` is kept.  Other options as for
    :func:`import_data`.
    """
    options = {**_QUOTES, **options}
    order = [ROW_ORDER] if ROW_ORDER in lines.columns else []
    value = col(lines.columns[0]).alias("value")
    at = F.monotonically_increasing_id().alias("__at")
    lines = lines.select(value, at, *order).where(F.trim("value") != "")
    if header is None:
        first = lines.first()
        if first is None:
            raise ValueError("CSV text is empty")
        header = first["value"]
        lines = lines.where(F.col("__at") != first["__at"])
    if repeated_header:
        lines = lines.where(F.col("value") != header)
    text = F.col("value")
    if ignore_repeated:
        text = _squeezed(text, delim, options["quote"])
    names = _header_names(header, delim, options["quote"], ignore_repeated)
    names = _distinct(names, lines.sparkSession)
    parsed = F.from_csv(
        text,
        ", ".join(f"{quoted(n)} string" for n in [*names, _SURPLUS]),
        {"sep": delim, **{k: str(v) for k, v in options.items()}},
    )
    raw = lines.select(parsed.alias("record"), *order).select("record.*", *order)
    return _typed(_cut(raw, surplus), missing_strings, schema, infer)


def _in_order(df: DataFrame) -> DataFrame:
    """Note down file, block and place of each row of a scan."""
    place = F.struct(
        "_metadata.file_path",
        "_metadata.file_block_start",
        F.monotonically_increasing_id().alias("row"),
    )
    return df.select("*", place.alias(ROW_ORDER))


def _cut(raw: DataFrame, surplus: str) -> DataFrame:
    """Drop the column behind those of the header, or fail where it has a value."""
    if surplus == "error":
        message = F.concat(F.lit("A CSV record has more fields than the header: "), _SURPLUS)
        failed = F.when(F.col(_SURPLUS).isNotNull(), F.raise_error(message).cast("boolean"))
        raw = raw.where(F.coalesce(failed, F.lit(True)))
    return raw.drop(_SURPLUS)


def _refuse_open_quotes(lines: DataFrame, delim: str, quote: str) -> None:
    """An error if a value in quotes runs over the end of its line."""
    if not quote:
        return
    broken = lines.where(ends_open(F.col("value"), delim, quote)).take(1)
    if broken:
        raise ValueError(
            f"A quoted value runs over a line end: {broken[0]['value'][:80]!r}; "
            "read the file with multi_line=True"
        )


def export_cleaned(
    df: DataFrame,
    path: str,
    delim: str = ",",
    *,
    mode: str = "errorifexists",
    format: str = "csv",
    partition_by: Sequence[str] = (),
    **options,
) -> None:
    """Write ``df`` to the folder ``path``, one file per partition.

    ``partition_by`` writes one sub-folder per value, e.g. one per year.  Quotes, line
    ends and blanks in CSV values are written so that :func:`import_data` gives them back
    (line ends with ``multi_line``).  Nulls and empty strings both read back from CSV as
    null; Parquet keeps them apart.
    """
    writer = df.write.mode(mode)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    if format == "csv":
        blanks = {"ignoreLeadingWhiteSpace": False, "ignoreTrailingWhiteSpace": False}
        plain = {"header": True, "sep": delim, **_QUOTES, **blanks}
        writer.options(**{**plain, **options}).csv(path)
    elif format == "parquet":
        writer.options(**options).parquet(path)
    else:
        raise ValueError(f"Unknown export format: {format}")


def infer_csv_types(df: DataFrame) -> DataFrame:
    """Give string columns the first type that all their non-null values have.

    Order: bigint, double, boolean, date, timestamp, else string.  One aggregation by
    column decides, then one projection converts.
    """
    names = [f.name for f in df.schema if isinstance(f.dataType, T.StringType)]
    if not names:
        return df
    checks = [
        F.expr(f"bool_and(CASE WHEN value IS NOT NULL THEN {parsed} IS NOT NULL END)").alias(kind)
        for kind, parsed in _candidates("value").items()
    ]
    values = df.select(*cols(names)).unpivot([], cols(names), "column", "value")
    found = {r["column"]: r for r in values.groupBy("column").agg(*checks).collect()}
    columns = []
    for field in df.schema:
        value = quoted(field.name)
        if field.name in found:
            for kind, parsed in _candidates(value).items():
                if found[field.name][kind]:
                    value = parsed
                    break
        columns.append(f"{value} AS {quoted(field.name)}")
    return df.selectExpr(*columns)


def _candidates(value: str) -> dict[str, str]:
    """How each type is parsed, null where a value does not have it."""

    def guarded(pattern: str, kind: str) -> str:
        return (
            f"CASE WHEN {value} RLIKE r'{pattern}' THEN try_cast({value} AS {kind}) END"
        )

    return {
        "bigint": guarded(_INTEGER, "bigint"),
        "double": number_sql(value),
        "boolean": guarded("^(?i)(true|false)$", "boolean"),
        "date": guarded(_DATE, "date"),
        "timestamp": guarded(_TIMESTAMP, "timestamp"),
    }


def _typed(raw: DataFrame, missing_strings, schema, infer: bool) -> DataFrame:
    markers = [m for m in missing_strings if m != ""]
    if markers:
        listed = ", ".join(map(text_literal, markers))
        raw = raw.selectExpr(
            *[
                f"CASE WHEN {n} NOT IN ({listed}) THEN {n} END AS {n}"
                for n in map(quoted, raw.columns)
            ]
        )
    if schema is not None:
        return _as_given(raw, schema)
    return infer_csv_types(raw) if infer else raw


def _as_given(raw: DataFrame, schema) -> DataFrame:
    """``raw`` with the columns and types of ``schema``, matched by name."""
    if isinstance(schema, str):
        schema = T.StructType.fromDDL(schema)
    present = [c for c in raw.columns if c != ROW_ORDER]
    absent = [n for n in schema.fieldNames() if n not in present]
    unknown = [n for n in present if n not in schema.fieldNames()]
    if absent or unknown:
        raise ValueError(f"The schema misses columns {unknown} and has others: {absent}")
    columns = []
    for field in schema:
        value, kind = col(field.name), field.dataType
        typed = value.try_cast(kind)
        message = F.concat(F.lit(f"Not of type {kind.simpleString()} in {field.name}: "), value)
        misfit = value.isNotNull() & typed.isNull()
        columns.append(F.when(misfit, F.raise_error(message).cast(kind)).otherwise(typed).alias(field.name))
    return raw.select(*columns, *[c for c in raw.columns if c == ROW_ORDER])


def _squeezed(text: Column, delim: str, quote: str) -> Column:
    """One delimiter for each run of them outside quotes, none at the ends."""
    d, q = f"(?:{re.escape(delim)})", re.escape(quote)
    plain = f"(?:(?!{d})[^{q}])++" if quote else f"(?:(?!{d}).)++"
    parts = f"(?:{q}[^{q}]*+{q}?|{plain})++" if quote else plain
    # Each match is a field and the run behind it, which becomes one delimiter.
    one = delim.replace("\\", "\\\\").replace("$", "\\$")
    begun = F.regexp_replace(text, f"^{d}++", "")
    single = F.regexp_replace(begun, f"(?s)\\G({parts}){d}++", "$1" + one)
    # What is left of a run at the end is outside quotes if it ends the last match.
    open_end = F.regexp_replace(single, f"(?s)\\G(?:{parts})(?:{d}|$)", "") == ""
    cut = F.substring(single, F.lit(1), F.length(single) - len(delim))
    return F.when(open_end & single.endswith(delim), cut).otherwise(single)


def _file_names(spark: SparkSession, source: str, options: dict) -> list[str]:
    """The header of the first file read, without the columns of partition folders."""
    read = spark.read.options(**options, header=False).csv(source)
    names = [c for c in read.columns if re.fullmatch(r"_c\d+", c)]
    first = read.select(names).first() if names else None
    if first is None:
        raise ValueError("CSV text is empty")
    last = (first[-1] or "").removesuffix("\r")  # lines may end otherwise than in the header
    return _distinct([*first[:-1], last], spark)


def _distinct(names: Sequence[str | None], spark: SparkSession) -> list[str]:
    """Column names from a header: empty ones get a number, repeated ones a suffix."""
    exact = spark.conf.get("spark.sql.caseSensitive") == "true"
    fold = (lambda n: n) if exact else str.lower
    names = [name or f"_c{i}" for i, name in enumerate(names)]
    taken, found = {fold(n) for n in names}, []
    seen: set[str] = set()
    for name in names:
        own, k = name, 0
        while fold(own) in seen or (k and fold(own) in taken):
            k += 1
            own = f"{name}_{k}"
        seen.add(fold(own))
        found.append(own)
    return found


def _header_names(header: str, delim: str, quote: str, ignore_repeated: bool) -> list[str]:
    if len(delim) == 1:
        names = next(csv.reader([header], delimiter=delim, quotechar=quote))
    else:
        names = header.split(delim)
    if ignore_repeated:
        names = [name for name in names if name]
    return names


def _records(text: str, delim: str, quote: str = '"') -> list[str]:
    """Lines of a CSV text, joined where a quoted value runs over a line end."""
    records, open_record = [], ""
    for line in text.splitlines(keepends=True):
        open_record += line
        if not (quote and is_open(open_record.rstrip("\r\n"), delim, quote)):
            records.append(open_record.rstrip("\r\n"))
            open_record = ""
    if open_record:
        records.append(open_record.rstrip("\r\n"))
    return [r for r in records if r.strip()]

"""A type profile that grows with its table: only files that are new are read.

The state is a folder of parts.  A part holds counted values of the files it has seen and
the names of these files, written by one job, so it is there as a whole or not at all.
Parts add up by value; from time to time they are added up into one.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .typing import _profiled, _stacked, _text_columns

#: As many parts are kept apart before they are added up.
PARTS_MAX = 8
_STATE = "column string, value string, n long, path string, length long, modified timestamp"


def grow_profile(
    spark: SparkSession, source: str, state: str, format: str = "parquet", **options
) -> int:
    """Bring the profile in the folder ``state`` up to date with the files below ``source``.

    Returns the number of files read, which are those that the state has not seen.  A file
    that has been changed or removed since makes the counts wrong, so it is an error: start
    a new state then.  ``format`` and ``options`` are as for ``spark.read``.  Files need not
    have the same columns; those without text columns count as seen.  One writer at a time.

    The driver gets the paths of the new files, as it does to read them; all else stays
    in the state.
    """
    seen = _parts(spark, state)
    known = _read(spark, state, seen).where("path IS NOT NULL").select("path", "length", "modified")
    found = _files(spark, source)
    both = found.alias("f").join(known.alias("k"), F.col("f.path") == F.col("k.path"), "full")
    status = both.select(
        F.coalesce("f.path", "k.path").alias("path"),
        F.when(F.col("k.path").isNull(), "new")
        .when(F.col("f.path").isNull(), "removed")
        .when((F.col("f.length") != F.col("k.length")) | (F.col("f.modified") != F.col("k.modified")), "changed")
        .alias("what"),
    ).where("what IS NOT NULL")
    rows = status.collect()
    stale = sorted(r["path"] for r in rows if r["what"] != "new")
    if stale:
        raise ValueError(f"files of the profile have been changed or removed, as {stale[0]}")
    new = sorted(r["path"] for r in rows)
    if not new:
        return 0
    df = spark.read.format(format).options(**options).load(new)
    names = _text_columns(df)
    marks = found.join(status.where("what = 'new'").select("path"), "path", "left_semi")
    part = marks.selectExpr("NULL AS column", "NULL AS value", "NULL AS n", "path", "length", "modified")
    if names:
        counted = _stacked(df, names).groupBy("column", "value").agg(F.count(F.lit(1)).alias("n"))
        part = counted.selectExpr("*", "NULL AS path", "NULL AS length", "NULL AS modified").unionByName(part)
    number = seen[-1][1] + 1 if seen else 0
    _write(part, state, number, number)
    if len(seen) + 1 > PARTS_MAX:
        _add_up(spark, state)
    return len(new)


def stored_profile(spark: SparkSession, state: str) -> DataFrame:
    """The profile of all files that ``state`` has seen, as of ``type_profile``."""
    counts = _read(spark, state, _parts(spark, state)).where("path IS NULL")
    return _profiled(counts.groupBy("column", "value").agg(F.sum("n").alias("n")))


def _files(spark: SparkSession, source: str) -> DataFrame:
    """Path, length and time of each file; contents are not read."""
    listed = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(source)
    return listed.select("path", "length", F.col("modificationTime").alias("modified"))


def _folder(spark: SparkSession, state: str):
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(state)
    return path, path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def _whole_parts(spark: SparkSession, state: str) -> list[tuple[int, int]]:
    """First and last number of each part that was written to its end."""
    folder, files = _folder(spark, state)
    if not files.exists(folder):
        return []
    paths = [status.getPath() for status in files.listStatus(folder)]
    mark = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
    done = [p.getName() for p in paths if files.exists(mark(p, "_SUCCESS"))]
    return sorted(tuple(map(int, name.split("-"))) for name in done)


def _parts(spark: SparkSession, state: str) -> list[tuple[int, int]]:
    """The parts to read: those that lie within no wider one."""
    whole = _whole_parts(spark, state)
    return [
        (a, b) for a, b in whole
        if not any(c <= a and b <= d and (c, d) != (a, b) for c, d in whole)
    ]


def _name(state: str, first: int, last: int) -> str:
    return f"{state.rstrip('/')}/{first:08d}-{last:08d}"


def _read(spark: SparkSession, state: str, parts) -> DataFrame:
    if not parts:
        return spark.createDataFrame([], _STATE)
    return spark.read.schema(_STATE).parquet(*[_name(state, a, b) for a, b in parts])


def _write(part: DataFrame, state: str, first: int, last: int) -> None:
    kinds = [field.split(" ") for field in _STATE.split(", ")]
    part = part.select(*[F.col(name).cast(kind).alias(name) for name, kind in kinds])
    part.write.mode("overwrite").parquet(_name(state, first, last))


def _add_up(spark: SparkSession, state: str) -> None:
    """Add the parts up into one.

    Those that it replaces stay until the next time, for frames that still read them.
    """
    parts = _parts(spark, state)
    _, files = _folder(spark, state)
    for first, last in set(_whole_parts(spark, state)) - set(parts):
        files.delete(spark.sparkContext._jvm.org.apache.hadoop.fs.Path(_name(state, first, last)), True)
    held = _read(spark, state, parts)
    counts = held.where("path IS NULL").groupBy("column", "value").agg(F.sum("n").alias("n"))
    counts = counts.selectExpr("*", "NULL AS path", "NULL AS length", "NULL AS modified")
    _write(counts.unionByName(held.where("path IS NOT NULL")), state, parts[0][0], parts[-1][1])

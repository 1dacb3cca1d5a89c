"""Written tables that cut the lineage between two steps of a pipeline."""

from __future__ import annotations

import atexit
import re
import shutil
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_paths: list[str] = []


def scratch_root(spark: SparkSession) -> str | None:
    """The shared folder of the cluster, or null where there is none to use.

    The checkpoint directory of the context decides: the one that the program set, else
    the one of ``spark.checkpoint.dir``.  Only a local session without either gets a temporary folder of its own, since a
    folder of one machine is of no use to the executors of a cluster.
    """
    context = spark.sparkContext
    root = context.getCheckpointDir() or spark.conf.get("spark.checkpoint.dir", None)
    if root is None and context.master.startswith("local"):
        root = tempfile.mkdtemp(prefix="scourline-")
        atexit.register(shutil.rmtree, root, ignore_errors=True)
        context.setCheckpointDir(root)
        root = context.getCheckpointDir()
    return root


def written(df: DataFrame) -> DataFrame:
    """Write ``df`` once as Parquet and read it back.

    Later passes then read only the columns they need from storage that outlives
    lost executors, instead of running the plan of ``df`` again.  Column metadata is
    kept.  On a cluster without a shared folder this is an error: passes over a plan that
    is run anew each time need not see the same rows.
    """
    root = scratch_root(df.sparkSession)
    if root is None:
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    path = f"{root.rstrip('/')}/scourline-{uuid.uuid4().hex}"
    _paths.append(path)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


#: What makes a plan dear to run again: all that shuffles, sorts, multiplies rows or
#: leaves the JVM.
_COSTLY = re.compile(
    r"^[ :+|-]*(Join|Aggregate|Window|WindowGroupLimit|Sort|Generate|Expand|Distinct|"
    r"Deduplicate|Repartition\w*|RebalancePartitions|\w*Python\w*|\w*Pandas|\w*Arrow)\b",
    re.MULTILINE,
)


def is_costly(df: DataFrame) -> bool:
    """Is there more to ``df`` than scans, projections, filters and unions?"""
    return bool(_COSTLY.search(df._jdf.queryExecution().optimizedPlan().toString()))


def written_if_costly(df: DataFrame) -> DataFrame:
    """``df``, written first where several passes would repeat more than a scan."""
    return written(df) if is_costly(df) else df


def written_so_far() -> int:
    """A mark for :func:`discard_written`: what is written later lies behind it."""
    return len(_paths)


def discard_written(spark: SparkSession, since: int = 0) -> int:
    """Delete the tables this program has written so, once their results are used.

    ``since`` is a mark of :func:`written_so_far`.  Returns how many were deleted.
    DataFrames that still read them fail afterwards.
    """
    hadoop = spark.sparkContext._jsc.hadoopConfiguration()
    count = max(len(_paths) - since, 0)
    while len(_paths) > since:
        path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(_paths.pop())
        path.getFileSystem(hadoop).delete(path, True)
    return count

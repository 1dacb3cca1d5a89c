"""Tables between the steps of an operator, and columns whose names cannot clash."""

from __future__ import annotations

import tempfile
import uuid
import zipfile
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from scourline.sources.scratch import scratch_root


def fresh_path(spark: SparkSession, label: str) -> str:
    """A new path in the folder that driver and executors share."""
    root = scratch_root(spark)
    if root is None:
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    return f"{root.rstrip('/')}/{label}-{uuid.uuid4().hex}"


def stored(df: DataFrame, label: str = "step") -> DataFrame:
    """Write ``df`` once and read it back: lost executors cannot undo it."""
    path = fresh_path(df.sparkSession, label)
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def bucketed(df: DataFrame, key: str, buckets: int, label: str = "step") -> DataFrame:
    """Write ``df`` in buckets of ``key``, so that later groupings by it move no row."""
    spark = df.sparkSession
    name = f"{label}_{uuid.uuid4().hex}"
    (
        df.repartition(buckets, key)
        .write.bucketBy(buckets, key)
        .sortBy(key)
        .option("path", fresh_path(spark, label))
        .option("compression", "zstd")
        .format("parquet")
        .saveAsTable(name)
    )
    return spark.table(name)


def text_bytes(df: DataFrame, column: str = "text") -> int:
    """UTF-8 bytes of a text column over all rows."""
    return df.agg(F.sum(F.octet_length(column))).first()[0] or 0


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


_shipped: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Give the Python workers this package, wherever it is imported from on the driver."""
    context = spark.sparkContext
    if context.applicationId not in _shipped:
        package = Path(__file__).resolve().parents[1]
        archive = Path(tempfile.mkdtemp()) / f"{package.name}.zip"
        with zipfile.ZipFile(archive, "w") as target:
            for source in sorted(package.rglob("*.py")):
                target.write(source, source.relative_to(package.parent))
        context.addPyFile(str(archive))
        _shipped.add(context.applicationId)

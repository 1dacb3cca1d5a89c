"""Every registered query against its SQL on DuckDB, on the smallest tables."""

import os
import re

import pytest

import __spark_entry__ as entry
from check_oracle import compare, oracle_connection

SF_DIR = os.environ.get("ORACLE_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="module")
def connection():
    if not os.path.isdir(SF_DIR):
        pytest.skip("no test tables")
    return oracle_connection(SF_DIR)


def test_every_query_has_sql():
    named = {n for n in entry.queries() if not re.match(r"op\d+_|pipeline$", n)}
    assert named <= set(entry.oracle_sql()) <= set(entry.queries())


@pytest.mark.parametrize("name", entry.oracle_sql())
def test_query(spark, connection, name):
    assert compare(spark, connection, SF_DIR, name) is None


def test_entry(spark):
    assert entry.entry(spark).count() > 0


def test_texts_are_written_by_many_tasks(spark, tmp_path, monkeypatch):
    """No task writes all texts, and files are still cut into splits when read."""
    texts = [(i, f'"{i}" said;\n' * 40) for i in range(400)]
    spark.createDataFrame(texts, "doc_id long, text string").repartition(4).write.parquet(str(tmp_path / "documents.parquet"))
    monkeypatch.setattr(entry, "_fresh_folder", lambda spark, name: str(tmp_path / name))
    names = ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")
    before = {n: spark.conf.get(n) for n in names}
    try:
        for n in names:
            spark.conf.set(n, "20000")
        found = entry.csv_roundtrip_text(spark, str(tmp_path))
        files = len(spark.read.text(str(tmp_path / "texts")).inputFiles())
        assert 1 < files < spark.read.text(str(tmp_path / "texts")).rdd.getNumPartitions()
        got = sorted(map(tuple, found.collect()))
    finally:
        for n, value in before.items():
            spark.conf.set(n, value)
    assert got == [(i, f'"{t}";\\\n "" ;end ') for i, t in texts]

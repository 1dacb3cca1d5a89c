"""Where written tables go, and who deletes them."""

from pathlib import Path
from urllib.parse import urlparse

import pytest

import scourline as sc
from scourline.sources import scratch


class Session:
    """As much of a session as the choice of a folder looks at."""

    def __init__(self, master="spark://host:7077", configured=None, chosen=None):
        self.sparkContext = self
        self.master, self.chosen = master, chosen
        self.conf = {"spark.checkpoint.dir": configured}
        self.sparkSession = self

    def getCheckpointDir(self):
        return self.chosen

    def setCheckpointDir(self, path):
        self.chosen = path


def test_the_folder_of_the_program_comes_first():
    both = Session(configured="hdfs://conf", chosen="hdfs://program/1")
    assert scratch.scratch_root(both) == "hdfs://program/1"
    assert scratch.scratch_root(Session(configured="hdfs://conf")) == "hdfs://conf"


def test_a_cluster_needs_a_shared_folder():
    assert scratch.scratch_root(Session()) is None
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        scratch.written(Session())
    assert Path(scratch.scratch_root(Session(master="local[2]"))).is_dir()


def test_exports_leave_nothing_behind(spark, tmp_path):
    (tmp_path / "in.csv").write_text("k,v,s\n1,2,a\n1,3,b\n2,,c\n")
    root = Path(urlparse(scratch.scratch_root(spark)).path)
    before = {p.name for p in root.glob("scourline-*")}
    out = sc.export_pipeline(
        str(tmp_path / "in.csv"), "light_clean", str(tmp_path / "out"), spark=spark, dedup_by=["k"]
    )
    assert {p.name for p in root.glob("scourline-*")} == before
    assert sorted((r["k"], r["v"]) for r in out.collect()) == [(1, 2.0), (2, 2.0)]

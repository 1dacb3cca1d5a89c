import os

import pytest

import scourline as sc
from scourline.operators import growing


def add(spark, folder, rows):
    spark.createDataFrame(rows, "a string, b string, n int").coalesce(1).write.mode("append").parquet(folder)


def same(spark, folder, state):
    grown = {tuple(r) for r in sc.stored_profile(spark, state).collect()}
    return grown == {tuple(r) for r in sc.type_profile(spark.read.parquet(folder)).collect()}


def test_only_new_files_are_read(spark, tmp_path):
    folder, state = str(tmp_path / "rows"), str(tmp_path / "state")
    add(spark, folder, [("1", " x ", 1), (None, "x", 2), ("1", "", 3)])
    assert sc.grow_profile(spark, folder, state) == 1
    assert same(spark, folder, state)
    assert sc.grow_profile(spark, folder, state) == 0
    for k in range(2):
        add(spark, folder, [(str(k), f"text {k}", k), ("1", None, k)])
    assert sc.grow_profile(spark, folder, state) == 2
    assert same(spark, folder, state)


def test_parts_are_added_up(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(growing, "PARTS_MAX", 2)
    folder, state = str(tmp_path / "rows"), str(tmp_path / "state")
    for k in range(7):
        add(spark, folder, [("1", f"value {k % 3}", k), (str(k), None, k)])
        assert sc.grow_profile(spark, folder, state) == 1
        assert same(spark, folder, state)
        assert len(growing._parts(spark, state)) <= 2
    assert len(os.listdir(state)) < 6
    assert sc.grow_profile(spark, folder, state) == 0


def test_a_broken_off_write_counts_for_nothing(spark, tmp_path):
    folder, state = str(tmp_path / "rows"), str(tmp_path / "state")
    add(spark, folder, [("1", "x", 1)])
    sc.grow_profile(spark, folder, state)
    add(spark, folder, [("2", "y", 1)])
    sc.grow_profile(spark, folder, state)
    (tmp_path / "state" / "00000001-00000001" / "_SUCCESS").unlink()
    assert sc.stored_profile(spark, state).where("column = 'a'").first()["n_valid"] == 1
    assert sc.grow_profile(spark, folder, state) == 1
    assert same(spark, folder, state)


def test_changed_files_are_refused(spark, tmp_path):
    folder, state = tmp_path / "rows", str(tmp_path / "state")
    add(spark, str(folder), [("1", "x", 1)])
    sc.grow_profile(spark, str(folder), state)
    one = next(folder.glob("*.parquet"))
    os.utime(one, (1, 1))
    with pytest.raises(ValueError, match="changed or removed"):
        sc.grow_profile(spark, str(folder), state)
    add(spark, str(folder), [("1", "x", 1)])
    one.unlink()
    with pytest.raises(ValueError, match="changed or removed"):
        sc.grow_profile(spark, str(folder), state)


def test_files_of_other_columns(spark, tmp_path):
    folder, state = tmp_path / "rows", str(tmp_path / "state")
    spark.range(3).coalesce(1).write.parquet(str(folder / "one"))
    assert sc.grow_profile(spark, str(folder), state) == 1
    assert sc.stored_profile(spark, state).count() == 0
    (folder / "two").mkdir()
    (folder / "two" / "lines.csv").write_text("7\n8\n")
    with pytest.raises(Exception):  # a CSV is no Parquet file, and nothing is kept
        sc.grow_profile(spark, str(folder), state)
    assert sc.grow_profile(spark, str(folder), state, "csv") == 1
    assert [tuple(r) for r in sc.stored_profile(spark, state).collect()] == [("_c0", 2, 2, 2)]

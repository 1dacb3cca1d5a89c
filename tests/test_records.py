"""Records with line ends in quotes, from files cut into many splits."""

import csv
import io
import random

import pytest
from pyspark.sql import functions as F

import scourline as sc
from scourline.sources.records import ends_open, is_open


@pytest.fixture
def small_splits(spark):
    names = ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")
    before = {n: spark.conf.get(n) for n in names}
    for n in names:
        spark.conf.set(n, "300")
    yield
    for n, value in before.items():
        spark.conf.set(n, value)


def table_of(r, size, width=4):
    parts = ["a", "b c", '"', '""', "\n", "\r\n", ",", ";", "é", "x" * 40, " ", "'"]
    return [
        [str(i), *["".join(r.choice(parts) for _ in range(r.randrange(9))) or "-" for _ in range(width)]]
        for i in range(size)
    ]


@pytest.mark.parametrize("ends", ["\n", "\r\n"])
def test_like_the_csv_module(spark, tmp_path, small_splits, ends):
    r = random.Random(4)
    folder = tmp_path / "many"
    folder.mkdir()
    want = []
    for part in range(3):
        rows = table_of(r, 150)
        rows[7][2] = "line\n" * 400  # a value over several splits
        rows = [[f"{part}-{row[0]}", *row[1:]] for row in rows]
        out = io.StringIO()
        csv.writer(out, lineterminator=ends).writerows([["id", "a", "b\nb", "c", "d"], *rows])
        (folder / f"{part}.csv").write_bytes(out.getvalue().encode())
        want += rows
    found = sc.import_data(spark, str(folder), multi_line=True, infer=False, keep_order=True)
    assert found.columns[:5] == ["id", "a", "b\nb", "c", "d"]
    scan = spark.read.text(str(folder))
    assert scan.rdd.getNumPartitions() > 20
    order = found.columns[-1]
    got = [list(row)[:5] for row in found.orderBy(order).collect()]
    assert got == want


def test_quotes_that_open_nothing(spark, tmp_path, small_splits):
    text = 'a,b\n5" tube,"ok"\n"say ""hi""","two\nlines, ""3"""\n6",7"\n\n"x"y,"z"\n'
    path = tmp_path / "q.csv"
    path.write_text(text)
    for way in ({"multi_line": True}, {"from_text": True}):
        source = text if "from_text" in way else str(path)
        got = sc.import_data(spark, source, infer=False, **way).collect()
        assert sorted(map(tuple, got)) == sorted(
            [('5" tube', "ok"), ('say "hi"', 'two\nlines, "3"'), ('6"', '7"'), ('"x"y', "z")]
        )
    path.write_text('a,b\n5" tube,"ok"\n')
    assert tuple(sc.import_data(spark, str(path)).first()) == ('5" tube', "ok")


def test_a_quote_that_is_never_closed(spark, tmp_path):
    path = tmp_path / "open.csv"
    path.write_text('a,b\n1,"x\n2,y\n')
    with pytest.raises(ValueError, match="never closed"):
        sc.import_data(spark, str(path), multi_line=True)
    with pytest.raises(ValueError, match="line end"):
        sc.import_data(spark, str(path))


def test_lines_as_functions_of_two_states(spark):
    lines = ["", "a", '"', '""', '"""', 'a"', '"a', 'a,"', '"a"', '"a""', '"a"","b', '"a""b",c', 'x"y,"z"', '"a"b"', ',,"']
    lines += ['"' + "z" * 100_000, '"' + '""' * 50_000, '"x",' * 20_000]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(lines)], "i int, t string")
    for delim in (",", "::"):
        got = [r[0] for r in df.orderBy("i").select(ends_open(F.col("t"), delim, '"')).collect()]
        assert got == [is_open(t, delim, '"') for t in lines]
    assert [is_open(t, ",", '"') for t in lines[:15]] == [
        False, False, True, False, True, False, True, True, False, True, False, False, False, False, True
    ]


def test_repeated_and_empty_header_names(spark, tmp_path):
    text = "a,b,A,,a_1,a\n1,2,3,4,5,6\n"
    path = tmp_path / "names.csv"
    path.write_text(text)
    want = {"a": 1, "b": 2, "A_2": 3, "_c3": 4, "a_1": 5, "a_3": 6}
    for df in (
        sc.import_data(spark, str(path)),
        sc.import_data(spark, str(path), multi_line=True),
        sc.import_data(spark, text, from_text=True),
    ):
        assert df.first().asDict() == want


def test_folders_of_a_partitioned_table(spark, tmp_path):
    df = spark.createDataFrame([(2020, 1, "x\ny"), (2021, 2, 'q"')], "year int, n long, s string")
    out = str(tmp_path / "by-year")
    sc.export_cleaned(df, out, partition_by=["year"])
    back = sc.import_data(spark, out, multi_line=True)
    assert sorted(map(tuple, back.select("year", "n", "s").collect())) == sorted(map(tuple, df.collect()))

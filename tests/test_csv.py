import datetime
from pathlib import Path

import pytest

import scourline as sc

TEXT = "col1,col2\n1,hello\n2,world\n"


@pytest.fixture
def csv_file(tmp_path):
    def write(text, name="data.csv"):
        path = tmp_path / name
        path.write_text(text, encoding="utf-8")
        return str(path)

    return write


def test_file_and_text(spark, csv_file):
    for df in (
        sc.import_data(spark, csv_file(TEXT)),
        sc.import_data(spark, TEXT, from_text=True),
    ):
        assert df.dtypes == [("col1", "bigint"), ("col2", "string")]
        assert sorted(map(tuple, df.collect())) == [(1, "hello"), (2, "world")]


def test_no_file(spark):
    with pytest.raises(ValueError, match="CSV file not found at: nowhere.csv"):
        sc.import_data(spark, "nowhere.csv")


def test_types(spark, csv_file):
    text = (
        "i;f;b;d;t;s;n\n"
        "1;1.5;true;2020-01-02;2020-01-02T03:04:05;x;\n"
        ";2;FALSE;;2020-01-02 03:04:06;1d;\n"
    )
    df = sc.import_data(spark, csv_file(text), ";")
    assert [kind for _, kind in df.dtypes] == [
        "bigint", "double", "boolean", "date", "timestamp", "string", "string"
    ]
    first = df.where("i = 1").first()
    assert first["d"] == datetime.date(2020, 1, 2) and first["b"] is True
    raw = sc.import_data(spark, csv_file(text), ";", infer=False)
    assert {kind for _, kind in raw.dtypes} == {"string"}
    given = sc.import_data(spark, csv_file(TEXT), schema="col2 string, col1 int")
    assert given.dtypes == [("col2", "string"), ("col1", "int")]
    assert sorted(map(tuple, given.collect())) == [("hello", 1), ("world", 2)]
    for other in ("a int, b string", "col1 int", "col1 int, col2 string, col3 int"):
        with pytest.raises(ValueError, match="schema"):
            sc.import_data(spark, csv_file(TEXT), schema=other)
    with pytest.raises(Exception, match="Not of type int in col2"):
        sc.import_data(spark, csv_file(TEXT), schema="col1 int, col2 int").collect()


def test_missing_strings(spark, csv_file):
    text = "a,b\n1,x\nNA,-\n3,NA\n"
    df = sc.import_data(spark, csv_file(text), missing_strings=["NA", "-"])
    assert df.dtypes == [("a", "bigint"), ("b", "string")]
    assert sorted(map(str, df.collect())) == sorted(
        ["Row(a=1, b='x')", "Row(a=None, b=None)", "Row(a=3, b=None)"]
    )


def test_repeated_delimiters(spark, csv_file):
    text = '  a   b c\n1    "x  y"   2\n 3 z   4  \n'
    for df in (
        sc.import_data(spark, csv_file(text), " ", ignore_repeated=True),
        sc.import_data(spark, text, " ", from_text=True, ignore_repeated=True),
    ):
        assert sorted(map(tuple, df.collect())) == [(1, "x  y", 2), (3, "z", 4)]
    pipes = sc.import_data(spark, "a|b\n1|||2\n", "|", from_text=True, ignore_repeated=True)
    assert pipes.first().asDict() == {"a": 1, "b": 2}


def test_quoted_text(spark):
    text = 'a,"b, c"\n1,"two\nlines"\n2,"say ""hi"""\n'
    df = sc.import_data(spark, text, from_text=True)
    assert df.columns == ["a", "b, c"]
    assert sorted(map(tuple, df.collect())) == [(1, "two\nlines"), (2, 'say "hi"')]


def test_lines_of_a_split_file(spark):
    lines = spark.createDataFrame([(t,) for t in ["a,b", "1,x", "a,b", "2,y"]], "line string")
    df = sc.import_lines(lines.coalesce(1), repeated_header=True)
    assert sorted(map(tuple, df.collect())) == [(1, "x"), (2, "y")]
    with pytest.raises(ValueError, match="empty"):
        sc.import_lines(lines.where("false"))


def test_export(spark, tmp_path):
    df = spark.createDataFrame(
        [(2020, 1.5, None), (2021, None, "a;b")], "work_year int, x double, s string"
    )
    out = str(tmp_path / "out")
    sc.export_cleaned(df, out, ";")
    back = sc.import_data(spark, out, ";")
    assert sorted(map(str, back.collect())) == sorted(map(str, df.collect()))
    with pytest.raises(Exception, match="already exists"):
        sc.export_cleaned(df, out, ";")
    sc.export_cleaned(df, out, ";", mode="overwrite", partition_by=["work_year"])
    assert sorted(p.name for p in Path(out).glob("work_year=*")) == [
        "work_year=2020", "work_year=2021"
    ]
    parquet = str(tmp_path / "parquet")
    sc.export_cleaned(df, parquet, format="parquet")
    assert spark.read.parquet(parquet).count() == 2
    with pytest.raises(ValueError, match="format"):
        sc.export_cleaned(df, parquet, format="xml")


def test_quotes_and_line_ends_in_files(spark, csv_file, tmp_path):
    path = csv_file('a,b\n1,"say ""hi"""\n2,6" pipe\n3,"x, y"\n')
    assert [r["b"] for r in sc.import_data(spark, path).orderBy("a").collect()] == [
        'say "hi"', '6" pipe', "x, y"
    ]
    path = csv_file('a,b\n1,"two\nlines"\n')
    with pytest.raises(ValueError, match="multi_line"):
        sc.import_data(spark, path)
    assert sc.import_data(spark, path, multi_line=True).first()["b"] == "two\nlines"
    rows = [(1, 'q " q'), (2, "a;b"), (3, "back\\slash"), (4, "line\nend"), (5, " blanks "), (6, '"'), (7, "\\")]
    df = spark.createDataFrame(rows, "n long, s string")
    out = str(tmp_path / "odd")
    sc.export_cleaned(df, out, ";")
    assert sorted(map(tuple, sc.import_data(spark, out, ";", multi_line=True).collect())) == rows


def test_rows_like_the_header_and_surplus_fields(spark, csv_file):
    assert [r[0] for r in sc.import_data(spark, "name\nname\nbob\n", from_text=True).collect()] == ["name", "bob"]
    assert sc.import_data(spark, csv_file("name\nname\nbob\n")).count() == 2
    spaced = sc.import_data(spark, csv_file("a  b\na b\n1   2\n"), " ", ignore_repeated=True)
    assert sorted(map(tuple, spaced.collect())) == [("1", "2"), ("a", "b")]
    lines = spark.createDataFrame([("a",), ("b",)], "line string").coalesce(1)
    assert sc.import_lines(lines, header="a").count() == 2
    for source in (csv_file("a,b\n1,2,3\n"), "a,b\n1,2,3\n"):
        text = not source.endswith(".csv")
        with pytest.raises(Exception, match="more fields"):
            sc.import_data(spark, source, from_text=text).collect()
        cut = sc.import_data(spark, source, from_text=text, surplus="drop")
        assert list(map(tuple, cut.collect())) == [(1, 2)]
    with pytest.raises(ValueError, match="surplus"):
        sc.import_data(spark, "a\n1\n", from_text=True, surplus="keep")


def test_other_quote_with_repeated_delimiters(spark):
    text = "a b\n'x  y'   2\n"
    df = sc.import_data(spark, text, " ", from_text=True, ignore_repeated=True, quote="'")
    assert tuple(df.first()) == ("x  y", 2)


def test_rows_keep_their_order(spark, tmp_path):
    """Splits of unequal size, which Spark reads largest first."""
    folder = tmp_path / "many"
    folder.mkdir()
    at = 0
    for part, rows in enumerate([200, 3000, 50, 9000]):
        lines = [f"{(at + i) % 50},{at + i},{'pad' * (part * 9 + (i > rows / 2) * 12)}" for i in range(rows)]
        (folder / f"part-{part}.csv").write_text("k,pos,pad\n" + "\n".join(lines) + "\n")
        at += rows
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "20000")
    try:
        raw = sc.import_data(spark, str(folder), keep_order=True)
        assert raw.rdd.getNumPartitions() > 4
        first = sc.keep_first(raw, ["k"])
        piped = sc.pipeline(str(folder), "light_clean", spark=spark, dedup_by=["k"])
        for df in (first, piped):
            assert df.columns == ["k", "pos", "pad"]
            assert sorted((r["k"], r["pos"]) for r in df.collect()) == [(i, i) for i in range(50)]
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)

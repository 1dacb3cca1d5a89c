import datetime
import random
import time

from pyspark.sql import functions as F

import scourline as sc
from scourline.streaming import clean_stream, keep_first_stream


def test_row_local_steps_run_on_a_stream(spark, tmp_path):
    source = str(tmp_path / "in")
    batch = spark.createDataFrame(
        [(100, "EUR", 2022, "FT", "fr", 30, "S"), (1, "XYZ", 2022, "ZZ", None, None, "XL")],
        "salary int, `Salary Currency` string, work_year int, employment_type string,"
        "country string, remote_ratio int, company_size string",
    )
    batch.write.parquet(source)
    stream = spark.readStream.schema(batch.schema).parquet(source)
    query = (
        clean_stream(stream)
        .writeStream.format("parquet")
        .option("path", str(tmp_path / "out"))
        .option("checkpointLocation", str(tmp_path / "state"))
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination(120)
    out = spark.read.parquet(str(tmp_path / "out")).orderBy("salary")
    assert [tuple(r) for r in out.collect()] == [
        (1, "XYZ", 2022, "ZZ", None, None, "XL", None),
        (100, "EUR", 2022, "Full-time", "FR", 50.0, "S", 95.0),
    ]


def run_in_batches(spark, tmp_path, parts, schema, transform):
    """Each part is a file of its own, and each file a batch."""
    for i, part in enumerate(parts):
        spark.createDataFrame(part, schema).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
        time.sleep(0.01)
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "in"))
    out = str(tmp_path / "out")
    query = (
        transform(stream).writeStream.format("parquet").option("path", out)
        .option("checkpointLocation", str(tmp_path / "state")).trigger(availableNow=True).start()
    )
    query.awaitTermination()
    return spark.read.schema(stream.schema).parquet(out)


def test_first_rows_of_a_stream_are_those_of_the_batch(spark, tmp_path):
    schema = "k string, g int, at timestamp, tie int, v double"
    choose = random.Random(3)
    start = datetime.datetime(2024, 1, 1)
    rows = [
        (choose.choice(["a", "b", None, "c"]), choose.choice([1, None]), start + datetime.timedelta(minutes=m), choose.choice([None, 1, 2]), float(i))
        for i, m in enumerate(choose.randrange(0, 600) for _ in range(80))
    ]
    rows.sort(key=lambda r: r[2] + datetime.timedelta(minutes=choose.randrange(0, 50)))  # out of order by less than an hour
    parts = [rows[i : i + 20] for i in range(0, 80, 20)]
    late = ("a", 1, start - datetime.timedelta(days=9), 0, -1.0)
    end = ("end", 0, start + datetime.timedelta(days=9), 0, 0.0)
    parts += [[late, ("new", 5, start - datetime.timedelta(days=9), 0, -2.0)], [end, (None, 1, None, 0, -3.0)]]
    found = run_in_batches(spark, tmp_path, parts, schema, lambda s: keep_first_stream(s, ["k", "g"], "at", "1 hour", ["tie", "v"]))
    want = sc.keep_first(spark.createDataFrame(rows, schema), ["k", "g"], order_by=["at", F.asc_nulls_first("tie"), "v"])
    assert sorted(map(tuple, found.where("k is null or k <> 'end'").collect()), key=repr) == sorted(map(tuple, want.collect()), key=repr)


def test_whole_numbers_beside_nulls_stay_exact(spark, tmp_path):
    """Keys that are looked at together: a null of one does not round the numbers of another."""
    schema = "k int, at timestamp, big long, tie long, on boolean"
    start, big = datetime.datetime(2024, 1, 1), 2**60 + 1
    rows = [(k, start + datetime.timedelta(minutes=k % 7), None if k % 3 == 0 else big + k, None if k % 2 else big - k, [None, True, False][k % 3]) for k in range(60)]
    later = [(k, at + datetime.timedelta(minutes=30), -1, -1, True) for k, at, *_ in rows]
    ties = [(k, at, 0, big + 99, None) for k, at, *_ in rows]
    end = [(None, start + datetime.timedelta(days=9), 0, 0, None)]
    parts = [[*later, *rows[:30]], [*ties, *rows[30:]], end, [(7, start + datetime.timedelta(days=9), 1, 1, None)]]
    for groups in (1, 16):
        folder = tmp_path / str(groups)
        found = run_in_batches(spark, folder, parts, schema, lambda s: keep_first_stream(s, ["k"], "at", "1 hour", ["tie"], groups))
        assert sorted(map(tuple, found.where("k is not null").collect())) == rows


def test_calls_of_python_do_not_grow_with_the_keys(spark, tmp_path):
    rows = [(i % 500, datetime.datetime(2024, 1, 1, 0, i % 60), i) for i in range(2000)]
    end = [(-1, datetime.datetime(2024, 2, 1), 0)]

    def transform(stream):
        return keep_first_stream(stream, ["k"], "at", "1 hour", ["i"], groups=8)

    found = run_in_batches(spark, tmp_path, [rows, end], "k int, at timestamp, i int", transform)
    assert found.where("k >= 0").count() == found.where("k >= 0").select("k").distinct().count() == 500
    state = spark.read.format("statestore").load(str(tmp_path / "state"))
    assert state.count() <= 9

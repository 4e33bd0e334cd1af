import glob
import os

from pyspark.sql import functions as F

from peakflow.session import shared_path
from peakflow.sources import sinks


def _local(path):
    return path[len("file:"):] if path.startswith("file:") else path


def _read_parts(path):
    path = _local(path)
    out = []
    for f in sorted(glob.glob(os.path.join(path, "part-*"))):
        out += open(f).read().splitlines()
    return out


def test_quoted_csv(spark):
    df = spark.createDataFrame([('a"b', None, ["x", "y"]), ("", "c", None)], "s string, t string, q array<string>")
    path = sinks.write_quoted_csv(df.coalesce(1), shared_path(spark, "t-quoted"))
    lines = _read_parts(path)
    assert lines[0] == '"s","t","q"'
    assert sorted(lines[1:]) == sorted(['"a""b","","x,y"', '"","c",""'])


def test_long_form(spark):
    a = spark.createDataFrame([(1, None), (2, 3.5)], "x int, y double")
    rows = sorted(tuple(r) for r in sinks.long_form({"Q": a}).collect())
    assert rows == [("Q", 1, "x=1 | y="), ("Q", 2, "x=2 | y=3.5")]


def test_parquet_and_csv_roundtrip(spark):
    df = spark.createDataFrame([(1, "a"), (2, None)], "a long, b string")
    p = sinks.write_parquet(df, shared_path(spark, "t-parquet"))
    assert sorted(spark.read.parquet(p).collect()) == sorted(df.collect())
    c = sinks.write_csv(df, shared_path(spark, "t-csv"))
    back = spark.read.schema(df.schema).option("header", True).csv(c)
    assert sorted(back.collect(), key=str) == sorted(df.collect(), key=str)


def test_csv_not_single_file_by_default(spark):
    df = spark.range(100).repartition(4)
    c = sinks.write_csv(df, shared_path(spark, "t-csv-multi"))
    assert len(glob.glob(os.path.join(_local(c), "part-*"))) == 4


def test_instants_are_written_in_the_given_zone(spark):
    df = spark.sql("SELECT timestamp_seconds(1704439800) AS t")
    old = spark.conf.get("spark.sql.session.timeZone")
    try:
        for zone in ("UTC", "America/New_York"):
            spark.conf.set("spark.sql.session.timeZone", zone)
            assert _read_parts(sinks.write_quoted_csv(df, shared_path(spark, "t-zone")))[1] == '"2024-01-05 10:30:00.000000"'
            assert _read_parts(sinks.write_csv(df, shared_path(spark, "t-zone")))[1].startswith("2024-01-05T10:30:00.000+03:00")
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)


def test_long_form_keeps_the_order(spark):
    df = spark.range(50).repartition(7).orderBy("id")
    rows = sinks.long_form({"Q": df}).orderBy("row_no").collect()
    assert [r["result"] for r in rows] == [f"id={i}" for i in range(50)]


def test_single_file_is_joined_from_parallel_parts(spark, tmp_path):
    df = spark.range(0, 1000, 1, 7).select("id", F.when(F.col("id") % 5 == 0, 'a "q", b').otherwise("x").alias("text.col"))
    path = f"{tmp_path}/one"
    for _ in range(2):  # writing again takes the old file's place
        sinks.write_csv(df, path, single_file=True)
    files = [f for f in os.listdir(path) if f.startswith("part-")]
    assert len(files) == 1 and os.listdir(tmp_path) == ["one"]
    with open(f"{path}/{files[0]}") as f:
        assert f.readline() == "id,text.col\n"
    back = spark.read.option("header", True).option("inferSchema", True).csv(path)
    assert [r[0] for r in back.collect()] == list(range(1000)) and back.columns == df.columns
    sinks.write_csv(df.limit(0), f"{tmp_path}/none", single_file=True)
    assert spark.read.option("header", True).csv(f"{tmp_path}/none").columns == df.columns

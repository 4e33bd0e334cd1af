from pyspark.sql import functions as F

from peakflow.operators import quality


def test_missing_summary(spark):
    df = spark.createDataFrame([(1, None, "a"), (None, None, "b")], "a int, b string, c string")
    got = [tuple(r) for r in quality.missing_summary(df).collect()]
    assert got == [("b", 2), ("a", 1)]
    assert quality.missing_summary(df.limit(0)).count() == 0


def test_missing_summary_single_scan(spark):
    df = spark.range(10).withColumn("x", F.lit(None).cast("string"))
    plan = quality.missing_summary(df)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Range") == 1


def test_missing_compare(spark):
    before = spark.createDataFrame([("a", 3), ("b", 1)], "column string, missing_count long")
    after = spark.createDataFrame([("b", 4), ("c", 2)], "column string, missing_count long")
    got = {r["column"]: (r["before_missing"], r["after_missing"], r["missing_change"])
           for r in quality.missing_compare(before, after).collect()}
    assert got == {"a": (3, 0, -3), "b": (1, 4, 3), "c": (0, 2, 2)}


def test_dedupe_with_array_column(spark):
    df = spark.createDataFrame([(1, ["x", "y"]), (1, ["x", "y"])], "a int, q array<string>")
    assert quality.dedupe_rows(df).count() == 1
    r = quality.duplicate_report(df).collect()[0]
    assert (r["rows_before"], r["rows_after"], r["duplicates_removed"]) == (2, 1, 1)


def test_dedupe_idempotent(spark):
    df = spark.createDataFrame([(1,), (1,), (2,)], "a int")
    once = quality.dedupe_rows(df)
    assert quality.dedupe_rows(once).count() == once.count() == 2


def test_iqr(spark):
    rows = []
    for hour, n in enumerate([10] * 20 + [11, 9, 50, 1]):
        rows += [(hour,)] * n
    df = spark.createDataFrame(rows, "hour_of_day int")
    b = quality.iqr_bounds(df).collect()[0]
    assert (b["q1"], b["q3"]) == (10.0, 10.0)
    out = [(r["hour_of_day"], r["flights_in_hour"]) for r in quality.iqr_outliers(df).collect()]
    assert out == [(22, 50), (20, 11), (21, 9), (23, 1)]


def test_volume_report(spark):
    a = spark.range(5).withColumn("x", F.lit(1))
    b = a.filter("id < 3").select("id")
    r = quality.volume_report(a, b).collect()[0]
    assert tuple(r) == (5, 3, 2, 2, 1)


def test_unparsed_count(spark):
    df = spark.createDataFrame([(1,), (None,)], "scheduled_local_ts int")
    assert tuple(quality.unparsed_count(df).collect()[0]) == (2, 1, 1)


def test_duplicate_counts_equal_report(spark):
    df = spark.createDataFrame([(1, "a"), (1, "a"), (2, None), (2, None), (3, "c")], "a int, b string")
    assert quality.duplicate_counts(df, quality.dedupe_rows(df)).collect() == quality.duplicate_report(df).collect()


def test_dedupe_by_prints_gives_the_same_rows(spark):
    rows = [(1, "a", None), (1, "a", None), (1, None, "a"), (None, "a", None), (2, "b", "c"), (2, "b", "c"), (2, "b", "c"), (3, "", ""), (3, None, "")]
    df = spark.createDataFrame(rows, "`x.y` int, s string, t string")
    got = quality.dedupe_rows(df, "prints")
    assert sorted(got.collect(), key=repr) == sorted(set(df.collect()), key=repr) and got.columns == df.columns
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert quality.dedupe_rows(df.limit(0), "prints").count() == 0 and "left_anti" not in plan
    assert "partial_count(1)], output=[__a" in plan  # what is shuffled to be counted


def test_duplicate_report_counts_the_rows_and_their_copies(spark, tmp_path):
    from datetime import datetime
    from peakflow.plans.registry import QUERIES
    rows = [(i, datetime(2024, 1, 1, i, 0, 0), i, "view", 1.0, "{}") for i in (1, 2, 10)]  # event 10 comes twice by itself
    spark.createDataFrame(rows, "event_id long, ts timestamp, user_id long, event_type string, value double, props string").write.parquet(f"{tmp_path}/events.parquet")
    assert tuple(QUERIES["duplicate_report"](spark, str(tmp_path)).first()) == (8, 3, 5)

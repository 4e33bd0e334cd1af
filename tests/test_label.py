import datetime as dt

from pyspark.sql import functions as F

from peakflow.operators import label
from peakflow.sources.bindings import MOVEMENTS, movements_raw
from peakflow.plans import preprocess as pre
from conftest import SF_SMALL


def _threshold(spark, values, p):
    df = spark.createDataFrame([(v,) for v in values], "flights_in_window long")
    return label.peak_threshold(df, p).collect()[0]["threshold"]


def test_threshold_fixtures(spark):
    assert _threshold(spark, range(1, 11), 0.75) == 8
    assert _threshold(spark, range(1, 11), 0.25) == 3
    assert _threshold(spark, [5, 5, 7, 9, 9, 9, 20], 0.75) == 9
    assert _threshold(spark, [5, 5, 7, 9, 9, 9, 20], 0.25) == 5


def test_threshold_equals_exact_approx_quantile(spark):
    vals = [3, 1, 4, 1, 5, 9, 2, 6, 5, 3, 5, 8, 9, 7, 9]
    df = spark.createDataFrame([(v,) for v in vals], "flights_in_window long")
    for p in (0.1, 0.25, 0.5, 0.75, 0.9):
        assert label.peak_threshold(df, p).collect()[0][0] == df.approxQuantile("flights_in_window", [p], 0.0)[0]


def test_empty_threshold_labels_zero(spark):
    w = spark.createDataFrame([], "flights_in_window long")
    assert label.peak_threshold(w).collect()[0]["threshold"] is None
    rows = spark.createDataFrame([(dt.date(2024, 1, 1), 1, 2, "T1")],
                                 "scheduled_date_local date, hour_of_day int, day_of_week int, terminal_group string")
    empty = rows.limit(0)
    assert label.label_rows(empty, MOVEMENTS).count() == 0


def test_label_ge_threshold(spark):
    # windows of sizes 1, 2, 3, 4 -> p75 = 3; the window of exactly 3 is peak
    rows = []
    for size, hour in ((1, 1), (2, 2), (3, 3), (4, 4)):
        rows += [(dt.date(2024, 1, 1), hour, 2, "T1")] * size
    df = spark.createDataFrame(rows, "scheduled_date_local date, hour_of_day int, day_of_week int, t string")
    out = label.label_rows(df, MOVEMENTS.with_(terminal="t"))
    got = {r["hour_of_day"]: r["peak_traffic_label"] for r in out.select("hour_of_day", "peak_traffic_label").collect()}
    assert got == {1: 0, 2: 0, 3: 1, 4: 1}


def test_no_time_columns_label_zero(spark):
    df = spark.createDataFrame([(1,)], "x int")
    assert label.label_rows(df).collect()[0]["peak_traffic_label"] == 0


def test_join_and_window_forms_agree(spark):
    d = pre.deduplicated(movements_raw(spark, SF_SMALL), MOVEMENTS)
    cols = ["movement_id", "flights_in_window", "peak_traffic_label"]
    a = label.label_rows(d, MOVEMENTS, "join").select(cols)
    b = label.label_rows(d, MOVEMENTS, "window").select(cols)
    assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


def test_label_counts_sum_to_rows(spark):
    pp = pre.preprocess(movements_raw(spark, SF_SMALL), MOVEMENTS)
    n = pp.count()
    assert sum(r["count"] for r in label.label_distribution(pp).collect()) == n
    assert sum(r["count"] for r in label.hourly_label_counts(pp).collect()) == n


def test_invariant_under_repartition(spark):
    raw = movements_raw(spark, SF_SMALL)
    a = pre.preprocess(raw, MOVEMENTS).select("movement_id", "peak_traffic_label")
    b = pre.preprocess(raw.repartition(7), MOVEMENTS).select("movement_id", "peak_traffic_label")
    assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


def test_scan_parse_and_dedupe_shared(spark):
    """Row side, window side and threshold subquery share one dedupe shuffle (null-safe join)."""
    pp = pre.preprocess(movements_raw(spark, SF_SMALL), MOVEMENTS)
    plan = pp._jdf.queryExecution().optimizedPlan().toString()
    assert "isnotnull(scheduled_date_local" not in plan
    pp.write.format("noop").mode("overwrite").save()


def test_reports_iqr_from_result_equals_dedup(spark):
    from peakflow.operators import quality
    raw = movements_raw(spark, SF_SMALL)
    rep = pre.reports(raw, MOVEMENTS)
    direct = quality.iqr_bounds(pre.deduplicated(raw, MOVEMENTS))
    assert rep.iqr_bounds.collect() == direct.collect()
    assert pre.preprocess(raw, MOVEMENTS).count() == pre.deduplicated(raw, MOVEMENTS).count()


def test_cleaning_summary_reports_equal_separate_passes(spark):
    from peakflow.operators import quality, timeparts
    from peakflow.spec import LOCAL_TS
    raw = movements_raw(spark, SF_SMALL)
    summary = pre.cleaning_summary(raw, MOVEMENTS)
    parsed = pre.cleaned(raw, MOVEMENTS)
    assert summary.unparsed().collect() == quality.unparsed_count(parsed, LOCAL_TS).collect()
    separate = quality.invalid_format_counts(timeparts.filter_unparsed(parsed, LOCAL_TS), MOVEMENTS.format_rules)
    assert sorted(summary.invalid_formats().collect()) == sorted(separate.collect())
    dd = pre.deduplicated(raw, MOVEMENTS)
    assert summary.duplicates(dd).collect() == quality.duplicate_counts(pre.validated(raw, MOVEMENTS), dd).collect()
    assert summary.volume(dd, len(raw.columns)).collect() == quality.volume_report(raw, dd).collect()
    assert summary.missing_before().collect() == quality.missing_summary(raw).collect()
    # one scan of the raw table for all the counts
    plan = summary.frame._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Relation") == 1


def test_bindings_give_the_operators_work(spark):
    """Duplicates to remove, a window of three tenths of the rows, an outlier hour."""
    from peakflow.operators import quality
    raw = movements_raw(spark, SF_SMALL)
    kept = pre.deduplicated(raw, MOVEMENTS)
    assert kept.count() < pre.validated(raw, MOVEMENTS).count()
    windows = label.traffic_windows(label.terminal_group(kept, MOVEMENTS.terminal))
    most, rows = windows.agg(F.max("flights_in_window"), F.sum("flights_in_window")).first()
    assert most >= 0.28 * rows
    assert quality.iqr_outliers(kept, MOVEMENTS.iqr_multiplier).count() > 0


def test_salted_window_form_spreads_a_hot_window(spark):
    plan = label.label_rows(pre.deduplicated(movements_raw(spark, SF_SMALL), MOVEMENTS), MOVEMENTS, "window")._jdf.queryExecution().optimizedPlan().toString()
    assert "__salt" in plan and "count(1) windowspec" not in plan


def test_label_reports_from_windows_equal_those_from_rows(spark):
    pp = pre.preprocess(movements_raw(spark, SF_SMALL), MOVEMENTS)
    rows = label.terminal_group(pre.deduplicated(movements_raw(spark, SF_SMALL), MOVEMENTS), MOVEMENTS.terminal)
    windows = label.label_windows(label.traffic_windows(rows))
    for report in (label.hourly_label_counts, label.label_distribution, label.busiest_windows):
        assert report(pp).collect() == report(windows).collect()
        plan = report(windows)._jdf.queryExecution().optimizedPlan().toString()
        assert "Join" not in plan


def test_salts_follow_measured_counts(spark):
    """30 % of the rows in one window: the largest task holds at most twice the median."""
    day, hot = F.date_add(F.lit("2024-01-01").cast("date"), (F.col("id") % 400).cast("int")), F.col("id") % 10 < 3
    df = spark.range(40_000).select("id", F.when(hot, F.lit("2024-01-01").cast("date")).otherwise(day).alias("scheduled_date_local"),
                                    F.when(hot, 3).otherwise((F.col("id") % 7).cast("int")).alias("hour_of_day"), F.lit(2).alias("day_of_week"), F.lit(None).cast("string").alias("terminal_group"))
    dealt = label.salted(df)
    assert dealt.count() == 40_000 and dealt.where("hour_of_day = 3").select("__salt").distinct().count() > 8
    sizes = sorted(r["count"] for r in dealt.repartition(8, *label.WINDOW_KEYS, "__salt").groupBy(F.spark_partition_id()).count().collect())
    assert len(sizes) == 8 and sizes[-1] <= 2 * sizes[4]


def test_percentile_by_histograms(spark):
    import random
    rnd = random.Random(3)
    for values in ([rnd.randrange(10) for _ in range(37)], [int(10 ** rnd.uniform(0, 12)) for _ in range(400)], [7] * 5, []):
        df = spark.createDataFrame([(v,) for v in values] + [(None,)], "flights_in_window long")
        for p in (0.0, 0.75):
            want = label.peak_threshold(df, p).collect()[0][0]
            assert label.percentile_by_histograms(df, "flights_in_window", p, bins=16).collect()[0][0] == want, (values[:5], p)

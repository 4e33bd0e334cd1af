from peakflow.plans import sql_queries as Q
from peakflow.operators import traffic
from peakflow.sources.bindings import MOVEMENTS, movements_raw
from peakflow.plans import preprocess as pre
from peakflow.spec import ANSWER_COLUMNS
from conftest import SF_SMALL


def test_grouping_sets_fixture(spark):
    df = spark.createDataFrame([(1, 0), (1, 1), (2, 0)], "hour_of_day int, is_weekend int")
    rows = Q.sql_grouping_sets(df).collect()
    assert len(rows) == 8
    total = [r for r in rows if r["hour_of_day"] is None and r["day_type"] == "ALL_DAYS"]
    assert total[0]["flight_count"] == 3


def test_rolling_mean_edges_and_gaps(spark):
    rows = [(0,)] * 2 + [(1,)] * 4 + [(3,)] * 6  # hour 2 missing
    df = spark.createDataFrame(rows, "hour_of_day int")
    got = {r["hour_of_day"]: r["rolling_3hr_avg"] for r in Q.sql_rolling_avg(df).collect()}
    assert got == {0: 3.0, 1: 4.0, 3: 5.0}


def test_lag_pct_change(spark):
    df = spark.createDataFrame([(0,), (1,), (1,), (1,), (1,)], "hour_of_day int")
    got = {r["hour_of_day"]: (r["prev_hour_flights"], r["pct_change"]) for r in Q.sql_hourly_surge(df).collect()}
    assert got == {0: (None, None), 1: (1, 300.0)}


def test_lag_previous_zero_is_null(spark):
    df = spark.createDataFrame([(0, 0), (1, 5)], "hour_of_day int, flights_in_hour long")
    out = spark.sql("SELECT hour_of_day, try_divide(100.0 * (flights_in_hour - LAG(flights_in_hour) OVER "
                    "(ORDER BY hour_of_day)), LAG(flights_in_hour) OVER (ORDER BY hour_of_day)) AS p FROM {d}",
                    d=df).collect()
    assert out[1]["p"] is None


def test_dense_rank_ties_exceed_limit(spark):
    rows = []
    for d, n in (("A", 5), ("B", 5), ("C", 4), ("D", 3), ("E", 2), ("F", 1), ("G", 1)):
        rows += [(d, 1)] * n
    df = spark.createDataFrame(rows, "dest_raw string, peak_traffic_label int")
    out = Q.sql_top_dest_dense(df, MOVEMENTS).collect()
    assert [(r["destination"], r["rank_num"]) for r in out] == [
        ("A", 1), ("B", 1), ("C", 2), ("D", 3), ("E", 4), ("F", 5), ("G", 5)]


def test_dense_ranks_are_limited_before_the_window_and_read_the_counts_once(spark):
    df = spark.createDataFrame([("A", 1)], "dest_raw string, peak_traffic_label int")
    plan = Q.sql_top_dest_dense(df, MOVEMENTS)._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan and "Join" not in plan


def test_answers_have_the_fixed_columns(spark):
    pp = pre.preprocess(movements_raw(spark, SF_SMALL), MOVEMENTS)
    assert {k: tuple(df.columns) for k, df in Q.answers(pp, MOVEMENTS).items()} == ANSWER_COLUMNS


def test_grouping_total_equals_rows_and_avg_agree(spark):
    pp = pre.preprocess(movements_raw(spark, SF_SMALL), MOVEMENTS)
    rows = traffic.rows_total(pp).collect()[0]["rows"]
    g = Q.sql_grouping_sets(pp).collect()
    assert [r["flight_count"] for r in g if r["hour_of_day"] is None and r["day_type"] == "ALL_DAYS"] == [rows]
    a = {r["day_type"]: round(r["avg_hourly_traffic"], 2) for r in traffic.avg_by_daytype(pp).collect()}
    b = {r["day_type"]: r["avg_hourly_traffic"] for r in Q.sql_avg_by_daytype(pp).collect()}
    assert a == b
    assert traffic.hourly_total(pp).collect()[0][0] == rows


def test_peak_share_and_top_dest(spark):
    pp = pre.preprocess(movements_raw(spark, SF_SMALL), MOVEMENTS)
    share = Q.sql_peak_share(pp, MOVEMENTS, min_flights=1).collect()
    assert 0 < len(share) <= 10
    assert all(0 <= r["peak_share_pct"] <= 100 for r in share)
    top = Q.sql_top_dest_per_carrier(pp, MOVEMENTS).collect()
    assert len({r["airline_name"] for r in top}) == len(top)

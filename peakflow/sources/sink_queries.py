"""Registered sink queries: write to the shared folder, read back, compare.

Each writes the full frame (in parallel, one file per task) under
``spark.checkpoint.dir`` and returns what Spark reads back.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import clean
from ..plans import sql_queries as Q
from ..plans import oracle as O
from ..plans.export import portable
from ..session import shared_path
from ..spec import ANSWER_COLUMNS, LOCAL_TS
from . import sinks
from .bindings import MOVEMENTS

M = MOVEMENTS


def _pp(spark, base):
    from ..plans.registry import _pp as memo_pp
    return memo_pp(spark, base)


def _reduced(spark, base):
    return portable(clean.reduce_columns(_pp(spark, base), M.keep_columns))


def parquet_roundtrip(spark, base):
    df = _reduced(spark, base)
    path = sinks.write_parquet(df, shared_path(spark, "reduced-parquet"))
    return spark.read.parquet(path)


def csv_roundtrip(spark, base):
    df = _reduced(spark, base)
    path = sinks.write_csv(df, shared_path(spark, "reduced-csv"))
    return spark.read.schema(df.schema).option("header", True).csv(path)


QUOTED_COLS = ("movement_id", "carrier_raw", "dest_raw", "origin_raw", "terminal_raw", "status", "is_cargo",
               LOCAL_TS, "hour_of_day", "peak_traffic_label", "tags")


def quoted_csv(spark, base):
    """Fully quoted CSV of the labelled rows with an array column; data lines read back as text."""
    df = _pp(spark, base).withColumn("tags", F.array("status", "carrier_raw", "dest_raw")).select(*QUOTED_COLS)
    path = sinks.write_quoted_csv(df, shared_path(spark, "quoted-csv"))
    header = ",".join(f'"{c}"' for c in QUOTED_COLS)
    return spark.read.text(path).filter(F.col("value") != header).select(F.col("value").alias("line"))


def result_long_form(spark, base):
    """All eight answers in long form, written and read back."""
    path = sinks.write_long_form(Q.answers(_pp(spark, base), M, min_flights=1), shared_path(spark, "answers"))
    return spark.read.schema("query_name string, row_no bigint, result string").option("header", True).csv(path)


QUERIES = {
    "sink_parquet_roundtrip": parquet_roundtrip,
    "sink_csv_roundtrip": csv_roundtrip,
    "sink_quoted_csv": quoted_csv,
    "result_long_form": result_long_form,
}


def _q(x: str) -> str:
    return "'\"' || replace(COALESCE(CAST(" + x + " AS VARCHAR), ''), '\"', '\"\"') || '\"'"


# The order of each answer's rows.
ORDER = {
    "sql_rolling_avg": "hour_of_day",
    "sql_hourly_surge": "pct_change DESC NULLS LAST, hour_of_day",
    "sql_peak_share": "peak_share_pct DESC, airline_name",
    "sql_top_dest_per_carrier": "peak_flight_count DESC, airline_name",
    "sql_grouping_sets": "hour_of_day NULLS LAST, day_type",
    "sql_percentile_tier": "flights_in_hour DESC, hour_of_day",
    "sql_avg_by_daytype": "avg_hourly_traffic DESC, day_type",
    "sql_top_dest_dense": "rank_num, destination",
}


def _long(key: str) -> str:
    body = " || ' | ' || ".join(f"'{c}=' || ifnull(CAST({c} AS VARCHAR), '')" for c in ANSWER_COLUMNS[key])
    return f"SELECT '{key}' AS query_name, row_number() OVER (ORDER BY {ORDER[key]}) AS row_no, {body} AS result FROM ({O.ANSWERS[key]})"


ORACLE = {
    "sink_parquet_roundtrip": O.ORACLE["reduce_columns"],
    "sink_csv_roundtrip": O.ORACLE["reduce_columns"],
    "sink_quoted_csv": O.w("SELECT " + " || ',' || ".join(
        _q(c) for c in ("movement_id", "carrier_raw", "dest_raw", "origin_raw", "terminal_raw", "status",
                        "is_cargo", "strftime(make_timestamp((scheduled_local_ts + 10800) * 1000000), '%Y-%m-%d %H:%M:%S.%f')", "hour_of_day", "peak_traffic_label",
                        "concat_ws(',', status, carrier_raw, dest_raw)")) + " AS line FROM m"),
    "result_long_form": O.w("SELECT * FROM (" + ") UNION ALL SELECT * FROM (".join(map(_long, ORDER)) + ")"),
}

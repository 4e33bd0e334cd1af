"""Bindings of the movement operators to the test tables.

The test tables hold no airport movements, so two views stand in for them:

* ``movements_raw`` -- one messy movement per ``events`` row: time strings in
  several offset formats (some unparsable), padded carrier names, null-like
  tokens, lower-case and malformed codes, blank/absent terminals, nullable cargo
  flags. Built by one projection of ``events``.
* ``routes`` -- one movement per ``lineitem`` row with supplier nation as origin
  and customer nation as destination (a five-way join).

The SQL texts run unchanged in Spark and DuckDB; the DuckDB oracles embed them.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.traffic import WEIGHT
from ..spec import MovementSpec
from .tables import read_table

# Three tenths of the movements share one hour at one terminal; every tenth event comes twice and every
# thirtieth three times, some with NULLs, so that the dedupe has work to do.
MOVEMENTS_RAW_SQL = """
select event_id as movement_id, ts as scheduled_local,
  case when event_id % 50 = 4 then 'garbage'
       when event_id % 5 = 0 then substr(t,1,16) || '+03:00'
       when event_id % 5 = 1 then substr(t,1,19) || '+03:00'
       when event_id % 5 = 2 then substr(t,1,16) || 'Z'
       when event_id % 5 = 3 then substr(t,1,19) || '+0300'
       else substr(t,1,19) || 'Z' end as scheduled_local_raw,
  case when user_id % 13 = 0 then ' N/A ' when user_id % 17 = 0 then ''
       when user_id % 19 = 0 then null
       else ' Carrier ' || cast(user_id % 12 as string) || ' ' end as carrier_raw,
  case when event_id % 23 = 0 then 'none' when event_id % 29 = 0 then 'x!'
       else 'd' || lpad(cast(user_id % 30 as string), 2, '0') end as dest_raw,
  case when event_id % 41 = 0 then null
       else 'o' || lpad(cast(user_id % 5 as string), 2, '0') end as origin_raw,
  case when hot then 't 1' when event_id % 31 = 0 then null
       else 't ' || cast(event_id % 4 + 1 as string) end as terminal_raw,
  event_type as status,
  case when event_id % 37 = 0 then null else event_id % 9 = 0 end as is_cargo
from (select e.*, e.event_id % 10 in (1, 3, 6) as hot,
             case when e.event_id % 10 in (1, 3) then '2024-01-06 12:15:00' when e.event_id % 10 = 6 then '2024-01-06 12:45:30'
                  else cast(e.ts as string) end as t
      from {events} e) x"""

#: How often an event comes, as (divisor of its id, times), the first that fits.
REPEATS = ((30, 3), (10, 2), (1, 1))

# Column roles of movements_raw.
MOVEMENTS = MovementSpec(
    local_time="scheduled_local_raw",
    utc_time=None,
    terminal="terminal_raw",
    carrier="carrier_raw",
    origin="origin_raw",
    destination="dest_raw",
    status="status",
    cargo="is_cargo",
    upper_columns=("origin_raw", "dest_raw"),
    format_rules=(("origin_raw", 3), ("dest_raw", 3)),
    fill_unknown=("dest_raw",),
    keep_columns=("movement_id", "hour_of_day", "day_of_week", "is_weekend", "carrier_raw", "status",
                  "isCargo_int", "terminal_raw", "dest_raw", "peak_traffic_label"),
    rename_map=(("carrier_raw", "carrier"), ("terminal_raw", "terminal"), ("dest_raw", "destination")),
    categorical_columns=("carrier", "status", "terminal", "destination"),
    categorical_upper=("destination", "terminal"),
)

ROUTES_SQL = """
select sn.n_name origin, cn.n_name destination, l_returnflag carrier, l_linestatus terminal,
       cast(l_shipdate as date) d, l_orderkey, l_linenumber
from lineitem join orders on l_orderkey = o_orderkey
  join customer on o_custkey = c_custkey join supplier on l_suppkey = s_suppkey
  join nation sn on s_nationkey = sn.n_nationkey join nation cn on c_nationkey = cn.n_nationkey"""

ROUTES = MovementSpec(local_time=None, utc_time=None, terminal="terminal", carrier="carrier",
                      origin="origin", destination="destination", status="carrier", cargo=None)


def movements_raw(spark: SparkSession, base: str) -> DataFrame:
    """The messy movement view over ``events`` (one projection, some rows repeated)."""
    times = F.coalesce(*[F.when(F.col("event_id") % n == 0, F.lit(k)) for n, k in REPEATS], F.lit(1))
    events = read_table(spark, base, "events").withColumn("copy", F.explode(F.sequence(F.lit(1), times)))
    return spark.sql(MOVEMENTS_RAW_SQL, events=events)


def _order_destinations(spark: SparkSession, base: str) -> DataFrame:
    """(o_orderkey, destination): orders are joined to customers before any line item is touched."""
    t = lambda n: read_table(spark, base, n)
    names = t("nation").select(F.col("n_nationkey").alias("c_nationkey"), F.col("n_name").alias("destination"))
    customers = t("customer").select("c_custkey", "c_nationkey").join(names, "c_nationkey").select(F.col("c_custkey").alias("o_custkey"), "destination")
    return t("orders").select("o_orderkey", "o_custkey").join(customers, "o_custkey").select(F.col("o_orderkey").alias("l_orderkey"), "destination")


def _supplier_origins(spark: SparkSession, base: str) -> DataFrame:
    t = lambda n: read_table(spark, base, n)
    names = t("nation").select(F.col("n_nationkey").alias("s_nationkey"), F.col("n_name").alias("origin"))
    return t("supplier").select(F.col("s_suppkey").alias("l_suppkey"), "s_nationkey").join(names, "s_nationkey").select("l_suppkey", "origin")


def routes(spark: SparkSession, base: str) -> DataFrame:
    """One movement per line item: supplier nation -> customer nation.

    Line items are shuffled by order key and by supplier key. Every side grows with the
    data or is left to Spark's size checks; AQE splits hot keys.
    """
    items = read_table(spark, base, "lineitem").select("l_orderkey", "l_linenumber", "l_suppkey", "l_returnflag", "l_linestatus", "l_shipdate")
    joined = items.join(_order_destinations(spark, base), "l_orderkey").join(_supplier_origins(spark, base), "l_suppkey")
    return joined.select(
        "origin", "destination",
        F.col("l_returnflag").alias("carrier"), F.col("l_linestatus").alias("terminal"),
        F.to_date("l_shipdate").alias("d"), "l_orderkey", "l_linenumber")


def route_counts(spark: SparkSession, base: str) -> DataFrame:
    """(origin, destination, movements) for the route reports.

    Line items are counted by supplier and destination before the supplier join, so that its shuffle carries
    at most suppliers x nations rows, not line items.
    """
    items = read_table(spark, base, "lineitem").select("l_orderkey", "l_suppkey")
    counts = items.join(_order_destinations(spark, base), "l_orderkey").groupBy("l_suppkey", "destination").agg(F.count(F.lit(1)).alias("n"))
    return (counts.join(_supplier_origins(spark, base), "l_suppkey").groupBy("origin", "destination")
            .agg(F.sum("n").alias(WEIGHT)))

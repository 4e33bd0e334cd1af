"""Keyed-count traffic reports (the reference's RDD questions) as DataFrame operators.

Every report is ``groupBy(keys).count()`` (partial aggregation before the
shuffle, so a hot key costs one row per task, not a third of the data) plus an
ordering with a full tie-break; top-k reports are ``orderBy().limit(k)``, which
Spark plans as a per-partition top-k merged in one task (``TakeOrderedAndProject``).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.columns import day_type, lateral, qcol, safe_int, safe_string
from ..spec import CARGO_INT, FLIGHTS, HOUR, LABEL, TOP_K, TOP_K_BY_LABEL, WEEKEND, MovementSpec


#: A frame with this column holds counted rows: each stands for so many movements.
WEIGHT = "__movements"


def _count(df: DataFrame, *keys) -> DataFrame:
    n = F.sum(WEIGHT) if WEIGHT in df.columns else F.count(F.lit(1))
    return df.groupBy(*keys).agg(n.cast("long").alias("flights"))


def rows_total(df: DataFrame) -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias("rows"))


def hourly_volume(df: DataFrame) -> DataFrame:
    """(hour_of_day, flights_in_hour) for non-NULL hours, in no order.

    NULL hours are dropped from the counts (25 rows at most), behind a generator: a filter that Catalyst pushes
    below the count would compute the hour once more for every row, and again for every duplicate.
    """
    counts = df.groupBy(HOUR).agg(F.count(F.lit(1)).alias("flights_in_hour"))
    known = lateral(counts.withColumnRenamed(HOUR, "__hour"), {HOUR: F.col("__hour")})
    return known.where(F.col(HOUR).isNotNull()).select(HOUR, "flights_in_hour")


def hourly_counts(df: DataFrame) -> DataFrame:
    """(hour_of_day, flights_in_hour) for non-NULL hours, by hour."""
    return hourly_volume(df).orderBy(HOUR)


def first_hour(df: DataFrame) -> DataFrame:
    """The first hourly record (lowest hour)."""
    return hourly_counts(df).limit(1)


def hourly_total(df: DataFrame) -> DataFrame:
    """Sum of the hourly counts (= rows with a non-NULL hour)."""
    return hourly_volume(df).agg(F.sum("flights_in_hour").cast("long").alias("total_flights"))


def _flag_counts(df: DataFrame, column: str, labels: tuple[str, str]) -> DataFrame:
    """Counts per 0/1 flag with a readable label, NULL flags skipped."""
    zero, one = labels
    return (_count(df.filter(qcol(column).isNotNull()), safe_int(qcol(column)).alias(column))
            .withColumn("kind", F.when(F.col(column) == 1, F.lit(one))
                        .when(F.col(column) == 0, F.lit(zero)).otherwise(F.lit("OTHER")))
            .select(column, "kind", "flights")
            .orderBy(column))


def weekend_counts(df: DataFrame) -> DataFrame:
    return _flag_counts(df, WEEKEND, ("Weekday", "Weekend"))


def cargo_counts(df: DataFrame) -> DataFrame:
    return _flag_counts(df, CARGO_INT, ("Passenger", "Cargo"))


def top_values(df: DataFrame, column: str, k: int | None = TOP_K, name: str | None = None) -> DataFrame:
    """Count per value (NULL shown as ``UNKNOWN``), most frequent first, ties by value."""
    name = name or column.replace(".", "_")
    out = (_count(df, safe_string(qcol(column)).alias(name))
           .orderBy(F.col("flights").desc(), F.col(name)))
    return out.limit(k) if k else out


def top_carriers(df: DataFrame, spec: MovementSpec = FLIGHTS, k: int = TOP_K) -> DataFrame:
    return top_values(df, spec.carrier, k, "carrier")


def top_destinations(df: DataFrame, spec: MovementSpec = FLIGHTS, k: int = TOP_K) -> DataFrame:
    return top_values(df, spec.destination, k, "destination")


def status_distribution(df: DataFrame, spec: MovementSpec = FLIGHTS) -> DataFrame:
    return top_values(df, spec.status, None, "status")


def _by_label(df: DataFrame, column: str, name: str, k: int) -> DataFrame:
    return (_count(df.filter(F.col(LABEL).isNotNull()),
                   safe_string(qcol(column)).alias(name), safe_int(F.col(LABEL)).alias(LABEL))
            .orderBy(F.col("flights").desc(), F.col(name), F.col(LABEL))
            .limit(k))


def carrier_by_label(df: DataFrame, spec: MovementSpec = FLIGHTS, k: int = TOP_K_BY_LABEL) -> DataFrame:
    return _by_label(df, spec.carrier, "carrier", k)


def destination_by_label(df: DataFrame, spec: MovementSpec = FLIGHTS, k: int = TOP_K_BY_LABEL) -> DataFrame:
    return _by_label(df, spec.destination, "destination", k)


def _route(df: DataFrame, spec: MovementSpec) -> tuple:
    return (safe_string(qcol(spec.origin)).alias("origin"),
            safe_string(qcol(spec.destination)).alias("destination"))


def distinct_routes(df: DataFrame, spec: MovementSpec = FLIGHTS, sample: int | None = None) -> DataFrame:
    """Distinct (origin, destination) pairs, NULL -> ``UNKNOWN``; ``sample`` keeps the first n by key."""
    out = df.select(*_route(df, spec)).distinct().orderBy("origin", "destination")
    return out.limit(sample) if sample else out


def route_count(df: DataFrame, spec: MovementSpec = FLIGHTS) -> DataFrame:
    """Number of distinct routes: aggregate the pairs, then count groups (no single-task set)."""
    return df.select(*_route(df, spec)).distinct().agg(F.count(F.lit(1)).alias("distinct_routes"))


def top_routes(df: DataFrame, spec: MovementSpec = FLIGHTS, k: int = TOP_K) -> DataFrame:
    return (_count(df, *_route(df, spec))
            .orderBy(F.col("flights").desc(), "origin", "destination")
            .limit(k))


def daytype_means(df: DataFrame) -> DataFrame:
    """(is_weekend, day_type, avg_hourly_traffic) in no order, from the counts by (weekend, hour)."""
    slots = _count(df, F.col(WEEKEND).alias("__weekend"), F.col(HOUR).alias("__hour"))
    slots = lateral(slots, {WEEKEND: safe_int(F.col("__weekend")), "__known": F.col("__weekend").isNotNull() & F.col("__hour").isNotNull()})
    return (slots.where("__known").groupBy(WEEKEND)
            .agg(F.avg("flights").alias("avg_hourly_traffic"))
            .select(WEEKEND, day_type(F.col(WEEKEND)).alias("day_type"), "avg_hourly_traffic"))


def avg_by_daytype(df: DataFrame) -> DataFrame:
    """Mean hourly volume per day type: count per (weekend, hour), then average per weekend.

    The mean is over hour slots of whole-period totals, as in the reference.
    """
    return daytype_means(df).orderBy(WEEKEND)

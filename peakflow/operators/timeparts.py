"""Timestamp parsing, unparsable-row filter and local time parts."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.columns import lateral, present, qcol
from ..functions.timestamps import local_wall_clock, parse_timestamp
from ..spec import DATE, FLIGHTS, HOUR, LOCAL_TS, UTC_TS, WEEKDAY, WEEKEND, MovementSpec


def parse_timestamps(df: DataFrame, spec: MovementSpec = FLIGHTS) -> DataFrame:
    """Add ``scheduled_local_ts`` / ``scheduled_utc_ts`` for the time columns present.

    Parsed once per row (see :func:`lateral`): the unparsable-row filter that
    follows must not re-run the parse.
    """
    pairs = [(src, dst) for src, dst in ((spec.local_time, LOCAL_TS), (spec.utc_time, UTC_TS))
             if present(df, [src])]
    if not pairs:
        return df
    return lateral(df, {dst: parse_timestamp(qcol(src), spec.timestamp_patterns, spec.time_zone) for src, dst in pairs})


def filter_unparsed(df: DataFrame, column: str = LOCAL_TS) -> DataFrame:
    """Drop rows whose parsed local time is NULL (no-op if the column is absent)."""
    return df.filter(qcol(column).isNotNull()) if column in df.columns else df


def time_parts(df: DataFrame, spec: MovementSpec = FLIGHTS, column: str = LOCAL_TS) -> DataFrame:
    """Date, hour, weekday (1 = Sunday) and weekend flag in ``spec.time_zone``.

    Instants are converted to wall-clock time first; TIMESTAMP_NTZ columns are
    taken as wall-clock time already.
    """
    if column not in df.columns:
        return df
    local = local_wall_clock(qcol(column), df.schema[column].dataType, spec.time_zone)
    weekday = F.dayofweek(local)
    return df.withColumns({
        DATE: F.to_date(local),
        HOUR: F.hour(local),
        WEEKDAY: weekday,
        WEEKEND: F.when(weekday.isin(list(spec.weekend_days)), F.lit(1)).otherwise(F.lit(0)),
    })

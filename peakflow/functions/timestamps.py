"""Timestamp parsing and local-time parts, independent of the session time zone."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..spec import DATED_AND_ZONED, NO_SECONDS, TIME_ZONE, TIMESTAMP_PATTERNS, ZONED


def parse_timestamp(c: Column, patterns: Iterable[str] = TIMESTAMP_PATTERNS,
                    time_zone: str = TIME_ZONE) -> Column:
    """Parse a string to an instant (TIMESTAMP), NULL when nothing fits.

    The default patterns, and the ISO forms after them, are what Spark's own cast reads: a date,
    a blank or ``T``, hours, minutes, seconds, and an offset (``Z``, ``+hh``, ``+hhmm``, ``+hh:mm``) or a zone's name; where
    seconds are missing they are put in. So a regular expression tells the form, and one cast splits and checks the
    fields; no pattern is tried after another. Further patterns are tried first, each on its own.

    Strings with no offset are read as wall-clock time in ``time_zone`` rather than in whatever the session zone
    happens to be; strings without a date are rejected, as a time alone would mean today.
    """
    known = set(TIMESTAMP_PATTERNS)
    others = [F.try_to_timestamp(F.regexp_replace(c, r"Z$", "+00:00"), F.lit(p)) for p in patterns if p not in known]
    wall = F.convert_timezone(F.lit(time_zone), F.current_timezone(), c.try_cast(T.TimestampNTZType())).cast(T.TimestampType())
    whole = F.concat(F.substring(c, 1, 16), F.lit(":00"), F.substring(c, 17, 6)).try_cast(T.TimestampType())
    read = F.when(c.rlike(NO_SECONDS), whole).when(c.rlike(DATED_AND_ZONED), c.try_cast(T.TimestampType())).when(~c.rlike(ZONED), wall)
    return F.coalesce(*others, read) if others else read


def local_wall_clock(c: Column, dtype: T.DataType, time_zone: str = TIME_ZONE) -> Column:
    """Wall-clock time in ``time_zone`` as TIMESTAMP_NTZ.

    An instant is converted; a TIMESTAMP_NTZ is already wall-clock time and is
    used as is. Either way the date/hour/weekday taken from the result do not
    depend on ``spark.sql.session.timeZone``.
    """
    if isinstance(dtype, T.TimestampNTZType):
        return c
    if isinstance(dtype, T.StringType):
        c = parse_timestamp(c, time_zone=time_zone)
    return F.convert_timezone(None, F.lit(time_zone), c)

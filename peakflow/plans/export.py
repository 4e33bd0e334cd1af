"""Portable result projection: types every engine and file format agrees on.

Used at the end of registered queries and before text sinks: instants become
epoch seconds (BIGINT), wall-clock timestamps and dates become ISO strings,
small integers widen to BIGINT, floats and decimals to DOUBLE, ML vectors to
arrays of doubles. Strings, booleans, BIGINT and DOUBLE pass through.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.columns import qcol


def portable_column(c: Column, dtype: T.DataType, name: str) -> Column:
    if isinstance(dtype, T.TimestampType):
        return F.unix_seconds(c).alias(name)
    if isinstance(dtype, T.TimestampNTZType):
        return F.date_format(c, "yyyy-MM-dd HH:mm:ss.SSSSSS").alias(name)
    if isinstance(dtype, T.DateType):
        return F.date_format(c, "yyyy-MM-dd").alias(name)
    if isinstance(dtype, (T.ByteType, T.ShortType, T.IntegerType)):
        return c.cast("long").alias(name)
    if isinstance(dtype, (T.FloatType, T.DecimalType)):
        return c.cast("double").alias(name)
    if dtype.typeName() == "vector" or type(dtype).__name__ == "VectorUDT":
        from pyspark.ml.functions import vector_to_array
        return vector_to_array(c).alias(name)
    return c.alias(name)


def portable(df: DataFrame) -> DataFrame:
    """Same rows and column names, portable types."""
    return df.select(*[portable_column(qcol(f.name), f.dataType, f.name) for f in df.schema.fields])

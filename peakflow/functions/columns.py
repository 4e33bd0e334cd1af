"""Column-expression helpers. All JVM-side built-ins, no Python UDFs."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..spec import UNKNOWN


def qcol(name: str) -> Column:
    """Column by its literal top-level name; dots do not mean struct access."""
    return F.col("`" + name.replace("`", "``") + "`")


def present(df: DataFrame, names: Iterable[str | None]) -> list[str]:
    """The names that are top-level columns of ``df``, in the given order."""
    cols = set(df.columns)
    return [n for n in names if n is not None and n in cols]


def string_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)]


def null_if_like(c: Column, tokens: Iterable[str]) -> Column:
    """NULL when ``lower(c)`` is one of ``tokens``; the value otherwise."""
    return F.when(F.lower(c).isin(list(tokens)), F.lit(None)).otherwise(c)


def squeeze_upper(c: Column) -> Column:
    """Remove all whitespace and upper-case (terminal normaliser)."""
    return F.upper(F.regexp_replace(c, r"\s+", ""))


def nullify_unless(c: Column, pattern: str) -> Column:
    """NULL for non-NULL values that do not match ``pattern``."""
    return F.when(c.isNotNull() & ~c.rlike(pattern), F.lit(None)).otherwise(c)


def invalid_flag(c: Column, pattern: str) -> Column:
    return c.isNotNull() & ~c.rlike(pattern)


def blank_or_null(c: Column) -> Column:
    return c.isNull() | (F.length(F.trim(c)) == 0)


def unknown_if_blank(c: Column, unknown: str = UNKNOWN) -> Column:
    """NULL or blank -> ``unknown``; otherwise the trimmed value."""
    return F.when(blank_or_null(c), F.lit(unknown)).otherwise(F.trim(c))


def bool_to_int(c: Column) -> Column:
    """true -> 1; false and NULL -> 0."""
    return F.when(c == F.lit(True), F.lit(1)).otherwise(F.lit(0))


def safe_string(c: Column, unknown: str = UNKNOWN) -> Column:
    """Any value as a string, NULL -> ``unknown``."""
    return F.coalesce(c.cast("string"), F.lit(unknown))


def safe_int(c: Column) -> Column:
    """Any numeric or numeric-looking value truncated to int, NULL or unparsable -> 0."""
    return F.coalesce(c.try_cast("double").try_cast("int"), F.lit(0))


def day_type(weekend_flag: Column) -> Column:
    return (F.when(weekend_flag == 1, F.lit("Weekend"))
            .when(weekend_flag == 0, F.lit("Weekday")))


def literal_array(values, kind: str) -> Column:
    """An array literal of numbers made from one string; the optimizer folds it to a constant."""
    return F.split(F.lit(",".join(map(str, values))), ",").cast(f"array<{kind}>")


def lateral(df: DataFrame, exprs: dict[str, Column]) -> DataFrame:
    """Add columns that are evaluated exactly once per row.

    A plain ``withColumn`` followed by a filter on the new column lets Catalyst
    push the filter below the projection and substitute the expression, so an
    expensive one (multi-pattern timestamp parsing) runs twice per row. Columns
    produced by a generator (``inline`` of a one-element array) cannot be
    substituted that way; the generator stays in the same codegen stage.
    """
    base = df.drop(*[c for c in exprs if c in df.columns])
    row = F.struct(*[e.alias(n) for n, e in exprs.items()])
    return base.select("*", F.inline(F.array(row)))

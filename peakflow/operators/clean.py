"""Row-wise cleaning operators.

Each one is a single lazy projection (one ``withColumns`` / ``select``), so a
chain of them collapses into one Project inside one whole-stage-codegen span and
adds no shuffle. Columns a step needs but the frame lacks are skipped.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.columns import (
    blank_or_null,
    bool_to_int,
    null_if_like,
    nullify_unless,
    present,
    qcol,
    safe_int,
    safe_string,
    squeeze_upper,
    string_columns,
    unknown_if_blank,
)
from ..spec import ALL_TERMINALS, CARGO_INT, FLIGHTS, TERMINAL_GROUP, UNKNOWN, MovementSpec, format_pattern


def trim_strings(df: DataFrame) -> DataFrame:
    """Trim spaces at both ends of every string column (tabs and newlines stay)."""
    cols = string_columns(df)
    return df.withColumns({c: F.trim(qcol(c)) for c in cols}) if cols else df


def null_like_to_null(df: DataFrame, tokens: Iterable[str] = FLIGHTS.null_tokens) -> DataFrame:
    """Null-like strings (``null none na n/a nan`` and empty, any case) -> NULL."""
    tokens = list(tokens)
    cols = string_columns(df)
    return df.withColumns({c: null_if_like(qcol(c), tokens) for c in cols}) if cols else df


def upper_columns(df: DataFrame, columns: Iterable[str]) -> DataFrame:
    cols = present(df, columns)
    return df.withColumns({c: F.upper(qcol(c)) for c in cols}) if cols else df


def normalize_terminal(df: DataFrame, column: str | None) -> DataFrame:
    """Remove all whitespace and upper-case; no-op when the column is absent."""
    if not present(df, [column]):
        return df
    return df.withColumn(column, squeeze_upper(qcol(column)))


def regex_nullify(df: DataFrame, rules: Iterable[tuple[str, int | str]]) -> DataFrame:
    """Set values that do not fully match their rule to NULL.

    A rule is ``(column, width)`` for a ``[A-Z0-9]{width}`` code, or
    ``(column, pattern)``. Absent columns are skipped.
    """
    exprs = {}
    for column, rule in rules:
        if present(df, [column]):
            pattern = format_pattern(rule) if isinstance(rule, int) else rule
            exprs[column] = nullify_unless(qcol(column), pattern)
    return df.withColumns(exprs) if exprs else df


def fill_unknown(df: DataFrame, columns: Iterable[str], value: str = UNKNOWN) -> DataFrame:
    cols = present(df, columns)
    return df.withColumns({c: F.coalesce(qcol(c), F.lit(value)) for c in cols}) if cols else df


def bool_flag(df: DataFrame, column: str | None, out: str = CARGO_INT) -> DataFrame:
    """Boolean -> int flag, NULL -> 0; no-op when the column is absent."""
    if not present(df, [column]):
        return df
    return df.withColumn(out, bool_to_int(qcol(column)))


def terminal_group(df: DataFrame, column: str | None, out: str = TERMINAL_GROUP) -> DataFrame:
    """NULL or blank terminal -> ``UNKNOWN``; no terminal column -> ``ALL``."""
    if not present(df, [column]):
        return df.withColumn(out, F.lit(ALL_TERMINALS))
    c = qcol(column)
    return df.withColumn(out, F.when(blank_or_null(c), F.lit(UNKNOWN)).otherwise(c))


def reduce_columns(df: DataFrame, keep: Iterable[str] = FLIGHTS.keep_columns) -> DataFrame:
    """Keep-list intersected with the present columns, in keep-list order."""
    return df.select(*[qcol(c) for c in present(df, keep)])


def rename_dotted(df: DataFrame, mapping: Iterable[tuple[str, str]] | Mapping[str, str] = FLIGHTS.rename_map) -> DataFrame:
    """Rename present columns (keeps their positions)."""
    pairs = mapping.items() if isinstance(mapping, Mapping) else mapping
    todo = {old: new for old, new in pairs if old in df.columns}
    return df.withColumnsRenamed(todo) if todo else df


def cast_columns(df: DataFrame, columns: Iterable[str], dtype: str | T.DataType = "int") -> DataFrame:
    """Cast present columns; ``try_cast`` so an untrusted value becomes NULL, not an error."""
    cols = present(df, columns)
    return df.withColumns({c: qcol(c).try_cast(dtype) for c in cols}) if cols else df


def clean_categoricals(df: DataFrame, columns: Iterable[str], upper: Iterable[str] = ()) -> DataFrame:
    """NULL/blank -> ``UNKNOWN`` else trimmed; then upper-case the ``upper`` subset."""
    cols = present(df, columns)
    up = set(upper)
    exprs = {}
    for c in cols:
        e = unknown_if_blank(qcol(c))
        exprs[c] = F.upper(e) if c in up else e
    return df.withColumns(exprs) if exprs else df


def flatten_array(df: DataFrame, column: str | None, out: str | None = None, sep: str = ",") -> DataFrame:
    """Array column -> ``sep``-joined string (NULL array -> ''), original dropped."""
    if not present(df, [column]):
        return df
    out = out or column.replace(".", "_")
    flat = F.concat_ws(sep, qcol(column))
    if out == column:
        return df.withColumn(out, flat)
    return df.withColumn(out, flat).drop(qcol(column))


def safe_casts(df: DataFrame, strings: Iterable[str] = (), ints: Iterable[str] = ()) -> DataFrame:
    """Row-getter semantics as columns: string or ``UNKNOWN``; number truncated to int or 0."""
    exprs = {c: safe_string(qcol(c)) for c in present(df, strings)}
    exprs.update({c: safe_int(qcol(c)) for c in present(df, ints)})
    return df.withColumns(exprs) if exprs else df


def clean_strings(df: DataFrame, spec: MovementSpec = FLIGHTS) -> DataFrame:
    """trim -> null-like -> upper codes -> terminal, as one projection."""
    out = null_like_to_null(trim_strings(df), spec.null_tokens)
    out = upper_columns(out, spec.upper_columns)
    return normalize_terminal(out, spec.terminal)

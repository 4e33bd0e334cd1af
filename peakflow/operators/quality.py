"""Data-quality reports as lazy DataFrames (no actions, nothing printed).

Each report is one pass over its input: per-column null counts and per-rule
invalid counts are a single global aggregate (partial per task, merged in one
small final task) and are unpivoted afterwards, instead of one job per column.
"""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.columns import invalid_flag, present, qcol
from ..spec import FLIGHTS, HOUR, LOCAL_TS, format_pattern
from .label import percentile_disc
from .traffic import hourly_volume


def _long_form(wide: DataFrame, names: list[str], key: str, value: str, prefix: str = "c") -> DataFrame:
    """Unpivot a one-row frame whose columns are ``c0..cN`` back to ``names``."""
    stacked = wide.unpivot([], [f"{prefix}{i}" for i in range(len(names))], key, value)
    mapping = F.create_map(*[x for i, n in enumerate(names) for x in (F.lit(f"{prefix}{i}"), F.lit(n))])
    return stacked.select(mapping[F.col(key)].alias(key), F.col(value).cast("long").alias(value))


def _missing_long(wide: DataFrame, names: list[str], prefix: str = "c") -> DataFrame:
    return (_long_form(wide, names, "column", "missing_count", prefix)
            .filter(F.col("missing_count") > 0)
            .orderBy(F.col("missing_count").desc(), F.col("column")))


def missing_summary(df: DataFrame) -> DataFrame:
    """(column, missing_count) for columns with NULLs, most missing first. One scan."""
    names = list(df.columns)
    if not names:
        return df.sparkSession.createDataFrame([], "column string, missing_count long")
    wide = df.agg(*[F.count_if(qcol(n).isNull()).alias(f"c{i}") for i, n in enumerate(names)])
    return _missing_long(wide, names)


def missing_compare(before: DataFrame, after: DataFrame) -> DataFrame:
    """Full outer join of two missing summaries: before, after, change; zeros filled."""
    b = before.withColumnRenamed("missing_count", "before_missing")
    a = after.withColumnRenamed("missing_count", "after_missing")
    return (b.join(a, "column", "full")
            .na.fill(0, ["before_missing", "after_missing"])
            .withColumns({"before_missing": F.col("before_missing").cast("long"),
                          "after_missing": F.col("after_missing").cast("long")})
            .withColumn("missing_change", F.col("after_missing") - F.col("before_missing"))
            .orderBy(F.col("before_missing").desc(), F.col("column")))


def invalid_format_counts(df: DataFrame, rules: Iterable[tuple[str, int | str]] = FLIGHTS.format_rules) -> DataFrame:
    """(column, invalid_count): non-NULL values failing their rule, one aggregate for all rules.

    Counted on the frame *before* nullifying; rules touch distinct columns, so
    this equals counting each rule just before its own nullify step.
    """
    rules = [(c, r) for c, r in rules if present(df, [c])]
    if not rules:
        return df.sparkSession.createDataFrame([], "column string, invalid_count long")
    names = [c for c, _ in rules]
    wide = df.agg(*[
        F.count_if(invalid_flag(qcol(c), format_pattern(r) if isinstance(r, int) else r)).alias(f"c{i}")
        for i, (c, r) in enumerate(rules)])
    return _long_form(wide, names, "column", "invalid_count")


@dataclass
class CleaningSummary:
    """One aggregate over the parsed, unfiltered frame and the columns it counted.

    ``frame`` has one row: ``rows_before``/``rows_after``/``rows_removed`` of
    the unparsable-time filter, ``c<i>``, the rows that survive it but fail
    format rule ``i``, and ``m<i>``, the NULLs of raw column ``i``. Five reports
    that would each re-scan the raw table come from this one pass.
    """

    frame: DataFrame
    rule_columns: list[str]
    missing_columns: list[str] = field(default_factory=list)

    def missing_before(self) -> DataFrame:
        """Same rows as :func:`missing_summary` of the raw frame (``m<i>`` columns)."""
        if not self.missing_columns:
            return self.frame.sparkSession.createDataFrame([], "column string, missing_count long")
        return _missing_long(self.frame, self.missing_columns, "m")

    def unparsed(self) -> DataFrame:
        """Same row as :func:`unparsed_count`."""
        return self.frame.select("rows_before", "rows_after", "rows_removed")

    def invalid_formats(self) -> DataFrame:
        """Same rows as :func:`invalid_format_counts` on the filtered frame."""
        if not self.rule_columns:
            return self.frame.sparkSession.createDataFrame([], "column string, invalid_count long")
        return _long_form(self.frame, self.rule_columns, "column", "invalid_count")

    def duplicates(self, deduplicated: DataFrame) -> DataFrame:
        """Same row as :func:`duplicate_counts`: the format rules and the UNKNOWN
        fill never drop a row, so the rows that pass the time filter are the rows
        before dedupe."""
        nb = self.frame.select(F.col("rows_after")).scalar()
        na = deduplicated.agg(F.count(F.lit(1))).scalar()
        return self.frame.sparkSession.range(1).select(
            nb.alias("rows_before"), na.alias("rows_after"), (nb - na).alias("duplicates_removed"))

    def volume(self, after: DataFrame, cols_before: int) -> DataFrame:
        """Same row as :func:`volume_report` of the raw frame (``rows_before`` is
        the raw row count) and ``after``."""
        nb = self.frame.select(F.col("rows_before")).scalar()
        na = after.agg(F.count(F.lit(1))).scalar()
        return self.frame.sparkSession.range(1).select(
            nb.alias("rows_before"), na.alias("rows_after"), (nb - na).alias("rows_removed"),
            F.lit(cols_before).cast("long").alias("cols_before"),
            F.lit(len(after.columns)).cast("long").alias("cols_after"))


def cleaning_summary(parsed: DataFrame, rules: Iterable[tuple[str, int | str]] = FLIGHTS.format_rules,
                     column: str = LOCAL_TS, null_flags: Iterable[tuple[str, str]] = ()) -> CleaningSummary:
    """Unparsed count and per-rule invalid counts from one global aggregate.

    ``null_flags`` pairs a raw column name with a boolean column of ``parsed``
    that is true where the raw value was NULL (tagged before cleaning), so the
    raw missing summary is counted in the same pass.
    """
    ok = qcol(column).isNotNull()
    rules = [(c, r) for c, r in rules if present(parsed, [c])]
    null_flags = list(null_flags)
    frame = parsed.agg(
        F.count(F.lit(1)).alias("rows_before"), F.count_if(ok).alias("rows_after"),
        F.count_if(~ok).alias("rows_removed"),
        *[F.count_if(ok & invalid_flag(qcol(c), format_pattern(r) if isinstance(r, int) else r)).alias(f"c{i}")
          for i, (c, r) in enumerate(rules)],
        *[F.count_if(F.col(flag)).alias(f"m{i}") for i, (_, flag) in enumerate(null_flags)])
    return CleaningSummary(frame, [c for c, _ in rules], [c for c, _ in null_flags])


def unparsed_count(parsed: DataFrame, column: str = LOCAL_TS) -> DataFrame:
    """One row: rows before the unparsable-time filter, after it, and removed."""
    return parsed.agg(
        F.count(F.lit(1)).alias("rows_before"),
        F.count_if(qcol(column).isNotNull()).alias("rows_after"),
        F.count_if(qcol(column).isNull()).alias("rows_removed"))


def _bounds(hourly: DataFrame, multiplier: float) -> DataFrame:
    q = hourly.agg(percentile_disc("flights_in_hour", 0.25).alias("q1"),
                   percentile_disc("flights_in_hour", 0.75).alias("q3"))
    m = float(multiplier)
    iqr = F.col("q3") - F.col("q1")
    return q.select("q1", "q3", iqr.alias("iqr"),
                    (F.col("q1") - F.lit(m) * iqr).alias("lower_bound"),
                    (F.col("q3") + F.lit(m) * iqr).alias("upper_bound"))


def iqr_bounds(df: DataFrame, multiplier: float = FLIGHTS.iqr_multiplier) -> DataFrame:
    """One row: q1, q3, iqr, lower_bound, upper_bound of the hourly volume.

    Both quartiles are exact lower percentiles (``percentile_disc``) from one aggregate.
    """
    return _bounds(hourly_volume(df), multiplier)


def iqr_outliers(df: DataFrame, multiplier: float = FLIGHTS.iqr_multiplier) -> DataFrame:
    """Hours whose volume falls outside the IQR fences, busiest first. Rows are kept upstream.

    The fences come from one scalar subquery over the same hourly aggregate.
    """
    hourly = hourly_volume(df)
    fences = _bounds(hourly, multiplier).select(F.struct("lower_bound", "upper_bound")).scalar()
    n = F.col("flights_in_hour")
    return (hourly.filter((n < fences.getField("lower_bound")) | (n > fences.getField("upper_bound")))
            .orderBy(n.desc(), F.col(HOUR)))


def dedupe_rows(df: DataFrame, method: str = "rows") -> DataFrame:
    """Full-row duplicates removed.

    ``method="rows"`` is a hash aggregate on all columns (map-side combine): one read, and every row in the shuffle.
    ``method="prints"`` suits wide rows that are cheap to read again and seldom repeat: only a 128-bit print of each row is
    shuffled and counted; rows whose print is alone pass through, and rows of a repeated print are compared column by column.
    """
    if method == "rows":
        return df.dropDuplicates()
    if method != "prints":
        raise ValueError(f"unknown method {method!r}")
    columns = [qcol(c) for c in df.columns]
    marked = [F.struct(c.isNull(), c) for c in columns]  # a NULL leaves a hash as it is
    prints = {"__a": F.xxhash64(*marked), "__b": F.xxhash64(F.lit(1), *marked[::-1])}
    repeated = df.select(*[e.alias(n) for n, e in prints.items()]).groupBy(*prints).agg(F.count(F.lit(1)).alias("__n")).where("__n > 1").select(*prints)
    rows = df.withColumns(prints)
    alone = rows.join(repeated, list(prints), "left_anti").select(*columns)
    return alone.unionByName(rows.join(repeated, list(prints), "left_semi").select(*columns).dropDuplicates())


def duplicate_report(df: DataFrame) -> DataFrame:
    """One row: rows before dedupe, after, and removed, from one grouped pass."""
    groups = df.groupBy(*[qcol(c) for c in df.columns]).agg(F.count(F.lit(1)).alias("n"))
    return groups.agg(
        F.coalesce(F.sum("n"), F.lit(0)).cast("long").alias("rows_before"),
        F.count(F.lit(1)).alias("rows_after"),
        F.coalesce(F.sum(F.col("n") - 1), F.lit(0)).cast("long").alias("duplicates_removed"))


def duplicate_counts(before: DataFrame, deduplicated: DataFrame) -> DataFrame:
    """One row like :func:`duplicate_report`, from two counts when the deduplicated
    frame already exists (no second grouping shuffle over all rows)."""
    nb = before.agg(F.count(F.lit(1))).scalar()
    na = deduplicated.agg(F.count(F.lit(1))).scalar()
    return before.sparkSession.range(1).select(
        nb.alias("rows_before"), na.alias("rows_after"), (nb - na).alias("duplicates_removed"))


def volume_report(before: DataFrame, after: DataFrame) -> DataFrame:
    """One row: rows and columns before and after a processing step.

    The two counts are scalar subqueries, each its own (partial-aggregated) job.
    """
    nb = before.agg(F.count(F.lit(1))).scalar()
    na = after.agg(F.count(F.lit(1))).scalar()
    return before.sparkSession.range(1).select(
        nb.alias("rows_before"), na.alias("rows_after"), (nb - na).alias("rows_removed"),
        F.lit(len(before.columns)).cast("long").alias("cols_before"),
        F.lit(len(after.columns)).cast("long").alias("cols_after"))

"""Peak-traffic label: window volumes, exact percentile threshold, row labels.

Plan shape (join form): one partial+final aggregate of the rows per
(date, hour, weekday, terminal group), a global ``percentile_disc`` over those
window counts evaluated as a scalar subquery (its aggregation buffer is a
value->frequency map, so it is bounded by the number of *distinct* window
sizes, not by rows), and an equi-join of the rows back to their window. The
window table is an aggregate, so AQE may turn the join into a broadcast when
its measured size is small, and splits a skewed window on the row side
otherwise. Nothing is collected to the driver.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..spec import (
    DATE,
    FLIGHTS,
    HOUR,
    LABEL,
    WINDOW_COUNT,
    WINDOW_KEYS,
    MovementSpec,
)
from .clean import terminal_group

#: Parts of the rows for each shuffle partition that ``method="window"`` aims at.
PARTS_PER_TASK = 8


def traffic_windows(df: DataFrame, keys=WINDOW_KEYS) -> DataFrame:
    """Rows per (date, hour, weekday, terminal group)."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias(WINDOW_COUNT))


def percentile_disc(column: str, p: float) -> Column:
    """Aggregate: exact lower percentile of ``column``.

    Equals ``approxQuantile([p], relativeError=0.0)``; NULL on empty input. Its
    buffer is a value->frequency map, bounded by the number of distinct values.
    """
    quoted = "`" + column.replace("`", "``") + "`"
    return F.expr(f"percentile_disc({float(p)!r}) WITHIN GROUP (ORDER BY {quoted})")


def percentile_of(df: DataFrame, column: str, p: float) -> DataFrame:
    """One-row frame with ``threshold`` = :func:`percentile_disc` of ``column``."""
    return df.select(percentile_disc(column, p).alias("threshold"))


def percentile_by_histograms(df: DataFrame, column: str, p: float, bins: int = 4096) -> DataFrame:
    """One-row frame with ``threshold`` = :func:`percentile_disc` of ``column``, from histograms of at most ``bins`` rows.

    A histogram between the least and the greatest value tells in which bin the rank lies and how many values are below it; the
    next one refines that bin, until it holds a single value. No buffer grows with the number of distinct values. Each
    step is a job whose one row decides the next, so two or three run while the frame is made.
    """
    spark = df.sparkSession
    x = df.select(F.col(column).cast("double").alias("v")).where("v IS NOT NULL")
    goal = x.agg(F.min("v").alias("lo"), F.max("v").alias("hi"), F.count(F.lit(1)).alias("n")).first()
    rank, lo, hi = max(1, math.ceil(p * goal["n"])), goal["lo"], goal["hi"]
    while lo is not None and lo < hi:
        inside = x.where((F.col("v") >= lo) & (F.col("v") <= hi))
        place = F.least(F.lit(bins - 1), F.floor((F.col("v") - lo) / F.lit((hi - lo) / bins)))
        counts = inside.groupBy(place.alias("bin")).agg(F.count(F.lit(1)).alias("n"), F.min("v").alias("lo"), F.max("v").alias("hi"))
        upto = F.sum("n").over(Window.orderBy("bin").rowsBetween(Window.unboundedPreceding, 0))  # over a histogram's rows
        found = counts.withColumn("upto", upto).where(F.col("upto") >= rank).orderBy("bin").first()
        rank, lo, hi = rank - (found["upto"] - found["n"]), found["lo"], found["hi"]
    return spark.createDataFrame([(lo,)], "threshold double")


def peak_threshold(windows: DataFrame, percentile: float = FLIGHTS.peak_percentile, method: str = "aggregate") -> DataFrame:
    """One row: ``threshold`` (double) = exact ``percentile`` of window volumes.

    ``method="aggregate"`` keeps a map of the distinct volumes, of which there are at most the square root of twice the
    rows; ``method="histograms"`` keeps none.
    """
    if method == "histograms":
        return percentile_by_histograms(windows, WINDOW_COUNT, percentile)
    return percentile_of(windows, WINDOW_COUNT, percentile)


def threshold_value(windows: DataFrame, percentile: float = FLIGHTS.peak_percentile) -> Column:
    """The threshold as a scalar-subquery column, usable in any projection."""
    return peak_threshold(windows, percentile).scalar()


def label_windows(windows: DataFrame, percentile: float = FLIGHTS.peak_percentile) -> DataFrame:
    """Windows with ``peak_traffic_label`` = 1 when volume >= threshold.

    Empty input gives a NULL threshold, so every label is 0 (the reference's
    +Infinity threshold).
    """
    thr = threshold_value(windows, percentile)
    return windows.withColumn(
        LABEL, F.when(F.col(WINDOW_COUNT) >= thr, F.lit(1)).otherwise(F.lit(0)))


def salted(df: DataFrame, keys=WINDOW_KEYS) -> DataFrame:
    """``df`` with ``__salt``, which splits the rows of each window into parts of about equal size.

    Windows are counted first; one that holds more than a part (the rows over shuffle partitions x
    ``PARTS_PER_TASK``) gets as many salts as it holds parts. There are fewer such windows than parts, so they are broadcast.
    """
    parts = PARTS_PER_TASK * int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    windows = traffic_windows(df, keys)
    total = windows.agg(F.sum(WINDOW_COUNT)).scalar()
    share = F.col(WINDOW_COUNT) * parts / total
    hot = windows.where(share > 1).select(*[F.col(k).alias(f"__h_{k}") for k in keys], F.ceil(share).cast("int").alias("__salts"))
    same = [F.col(k).eqNullSafe(F.col(f"__h_{k}")) for k in keys]
    row = F.xxhash64(*[F.col(f"`{c}`") for c in df.columns])
    return df.join(F.broadcast(hot), same, "left").select(*[F.col(f"`{c}`") for c in df.columns], F.coalesce(F.pmod(row, F.col("__salts")), F.lit(0)).cast("int").alias("__salt"))


def label_rows(df: DataFrame, spec: MovementSpec = FLIGHTS, method: str = "join") -> DataFrame:
    """Attach ``terminal_group``, ``flights_in_window`` and ``peak_traffic_label`` to every row.

    ``method="join"`` (default) aggregates windows and joins them back, which is
    skew-safe: the aggregate is map-side combined and AQE splits a hot window on
    the row side. ``method="window"`` splits each window into as many parts as its measured count asks for
    (:func:`salted`), counts the parts and adds them up per window, so a hot window is spread over all tasks at any
    size. Both give the same labels. Without date/hour columns every label is 0.
    """
    if DATE not in df.columns or HOUR not in df.columns:
        return df.withColumn(LABEL, F.lit(0))
    base = terminal_group(df, spec.terminal)
    keys = list(WINDOW_KEYS)
    if method == "window":
        parts = salted(base, keys)
        sizes = parts.groupBy(*keys, "__salt").agg(F.count(F.lit(1)).alias("__part"))
        by_window = Window.partitionBy(*keys)
        whole = sizes.withColumn(WINDOW_COUNT, F.sum("__part").over(by_window)).drop("__part")
        thr = threshold_value(traffic_windows(base, keys), spec.peak_percentile)
        whole = whole.withColumnsRenamed({k: f"__w_{k}" for k in [*keys, "__salt"]})
        same = [F.col(k).eqNullSafe(F.col(f"__w_{k}")) for k in [*keys, "__salt"]]
        counted = parts.join(whole, same).select(*[F.col(f"`{c}`") for c in base.columns], WINDOW_COUNT)
        return counted.withColumn(
            LABEL, F.when(F.col(WINDOW_COUNT) >= thr, F.lit(1)).otherwise(F.lit(0)))
    if method != "join":
        raise ValueError(f"unknown method {method!r}")
    # Join on non-nullable keys: each window key as (coalesce(key, default), isnull(key)).
    # That is exactly null-safe equality, infers no isnotnull() filters (so the row
    # side, window side and threshold subquery canonicalise alike and share the
    # scan/parse/dedupe shuffle), and -- because the window side is grouped on the
    # very same columns, so they are provably unique -- lets Catalyst drop the join
    # entirely when a caller never reads the window count or label.
    jk = _join_keys(base, keys)
    rows = base.withColumns(jk)
    windows = rows.groupBy(*jk).agg(F.count(F.lit(1)).alias(WINDOW_COUNT))
    right = windows.select(*[F.col(k).alias(f"__w{k}") for k in jk], WINDOW_COUNT)
    cond = [rows[k] == right[f"__w{k}"] for k in jk]
    joined = rows.join(right, cond, "left").select(*[rows[f"`{c}`"] for c in base.columns], right[WINDOW_COUNT])
    thr = windows.select(percentile_disc(WINDOW_COUNT, spec.peak_percentile)).scalar()
    return joined.withColumn(LABEL, F.when(F.col(WINDOW_COUNT) >= thr, F.lit(1)).otherwise(F.lit(0)))


_KEY_DEFAULTS = {"date": "DATE'1970-01-01'", "string": "''"}


def _join_keys(df: DataFrame, keys) -> dict:
    out = {}
    for i, k in enumerate(keys):
        dtype = df.schema[k].dataType.simpleString()
        default = F.expr(_KEY_DEFAULTS.get(dtype, "0")).cast(dtype)
        out[f"__k{i}"] = F.coalesce(F.col(k), default)
        out[f"__n{i}"] = F.col(k).isNull()
    return out


def _windows_of(df: DataFrame) -> tuple[DataFrame, Column]:
    """The frame and what one of its rows counts for: a row, or all rows of a labelled window.

    Frames of :func:`label_windows` (no row columns beside the window's) are windows.
    """
    is_windows = set(df.columns) == {*WINDOW_KEYS, WINDOW_COUNT, LABEL}
    return df, F.col(WINDOW_COUNT) if is_windows else F.lit(1)


def hourly_label_counts(df: DataFrame) -> DataFrame:
    """Rows per (hour, label), ordered; from labelled rows, or from labelled windows without touching rows."""
    df, weight = _windows_of(df)
    return df.groupBy(HOUR, LABEL).agg(F.sum(weight).cast("long").alias("count")).orderBy(HOUR, LABEL)


def label_distribution(df: DataFrame) -> DataFrame:
    """Rows per label (NULL labels skipped); from labelled rows or labelled windows."""
    df, weight = _windows_of(df)
    return (df.filter(F.col(LABEL).isNotNull())
            .groupBy(LABEL).agg(F.sum(weight).cast("long").alias("count"))
            .orderBy(LABEL))


def busiest_windows(df: DataFrame, n: int = 30) -> DataFrame:
    """The ``n`` busiest labelled windows (ties by window key); from labelled rows or labelled windows."""
    cols = list(WINDOW_KEYS) + [WINDOW_COUNT, LABEL]
    windows = df if set(df.columns) == set(cols) else df.select(*cols).distinct()
    return (windows.select(*cols)
            .orderBy(F.col(WINDOW_COUNT).desc(), *[F.col(k).asc() for k in WINDOW_KEYS])
            .limit(n))

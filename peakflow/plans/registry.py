"""Registered queries: one callable per operator key, each ``(spark, base_dir) -> DataFrame``.

Every query reads the test tables (through the ``movements_raw`` / ``routes``
bindings) in full and ends in the portable projection, so results compare
across engines. ML and sink keys are added by their modules.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import clean, label, quality, timeparts, traffic
from ..sources.bindings import MOVEMENTS, ROUTES, movements_raw, route_counts
from ..spec import LOCAL_TS
from . import preprocess as pre
from . import sql_queries as Q
from .export import portable

Query = Callable[[SparkSession, str], DataFrame]

M = MOVEMENTS

_PLANS: dict = {}


def _memo(fn):
    """Build a base plan once per (application, folder) and reuse the DataFrame object.

    Only the immutable logical plan is shared (as a user would keep ``pp`` in
    a variable); every query execution still recomputes from the tables.
    """
    def wrapper(spark, base):
        key = (fn.__name__, spark.sparkContext.applicationId, base)
        if key not in _PLANS:
            _PLANS[key] = fn(spark, base)
        return _PLANS[key]
    wrapper.__name__ = fn.__name__
    return wrapper


def forget() -> None:
    """Drop the plans and fitted models that are kept for each folder; call it after a table has been written anew."""
    _PLANS.clear()
    for mod in _extensions():
        getattr(mod, "forget", lambda: None)()


@_memo
def _routes(spark, base):
    return route_counts(spark, base)


@_memo
def _raw(spark, base):
    return movements_raw(spark, base)


@_memo
def _clean(spark, base):
    return clean.clean_strings(_raw(spark, base), M)


@_memo
def _parsed(spark, base):
    return pre.cleaned(_raw(spark, base), M)


@_memo
def _validated(spark, base):
    return pre.validated(_raw(spark, base), M)


@_memo
def _dedup(spark, base):
    return pre.deduplicated(_raw(spark, base), M)


@_memo
def _grouped(spark, base):
    return clean.terminal_group(_dedup(spark, base), M.terminal)


@_memo
def _pp(spark, base):
    return pre.preprocess(_raw(spark, base), M)


@_memo
def _windows(spark, base):
    return label.traffic_windows(_grouped(spark, base))


@_memo
def _labelled(spark, base):
    return label.label_windows(_windows(spark, base), M.peak_percentile)


@_memo
def _reduced(spark, base):
    return clean.rename_dotted(clean.reduce_columns(_pp(spark, base), M.keep_columns), M.rename_map)


def _as_text(df: DataFrame, names) -> DataFrame:
    """Columns as strings, as text sources give them; a column of its own type needs no cast."""
    return df.withColumns({n: F.concat(F.lit(" "), F.col(n).cast("string")) for n in names if n in df.columns})


def _dotted(df: DataFrame) -> DataFrame:
    """The row columns under dotted names."""
    return df.withColumnsRenamed({"carrier_raw": "airline.name", "terminal_raw": "movement.terminal", "dest_raw": "movement.to"})


def _twice(df: DataFrame) -> DataFrame:
    return df.unionByName(df)


def _p(f: Callable[..., DataFrame]) -> Query:
    return lambda spark, base: portable(f(spark, base))


QUERIES: dict[str, Query] = {
    # sources
    "scan_movements": _p(_raw),
    # cleaning
    "trim_strings": _p(lambda s, b: clean.trim_strings(_raw(s, b))),
    "null_like_to_null": _p(lambda s, b: clean.null_like_to_null(_raw(s, b), M.null_tokens)),
    "upper_codes": _p(lambda s, b: clean.upper_columns(_raw(s, b), M.upper_columns)),
    "normalize_terminal": _p(lambda s, b: clean.normalize_terminal(_raw(s, b), M.terminal)),
    "regex_nullify": _p(lambda s, b: clean.regex_nullify(_clean(s, b), M.format_rules)),
    "invalid_format_counts": _p(lambda s, b: quality.invalid_format_counts(
        timeparts.filter_unparsed(_parsed(s, b)), M.format_rules)),
    "parse_timestamps": _p(lambda s, b: _parsed(s, b).select("movement_id", "scheduled_local_raw", LOCAL_TS)),
    "filter_unparsed": _p(lambda s, b: timeparts.filter_unparsed(_parsed(s, b))),
    "unparsed_count": _p(lambda s, b: quality.unparsed_count(_parsed(s, b))),
    "time_parts": _p(lambda s, b: timeparts.time_parts(timeparts.filter_unparsed(_parsed(s, b)), M).select(
        "movement_id", "scheduled_date_local", "hour_of_day", "day_of_week", "is_weekend")),
    "bool_flag": _p(lambda s, b: clean.bool_flag(_raw(s, b), M.cargo).select("movement_id", "is_cargo", "isCargo_int")),
    "fill_unknown": _p(lambda s, b: _validated(s, b).select("movement_id", "dest_raw", "origin_raw")),
    "terminal_group": _p(lambda s, b: clean.terminal_group(_clean(s, b), M.terminal).select(
        "movement_id", "terminal_raw", "terminal_group")),
    "reduce_columns": _p(lambda s, b: clean.reduce_columns(_pp(s, b), M.keep_columns)),
    "rename_dotted": _p(lambda s, b: clean.rename_dotted(_dotted(clean.reduce_columns(_pp(s, b), M.keep_columns)), (
        ("airline.name", "carrier"), ("movement.terminal", "terminal"), ("movement.to", "destination")))),
    "cast_columns": _p(lambda s, b: clean.cast_columns(_as_text(_reduced(s, b), M.int_columns), M.int_columns, "int")),
    "label_column": _p(lambda s, b: _reduced(s, b)
                       .withColumn("label", F.col("peak_traffic_label").cast("double"))
                       .filter(F.col("label").isNotNull()).select("movement_id", "label")),
    "clean_categoricals": _p(lambda s, b: clean.clean_categoricals(
        _reduced(s, b), M.categorical_columns, M.categorical_upper)),
    "flatten_array": _p(lambda s, b: clean.flatten_array(
        _raw(s, b).withColumn("tags", F.array("status", "carrier_raw", "dest_raw")), "tags")
        .select("movement_id", "tags")),
    "safe_casts": _p(lambda s, b: clean.safe_casts(
        _pp(s, b), strings=("carrier_raw", "origin_raw"), ints=("hour_of_day", "peak_traffic_label"))
        .select("movement_id", "carrier_raw", "origin_raw", "hour_of_day", "peak_traffic_label")),
    # label
    "traffic_windows": _p(_windows),
    "peak_threshold": _p(lambda s, b: label.peak_threshold(_windows(s, b), M.peak_percentile)),
    "peak_threshold_histograms": _p(lambda s, b: label.peak_threshold(_windows(s, b), M.peak_percentile, "histograms")),
    "label_windows": _p(lambda s, b: label.label_windows(_windows(s, b), M.peak_percentile)),
    "label_rows": _p(lambda s, b: label.label_rows(_dedup(s, b), M, "join").select(
        "movement_id", "terminal_group", "flights_in_window", "peak_traffic_label")),
    "label_rows_join": _p(lambda s, b: label.label_rows(_dedup(s, b), M, method="join").select(
        "movement_id", "terminal_group", "flights_in_window", "peak_traffic_label")),
    "label_rows_window": _p(lambda s, b: label.label_rows(_dedup(s, b), M, "window").select(
        "movement_id", "terminal_group", "flights_in_window", "peak_traffic_label")),
    "hourly_label_counts": _p(lambda s, b: label.hourly_label_counts(_labelled(s, b))),
    "label_distribution": _p(lambda s, b: label.label_distribution(_labelled(s, b))),
    "busiest_windows": _p(lambda s, b: label.busiest_windows(_labelled(s, b))),
    # quality
    "missing_summary": _p(lambda s, b: quality.missing_summary(_raw(s, b))),
    "missing_compare": _p(lambda s, b: quality.missing_compare(
        quality.missing_summary(_raw(s, b)), quality.missing_summary(_pp(s, b)))),
    "iqr_bounds": _p(lambda s, b: quality.iqr_bounds(_dedup(s, b), M.iqr_multiplier)),
    "iqr_outliers": _p(lambda s, b: quality.iqr_outliers(_dedup(s, b), M.iqr_multiplier)),
    "dedupe_rows": _p(lambda s, b: quality.dedupe_rows(_validated(s, b))),
    "dedupe_rows_prints": _p(lambda s, b: quality.dedupe_rows(_validated(s, b), "prints")),
    "duplicate_report": _p(lambda s, b: quality.duplicate_report(_twice(_validated(s, b)))),
    "volume_report": _p(lambda s, b: quality.volume_report(_raw(s, b), _pp(s, b))),
    # traffic reports
    "rows_total": _p(lambda s, b: traffic.rows_total(_pp(s, b))),
    "hourly_counts": _p(lambda s, b: traffic.hourly_counts(_pp(s, b))),
    "first_hour": _p(lambda s, b: traffic.first_hour(_pp(s, b))),
    "hourly_total": _p(lambda s, b: traffic.hourly_total(_pp(s, b))),
    "weekend_counts": _p(lambda s, b: traffic.weekend_counts(_pp(s, b))),
    "top_carriers": _p(lambda s, b: traffic.top_carriers(_pp(s, b), M)),
    "top_destinations": _p(lambda s, b: traffic.top_destinations(_routes(s, b), ROUTES)),
    "status_distribution": _p(lambda s, b: traffic.status_distribution(_pp(s, b), M)),
    "carrier_by_label": _p(lambda s, b: traffic.carrier_by_label(_pp(s, b), M)),
    "destination_by_label": _p(lambda s, b: traffic.destination_by_label(_pp(s, b), M)),
    "distinct_routes": _p(lambda s, b: traffic.distinct_routes(_routes(s, b), ROUTES)),
    "route_count": _p(lambda s, b: traffic.route_count(_routes(s, b), ROUTES)),
    "top_routes": _p(lambda s, b: traffic.top_routes(_routes(s, b), ROUTES)),
    "cargo_counts": _p(lambda s, b: traffic.cargo_counts(_pp(s, b))),
    "avg_by_daytype": _p(lambda s, b: traffic.avg_by_daytype(_pp(s, b))),
    # SQL analytics
    "sql_rolling_avg": _p(lambda s, b: Q.sql_rolling_avg(_pp(s, b))),
    "sql_hourly_surge": _p(lambda s, b: Q.sql_hourly_surge(_pp(s, b))),
    # Q3 over all carriers, and with the default floor
    "sql_peak_share": _p(lambda s, b: Q.sql_peak_share(_pp(s, b), M, min_flights=1)),
    "sql_peak_share_default": _p(lambda s, b: Q.sql_peak_share(_pp(s, b), M)),
    "sql_top_dest_per_carrier": _p(lambda s, b: Q.sql_top_dest_per_carrier(_pp(s, b), M)),
    "sql_grouping_sets": _p(lambda s, b: Q.sql_grouping_sets(_pp(s, b))),
    "sql_percentile_tier": _p(lambda s, b: Q.sql_percentile_tier(_pp(s, b))),
    "sql_avg_by_daytype": _p(lambda s, b: Q.sql_avg_by_daytype(_pp(s, b))),
    "sql_top_dest_dense": _p(lambda s, b: Q.sql_top_dest_dense(_pp(s, b), M)),
    # composite
    "preprocess": _p(_pp),
}


def all_queries() -> dict[str, Query]:
    out = dict(QUERIES)
    for mod in _extensions():
        out.update(getattr(mod, "QUERIES", {}))
    return out


def all_oracles() -> dict[str, str]:
    from .oracle import ORACLE
    out = dict(ORACLE)
    for mod in _extensions():
        out.update(getattr(mod, "ORACLE", {}))
    return {k: v for k, v in out.items() if k in all_queries()}


def _extensions() -> list:
    mods = []
    for name in ("peakflow.plans.ml_queries", "peakflow.sources.sink_queries"):
        try:
            mods.append(__import__(name, fromlist=["QUERIES"]))
        except ModuleNotFoundError as e:
            if e.name != name:
                raise
    return mods

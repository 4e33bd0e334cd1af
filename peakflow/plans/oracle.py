"""DuckDB oracle SQL for the registered queries.

Written independently of the Spark plans: the whole cleaning -> parse ->
validate -> dedupe -> label chain is re-derived here as DuckDB CTEs over the
pre-registered test tables. Riyadh local time is UTC+03:00 with no DST, so the
oracle shifts epoch seconds by 10,800; DuckDB's ``dayofweek`` is 0-based from
Sunday, Spark's 1-based. Outputs use the portable types of ``export.portable``.
"""

from __future__ import annotations

from ..sources.bindings import MOVEMENTS_RAW_SQL, REPEATS, ROUTES_SQL

EVENTS = ("(select *, unnest(range(case " + " ".join(f"when event_id % {n} = 0 then {k}" for n, k in REPEATS)
          + " else 1 end)) as copy from events)")
RAW = MOVEMENTS_RAW_SQL.replace("{events}", EVENTS)


def _nl(x: str) -> str:
    return f"CASE WHEN lower({x}) IN ('null','none','na','n/a','nan','') THEN NULL ELSE {x} END"


def _bad(x: str, n: int) -> str:
    return f"({x} IS NOT NULL AND NOT regexp_full_match({x}, '[A-Z0-9]{{{n}}}'))"


STR_COLS = ("scheduled_local_raw", "carrier_raw", "dest_raw", "origin_raw", "terminal_raw", "status")
PARSE = ("epoch(try_strptime(regexp_replace(scheduled_local_raw, 'Z$', '+00:00'), "
         "['%Y-%m-%d %H:%M:%S%z', '%Y-%m-%d %H:%M%z']))::BIGINT")
LOCAL_DATE = "CAST(make_timestamp((ts_epoch + 10800) * 1000000) AS DATE)"
KEYS = "scheduled_date_local, hour_of_day, day_of_week, terminal_group"

CTES = f"""
raw AS ({RAW}),
tr AS (SELECT movement_id, scheduled_local, {", ".join(f"trim({c}) AS {c}" for c in STR_COLS)}, is_cargo FROM raw),
nl AS (SELECT movement_id, scheduled_local, {", ".join(f"{_nl(c)} AS {c}" for c in STR_COLS)}, is_cargo FROM tr),
cl AS (SELECT movement_id, scheduled_local, scheduled_local_raw, carrier_raw,
              upper(dest_raw) AS dest_raw, upper(origin_raw) AS origin_raw,
              upper(regexp_replace(terminal_raw, '\\s+', '', 'g')) AS terminal_raw, status, is_cargo
       FROM nl),
pa AS (SELECT *, {PARSE} AS ts_epoch FROM cl),
fi AS (SELECT * FROM pa WHERE ts_epoch IS NOT NULL),
va AS (SELECT movement_id, scheduled_local, scheduled_local_raw, carrier_raw,
              COALESCE(CASE WHEN {_bad("dest_raw", 3)} THEN NULL ELSE dest_raw END, 'UNKNOWN') AS dest_raw,
              CASE WHEN {_bad("origin_raw", 3)} THEN NULL ELSE origin_raw END AS origin_raw,
              terminal_raw, status, is_cargo, ts_epoch AS scheduled_local_ts,
              {LOCAL_DATE} AS scheduled_date_local,
              CAST(((ts_epoch + 10800) // 3600) % 24 AS BIGINT) AS hour_of_day,
              CAST(dayofweek({LOCAL_DATE}) + 1 AS BIGINT) AS day_of_week,
              CAST(CASE WHEN dayofweek({LOCAL_DATE}) + 1 IN (6, 7) THEN 1 ELSE 0 END AS BIGINT) AS is_weekend,
              CAST(CASE WHEN is_cargo THEN 1 ELSE 0 END AS BIGINT) AS isCargo_int
       FROM fi),
dd AS (SELECT DISTINCT * FROM va),
tg AS (SELECT *, CASE WHEN terminal_raw IS NULL OR length(trim(terminal_raw)) = 0 THEN 'UNKNOWN'
                      ELSE terminal_raw END AS terminal_group FROM dd),
wi AS (SELECT {KEYS}, COUNT(*) AS flights_in_window FROM tg GROUP BY {KEYS}),
th AS (SELECT quantile_disc(flights_in_window, 0.75) AS threshold FROM wi),
lw AS (SELECT wi.*, CAST(CASE WHEN flights_in_window >= (SELECT threshold FROM th) THEN 1 ELSE 0 END AS BIGINT)
              AS peak_traffic_label FROM wi),
m AS (SELECT tg.*, lw.flights_in_window, lw.peak_traffic_label FROM tg JOIN lw USING ({KEYS})),
routes AS ({ROUTES_SQL})"""


def w(body: str) -> str:
    """``body`` below the shared CTEs; a body's own CTEs are added to them."""
    return "WITH" + CTES + (",\n" + body[5:] if body.startswith("WITH ") else "\n" + body)


NTZ = "strftime(scheduled_local, '%Y-%m-%d %H:%M:%S.%f') AS scheduled_local"
DAY = "strftime(scheduled_date_local, '%Y-%m-%d') AS scheduled_date_local"
RAW_OUT = f"movement_id, {NTZ}, scheduled_local_raw, carrier_raw, dest_raw, origin_raw, terminal_raw, status, is_cargo"
VALID_OUT = (f"movement_id, {NTZ}, scheduled_local_raw, carrier_raw, dest_raw, origin_raw, terminal_raw, status, "
             f"is_cargo, scheduled_local_ts, {DAY}, hour_of_day, day_of_week, is_weekend, isCargo_int")
PP_OUT = VALID_OUT + ", terminal_group, flights_in_window, peak_traffic_label"
REDUCED = ("SELECT movement_id, hour_of_day, day_of_week, is_weekend, carrier_raw AS carrier, status, isCargo_int, "
           "terminal_raw AS terminal, dest_raw AS destination, peak_traffic_label FROM m")


def _missing(src: str) -> str:
    cols = ["movement_id", "scheduled_local", "scheduled_local_raw", "carrier_raw", "dest_raw", "origin_raw",
            "terminal_raw", "status", "is_cargo"]
    if src == "m":
        cols += ["scheduled_local_ts", "scheduled_date_local", "hour_of_day", "day_of_week", "is_weekend",
                 "isCargo_int", "terminal_group", "flights_in_window", "peak_traffic_label"]
    parts = [f"SELECT '{c}' AS column, CAST(count(*) - count({c}) AS BIGINT) AS missing_count FROM {src}" for c in cols]
    return "(SELECT * FROM (" + " UNION ALL ".join(parts) + ") WHERE missing_count > 0)"


HOURLY = "SELECT hour_of_day, COUNT(*) AS flights_in_hour FROM m WHERE hour_of_day IS NOT NULL GROUP BY hour_of_day"
HOURLY_DD = "SELECT hour_of_day, COUNT(*) AS flights_in_hour FROM dd WHERE hour_of_day IS NOT NULL GROUP BY hour_of_day"
BOUNDS = f"""(SELECT q1, q3, q3 - q1 AS iqr, q1 - 1.5 * (q3 - q1) AS lower_bound, q3 + 1.5 * (q3 - q1) AS upper_bound
   FROM (SELECT CAST(quantile_disc(flights_in_hour, 0.25) AS DOUBLE) AS q1,
                CAST(quantile_disc(flights_in_hour, 0.75) AS DOUBLE) AS q3 FROM ({HOURLY_DD})))"""


def _flag(col: str, zero: str, one: str) -> str:
    return w(f"""SELECT {col}, CASE WHEN {col} = 1 THEN '{one}' WHEN {col} = 0 THEN '{zero}' ELSE 'OTHER' END AS kind,
       COUNT(*) AS flights FROM m WHERE {col} IS NOT NULL GROUP BY {col}""")


def _top(expr: str, name: str, src: str = "m", k: int | None = 10) -> str:
    lim = f" LIMIT {k}" if k else ""
    return w(f"""SELECT COALESCE(CAST({expr} AS VARCHAR), 'UNKNOWN') AS {name}, COUNT(*) AS flights FROM {src}
GROUP BY 1 ORDER BY flights DESC, {name}{lim}""")


def _by_label(expr: str, name: str) -> str:
    return w(f"""SELECT COALESCE(CAST({expr} AS VARCHAR), 'UNKNOWN') AS {name}, peak_traffic_label, COUNT(*) AS flights
FROM m WHERE peak_traffic_label IS NOT NULL GROUP BY 1, 2
ORDER BY flights DESC, {name}, peak_traffic_label LIMIT 15""")


ROUTE = "COALESCE(origin, 'UNKNOWN') AS origin, COALESCE(destination, 'UNKNOWN') AS destination"

def _peak_share(floor: int) -> str:
    return f"""SELECT airline_name, total_flights, peak_flights, round(peak_flights / total_flights * 100, 2) AS peak_share_pct
FROM (SELECT ifnull(carrier_raw, 'UNKNOWN') AS airline_name, count(*) AS total_flights,
             count(*) FILTER (peak_traffic_label = 1) AS peak_flights
      FROM m WHERE peak_traffic_label IS NOT NULL GROUP BY ALL)
WHERE total_flights >= {floor} ORDER BY peak_flights / total_flights DESC, airline_name LIMIT 10"""


# The eight answers, from counting and joining rather than from window functions.
ANSWERS = {
    "sql_rolling_avg": f"""WITH h AS ({HOURLY}), o AS (
  SELECT h.*, (SELECT count(*) FROM h x WHERE x.hour_of_day < h.hour_of_day) AS place,
         (SELECT count(*) FROM h x WHERE (x.flights_in_hour, -x.hour_of_day) > (h.flights_in_hour, -h.hour_of_day)) AS above,
         (SELECT count(*) FROM h) AS n FROM h)
SELECT hour_of_day, flights_in_hour,
       (SELECT round(avg(x.flights_in_hour), 2) FROM o x WHERE abs(x.place - o.place) <= 1) AS rolling_3hr_avg,
       CAST(CASE WHEN above < (n % 4) * (n // 4 + 1) THEN above // (n // 4 + 1)
                 ELSE n % 4 + (above - (n % 4) * (n // 4 + 1)) // (n // 4) END + 1 AS BIGINT) AS intensity_quartile
FROM o""",
    "sql_hourly_surge": f"""WITH h AS ({HOURLY}), p AS (
  SELECT h.*, (SELECT arg_max(x.flights_in_hour, x.hour_of_day) FROM h x WHERE x.hour_of_day < h.hour_of_day) AS prev_hour_flights FROM h)
SELECT *, flights_in_hour - prev_hour_flights AS delta,
       round((flights_in_hour / nullif(prev_hour_flights, 0) - 1) * 100, 2) AS pct_change FROM p""",
    "sql_peak_share": _peak_share(1),
    "sql_top_dest_per_carrier": """SELECT airline_name, arg_max(destination, (n, [-unicode(c) FOR c IN string_split(destination, '')])) AS destination,
       max(n) AS peak_flight_count
FROM (SELECT ifnull(carrier_raw, 'UNKNOWN') AS airline_name, ifnull(dest_raw, 'UNKNOWN') AS destination, count(*) AS n
      FROM m WHERE peak_traffic_label = 1 GROUP BY ALL)
GROUP BY airline_name ORDER BY peak_flight_count DESC, airline_name LIMIT 10""",
    "sql_grouping_sets": """SELECT hour_of_day, ['Weekday', 'Weekend', 'ALL_DAYS'][kind + 1] AS day_type, count(*) AS flight_count
FROM (SELECT unnest([hour_of_day, NULL]) AS hour_of_day, is_weekend FROM m WHERE hour_of_day IS NOT NULL AND is_weekend IS NOT NULL) h,
     LATERAL (SELECT unnest([h.is_weekend, 2]) AS kind) GROUP BY ALL""",
    "sql_percentile_tier": f"""WITH h AS ({HOURLY}), r AS (
  SELECT h.*, (SELECT count(*) FROM h x WHERE x.flights_in_hour < h.flights_in_hour)
              / greatest((SELECT count(*) FROM h) - 1, 1) AS below FROM h)
SELECT hour_of_day, flights_in_hour, round(below, 3) AS percentile_rank,
       ['Low', 'Moderate', 'High', 'Peak'][1 + CAST(least(floor(below * 4), 3) AS INTEGER)] AS intensity_tier FROM r""",
    "sql_avg_by_daytype": """SELECT ['Weekday', 'Weekend'][is_weekend + 1] AS day_type,
       round(count(*) / count(DISTINCT hour_of_day), 2) AS avg_hourly_traffic
FROM m WHERE is_weekend IS NOT NULL AND hour_of_day IS NOT NULL GROUP BY is_weekend""",
    "sql_top_dest_dense": """WITH d AS (SELECT ifnull(dest_raw, 'UNKNOWN') AS destination, count(*) AS flight_count FROM m WHERE peak_traffic_label = 1 GROUP BY 1)
SELECT d.*, (SELECT count(DISTINCT x.flight_count) FROM d x WHERE x.flight_count > d.flight_count) + 1 AS rank_num FROM d
WHERE (SELECT count(DISTINCT x.flight_count) FROM d x WHERE x.flight_count > d.flight_count) < 5""",
}

ORACLE: dict[str, str] = {
    "scan_movements": w(f"SELECT {RAW_OUT} FROM raw"),
    "trim_strings": w(f"SELECT {RAW_OUT} FROM tr"),
    "null_like_to_null": w(f"SELECT movement_id, {NTZ}, "
                           + ", ".join(f"{_nl(c)} AS {c}" for c in STR_COLS) + ", is_cargo FROM raw"),
    "upper_codes": w(f"SELECT movement_id, {NTZ}, scheduled_local_raw, carrier_raw, upper(dest_raw) AS dest_raw, "
                     "upper(origin_raw) AS origin_raw, terminal_raw, status, is_cargo FROM raw"),
    "normalize_terminal": w(f"SELECT movement_id, {NTZ}, scheduled_local_raw, carrier_raw, dest_raw, origin_raw, "
                            "upper(regexp_replace(terminal_raw, '\\s+', '', 'g')) AS terminal_raw, status, is_cargo "
                            "FROM raw"),
    "regex_nullify": w(f"SELECT movement_id, {NTZ}, scheduled_local_raw, carrier_raw, "
                       f"CASE WHEN {_bad('dest_raw', 3)} THEN NULL ELSE dest_raw END AS dest_raw, "
                       f"CASE WHEN {_bad('origin_raw', 3)} THEN NULL ELSE origin_raw END AS origin_raw, "
                       "terminal_raw, status, is_cargo FROM cl"),
    "invalid_format_counts": w(f"""SELECT 'origin_raw' AS column, CAST(count_if({_bad('origin_raw', 3)}) AS BIGINT)
       AS invalid_count FROM fi
UNION ALL SELECT 'dest_raw', CAST(count_if({_bad('dest_raw', 3)}) AS BIGINT) FROM fi"""),
    "parse_timestamps": w("SELECT movement_id, scheduled_local_raw, ts_epoch AS scheduled_local_ts FROM pa"),
    "filter_unparsed": w(f"SELECT movement_id, {NTZ}, scheduled_local_raw, carrier_raw, dest_raw, origin_raw, "
                         "terminal_raw, status, is_cargo, ts_epoch AS scheduled_local_ts FROM fi"),
    "unparsed_count": w("SELECT COUNT(*) AS rows_before, count_if(ts_epoch IS NOT NULL) AS rows_after, "
                        "count_if(ts_epoch IS NULL) AS rows_removed FROM pa"),
    "time_parts": w(f"SELECT movement_id, {DAY}, hour_of_day, day_of_week, is_weekend FROM "
                    f"(SELECT movement_id, {LOCAL_DATE} AS scheduled_date_local, "
                    "CAST(((ts_epoch + 10800) // 3600) % 24 AS BIGINT) AS hour_of_day, "
                    f"CAST(dayofweek({LOCAL_DATE}) + 1 AS BIGINT) AS day_of_week, "
                    f"CAST(CASE WHEN dayofweek({LOCAL_DATE}) + 1 IN (6, 7) THEN 1 ELSE 0 END AS BIGINT) AS is_weekend "
                    "FROM fi)"),
    "bool_flag": w("SELECT movement_id, is_cargo, CAST(CASE WHEN is_cargo THEN 1 ELSE 0 END AS BIGINT) AS isCargo_int "
                   "FROM raw"),
    "fill_unknown": w("SELECT movement_id, dest_raw, origin_raw FROM va"),
    "terminal_group": w("SELECT movement_id, terminal_raw, CASE WHEN terminal_raw IS NULL OR "
                        "length(trim(terminal_raw)) = 0 THEN 'UNKNOWN' ELSE terminal_raw END AS terminal_group FROM cl"),
    "reduce_columns": w("SELECT movement_id, hour_of_day, day_of_week, is_weekend, carrier_raw, status, isCargo_int, "
                        "terminal_raw, dest_raw, peak_traffic_label FROM m"),
    "rename_dotted": w(REDUCED),
    "cast_columns": w(REDUCED),
    "label_column": w("SELECT movement_id, CAST(peak_traffic_label AS DOUBLE) AS label FROM m "
                      "WHERE peak_traffic_label IS NOT NULL"),
    "clean_categoricals": w("""SELECT movement_id, hour_of_day, day_of_week, is_weekend,
  CASE WHEN carrier IS NULL OR length(trim(carrier)) = 0 THEN 'UNKNOWN' ELSE trim(carrier) END AS carrier,
  CASE WHEN status IS NULL OR length(trim(status)) = 0 THEN 'UNKNOWN' ELSE trim(status) END AS status,
  isCargo_int,
  upper(CASE WHEN terminal IS NULL OR length(trim(terminal)) = 0 THEN 'UNKNOWN' ELSE trim(terminal) END) AS terminal,
  upper(CASE WHEN destination IS NULL OR length(trim(destination)) = 0 THEN 'UNKNOWN' ELSE trim(destination) END)
    AS destination,
  peak_traffic_label
FROM (""" + REDUCED + ")"),
    "flatten_array": w("SELECT movement_id, concat_ws(',', status, carrier_raw, dest_raw) AS tags FROM raw"),
    "safe_casts": w("SELECT movement_id, COALESCE(carrier_raw, 'UNKNOWN') AS carrier_raw, "
                    "COALESCE(origin_raw, 'UNKNOWN') AS origin_raw, COALESCE(hour_of_day, 0) AS hour_of_day, "
                    "COALESCE(peak_traffic_label, 0) AS peak_traffic_label FROM m"),
    "traffic_windows": w(f"SELECT {DAY}, hour_of_day, day_of_week, terminal_group, flights_in_window FROM wi"),
    "peak_threshold_histograms": w("SELECT CAST(threshold AS DOUBLE) AS threshold FROM th"),
    "peak_threshold": w("SELECT CAST(threshold AS DOUBLE) AS threshold FROM th"),
    "label_windows": w(f"SELECT {DAY}, hour_of_day, day_of_week, terminal_group, flights_in_window, "
                       "peak_traffic_label FROM lw"),
    "label_rows": w("SELECT movement_id, terminal_group, flights_in_window, peak_traffic_label FROM m"),
    "label_rows_join": w("SELECT movement_id, terminal_group, flights_in_window, peak_traffic_label FROM m"),
    "label_rows_window": w("SELECT movement_id, terminal_group, flights_in_window, peak_traffic_label FROM m"),
    "hourly_label_counts": w("SELECT hour_of_day, peak_traffic_label, COUNT(*) AS count FROM m GROUP BY 1, 2"),
    "label_distribution": w("SELECT peak_traffic_label, COUNT(*) AS count FROM m "
                            "WHERE peak_traffic_label IS NOT NULL GROUP BY 1"),
    "busiest_windows": w(f"""SELECT {DAY}, hour_of_day, day_of_week, terminal_group, flights_in_window, peak_traffic_label
FROM (SELECT DISTINCT {KEYS}, flights_in_window, peak_traffic_label FROM m)
ORDER BY flights_in_window DESC, {KEYS} LIMIT 30"""),
    "missing_summary": w("SELECT * FROM " + _missing("raw")),
    "missing_compare": w(f"""SELECT COALESCE(b.column, a.column) AS column,
       COALESCE(b.missing_count, 0) AS before_missing, COALESCE(a.missing_count, 0) AS after_missing,
       COALESCE(a.missing_count, 0) - COALESCE(b.missing_count, 0) AS missing_change
FROM {_missing("raw")} b FULL OUTER JOIN {_missing("m")} a ON a.column = b.column"""),
    "iqr_bounds": w("SELECT * FROM " + BOUNDS),
    "iqr_outliers": w(f"""SELECT hour_of_day, flights_in_hour FROM ({HOURLY_DD}) h, {BOUNDS} b
WHERE flights_in_hour < b.lower_bound OR flights_in_hour > b.upper_bound"""),
    "dedupe_rows": w(f"SELECT {VALID_OUT} FROM (SELECT DISTINCT * FROM va)"),
    "dedupe_rows_prints": w(f"SELECT {VALID_OUT} FROM (SELECT DISTINCT * FROM va)"),
    "duplicate_report": w("""SELECT (SELECT 2 * COUNT(*) FROM va) AS rows_before,
       (SELECT COUNT(*) FROM (SELECT DISTINCT * FROM va)) AS rows_after,
       (SELECT 2 * COUNT(*) FROM va) - (SELECT COUNT(*) FROM (SELECT DISTINCT * FROM va)) AS duplicates_removed"""),
    "volume_report": w("""SELECT (SELECT COUNT(*) FROM raw) AS rows_before, (SELECT COUNT(*) FROM m) AS rows_after,
       (SELECT COUNT(*) FROM raw) - (SELECT COUNT(*) FROM m) AS rows_removed,
       CAST(9 AS BIGINT) AS cols_before, CAST(18 AS BIGINT) AS cols_after"""),
    "rows_total": w("SELECT COUNT(*) AS rows FROM m"),
    "hourly_counts": w(HOURLY),
    "first_hour": w(HOURLY + " ORDER BY hour_of_day LIMIT 1"),
    "hourly_total": w(f"SELECT CAST(SUM(flights_in_hour) AS BIGINT) AS total_flights FROM ({HOURLY})"),
    "weekend_counts": _flag("is_weekend", "Weekday", "Weekend"),
    "cargo_counts": _flag("isCargo_int", "Passenger", "Cargo"),
    "top_carriers": _top("carrier_raw", "carrier"),
    "top_destinations": _top("destination", "destination", "routes"),
    "status_distribution": _top("status", "status", "m", None),
    "carrier_by_label": _by_label("carrier_raw", "carrier"),
    "destination_by_label": _by_label("dest_raw", "destination"),
    "distinct_routes": w(f"SELECT DISTINCT {ROUTE} FROM routes"),
    "route_count": w(f"SELECT COUNT(*) AS distinct_routes FROM (SELECT DISTINCT {ROUTE} FROM routes)"),
    "top_routes": w(f"SELECT {ROUTE}, COUNT(*) AS flights FROM routes GROUP BY 1, 2 "
                    "ORDER BY flights DESC, origin, destination LIMIT 10"),
    "avg_by_daytype": w("""SELECT is_weekend, CASE WHEN is_weekend = 1 THEN 'Weekend' WHEN is_weekend = 0 THEN 'Weekday'
  END AS day_type, AVG(flights) AS avg_hourly_traffic
FROM (SELECT is_weekend, hour_of_day, COUNT(*) AS flights FROM m
      WHERE is_weekend IS NOT NULL AND hour_of_day IS NOT NULL GROUP BY 1, 2) GROUP BY is_weekend"""),
    **{key: w(body) for key, body in ANSWERS.items()},
    "sql_peak_share_default": w(_peak_share(1000)),
    "preprocess": w(f"SELECT {PP_OUT} FROM m"),
}

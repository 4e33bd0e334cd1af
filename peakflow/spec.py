"""Column roles and default parameters of the movement operators.

Every operator takes a :class:`MovementSpec` that says which column holds
which role, so the same operators run on the reference's flattened flight
schema and on any other movement/event table.
"""

from __future__ import annotations

from dataclasses import dataclass, replace

# ---------------------------------------------------------------------------
# Fixed values that must equal the reference's for equal results.
# ---------------------------------------------------------------------------

# Strings treated as missing after trimming (compared case-insensitively).
NULL_LIKE_TOKENS = ("null", "none", "na", "n/a", "nan", "")

# Code columns upper-cased during cleaning.
CODE_COLUMNS = (
    "aircraft.reg",
    "aircraft.modeS",
    "airline.iata",
    "airline.icao",
    "origin_airport_iata",
    "origin_airport_icao",
    "destination_airport_iata",
    "destination_airport_icao",
)

# Format rules: column -> number of [A-Z0-9] characters the whole value must have.
FORMAT_RULES = (
    ("airline.iata", 2),
    ("airline.icao", 3),
    ("origin_airport_iata", 3),
    ("origin_airport_icao", 4),
    ("destination_airport_iata", 3),
    ("destination_airport_icao", 4),
)

# Columns whose NULLs become the literal UNKNOWN after validation.
FILL_UNKNOWN_COLUMNS = (
    "airline.icao",
    "airline.iata",
    "destination_airport_icao",
    "destination_airport_iata",
)

# Timestamp patterns tried in order after a trailing Z is rewritten as +00:00.
TIMESTAMP_PATTERNS = (
    "yyyy-MM-dd HH:mm:ssXXX",
    "yyyy-MM-dd HH:mmXXX",
    "yyyy-MM-dd HH:mm:ssX",
    "yyyy-MM-dd HH:mmX",
)

# A string names a zone or offset if a letter, or a sign and a digit, follows its hours and minutes;
# it is dated if it begins with a year of four digits or more.
ZONED = r"\d:\d\d.*([A-Za-z]|[+-]\d)"
DATED_AND_ZONED = r"^\s*[+-]?\d{4,}.*" + ZONED
# A date, hours and minutes (16 characters) and an offset, but no seconds, which Spark's cast asks for.
NO_SECONDS = r"^\d{4}-\d\d-\d\d \d\d:\d\d(Z|[+-]\d\d(:?\d\d)?)$"

# dayofweek() values counted as weekend (1 = Sunday ... 7 = Saturday): Friday, Saturday.
WEEKEND_DAYS = (6, 7)

TIME_ZONE = "Asia/Riyadh"
PEAK_PERCENTILE = 0.75
IQR_MULTIPLIER = 1.5
UNKNOWN = "UNKNOWN"
ALL_TERMINALS = "ALL"

# Columns kept by the reduction step, in order.
KEEP_COLUMNS = (
    "hour_of_day",
    "day_of_week",
    "is_weekend",
    "airline.name",
    "status",
    "flight_type",
    "isCargo_int",
    "movement.terminal",
    "movement.airport.timeZone",
    "aircraft.model",
    "destination_airport_iata",
    "destination_airport_icao",
    "destination_airport_name",
    "peak_traffic_label",
)

# Dotted names renamed before feature encoding.
RENAME_MAP = (
    ("airline.name", "airline_name"),
    ("movement.terminal", "movement_terminal"),
    ("movement.airport.timeZone", "movement_airport_timeZone"),
    ("aircraft.model", "aircraft_model"),
)

# Categorical feature columns (after renaming), and the ones upper-cased.
CATEGORICAL_COLUMNS = (
    "airline_name",
    "status",
    "flight_type",
    "movement_terminal",
    "movement_airport_timeZone",
    "aircraft_model",
    "destination_airport_iata",
    "destination_airport_icao",
    "destination_airport_name",
)
CATEGORICAL_UPPER = ("destination_airport_iata", "destination_airport_icao", "movement_terminal")

# Numeric feature columns, and the columns cast to int before encoding.
NUMERIC_COLUMNS = ("hour_of_day", "day_of_week", "is_weekend", "isCargo_int")
INT_COLUMNS = ("hour_of_day", "day_of_week", "is_weekend", "isCargo_int", "peak_traffic_label")

# Random forest and split settings.
TRAIN_FRACTION = 0.7
SEED = 42
NUM_TREES = 100
MAX_DEPTH = 10

# Top-k sizes of the keyed-count reports and the SQL queries.
TOP_K = 10
TOP_K_BY_LABEL = 15
PEAK_SHARE_MIN_FLIGHTS = 1000
DENSE_RANK_MAX = 5

# Output columns of the eight answers.
ANSWER_COLUMNS = {
    "sql_rolling_avg": ("hour_of_day", "flights_in_hour", "rolling_3hr_avg", "intensity_quartile"),
    "sql_hourly_surge": ("hour_of_day", "flights_in_hour", "prev_hour_flights", "delta", "pct_change"),
    "sql_peak_share": ("airline_name", "total_flights", "peak_flights", "peak_share_pct"),
    "sql_top_dest_per_carrier": ("airline_name", "destination", "peak_flight_count"),
    "sql_grouping_sets": ("hour_of_day", "day_type", "flight_count"),
    "sql_percentile_tier": ("hour_of_day", "flights_in_hour", "percentile_rank", "intensity_tier"),
    "sql_avg_by_daytype": ("day_type", "avg_hourly_traffic"),
    "sql_top_dest_dense": ("destination", "flight_count", "rank_num"),
}

# ---------------------------------------------------------------------------
# Names of derived columns.
# ---------------------------------------------------------------------------
LOCAL_TS = "scheduled_local_ts"
UTC_TS = "scheduled_utc_ts"
DATE = "scheduled_date_local"
HOUR = "hour_of_day"
WEEKDAY = "day_of_week"
WEEKEND = "is_weekend"
CARGO_INT = "isCargo_int"
TERMINAL_GROUP = "terminal_group"
WINDOW_COUNT = "flights_in_window"
LABEL = "peak_traffic_label"
WINDOW_KEYS = (DATE, HOUR, WEEKDAY, TERMINAL_GROUP)


def format_pattern(width: int) -> str:
    """Whole-value pattern for a code of ``width`` upper-case letters or digits.

    ``\\A`` and ``\\z`` anchor at the true ends, so a trailing newline fails.
    """
    return r"\A[A-Z0-9]{%d}\z" % width


@dataclass(frozen=True)
class MovementSpec:
    """Which column plays which role in a movement table.

    Defaults are the reference's flattened flight schema. A role whose column is
    absent from the frame is skipped by every operator (schema tolerance).
    """

    local_time: str | None = "movement.scheduledTime.local"
    utc_time: str | None = "movement.scheduledTime.utc"
    terminal: str | None = "movement.terminal"
    carrier: str = "airline.name"
    origin: str = "origin_airport_iata"
    destination: str = "destination_airport_iata"
    status: str = "status"
    cargo: str | None = "isCargo"
    upper_columns: tuple[str, ...] = CODE_COLUMNS
    format_rules: tuple[tuple[str, int], ...] = FORMAT_RULES
    fill_unknown: tuple[str, ...] = FILL_UNKNOWN_COLUMNS
    null_tokens: tuple[str, ...] = NULL_LIKE_TOKENS
    timestamp_patterns: tuple[str, ...] = TIMESTAMP_PATTERNS
    weekend_days: tuple[int, ...] = WEEKEND_DAYS
    time_zone: str = TIME_ZONE
    peak_percentile: float = PEAK_PERCENTILE
    iqr_multiplier: float = IQR_MULTIPLIER
    keep_columns: tuple[str, ...] = KEEP_COLUMNS
    rename_map: tuple[tuple[str, str], ...] = RENAME_MAP
    categorical_columns: tuple[str, ...] = CATEGORICAL_COLUMNS
    categorical_upper: tuple[str, ...] = CATEGORICAL_UPPER
    numeric_columns: tuple[str, ...] = NUMERIC_COLUMNS
    int_columns: tuple[str, ...] = INT_COLUMNS

    def with_(self, **changes) -> "MovementSpec":
        return replace(self, **changes)


FLIGHTS = MovementSpec()

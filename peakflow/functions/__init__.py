"""Column expressions (built-in Spark functions only)."""

from .columns import (  # noqa: F401
    blank_or_null, bool_to_int, day_type, null_if_like, nullify_unless, present, qcol,
    safe_int, safe_string, squeeze_upper, string_columns, unknown_if_blank,
)
from .timestamps import local_wall_clock, parse_timestamp  # noqa: F401

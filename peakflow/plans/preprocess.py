"""The composite cleaning + labelling plan, and its companion reports.

``preprocess`` is lazy and runs no action: it returns one logical plan
(scan -> one collapsed projection -> filter -> dedupe aggregate -> window
aggregate + scalar-subquery threshold -> join back). Reports are separate lazy
frames over the same stages, so a caller that wants both can ``persist`` or
``checkpoint`` the stage it shares.

Step order matters and follows the reference: upper-casing precedes the format
rules (lower-case codes are valid), ``UNKNOWN`` is filled after them (else it
would be nullified), and dedupe precedes the label so duplicates do not
inflate window volumes.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame

from ..operators import clean, label, quality, timeparts
from ..functions.columns import qcol
from ..spec import FLIGHTS, LOCAL_TS, MovementSpec


def cleaned(df: DataFrame, spec: MovementSpec = FLIGHTS) -> DataFrame:
    """trim -> null-like -> upper codes -> terminal -> parse times (unfiltered)."""
    return timeparts.parse_timestamps(clean.clean_strings(df, spec), spec)


def _checked(df: DataFrame, spec: MovementSpec) -> DataFrame:
    """``cleaned`` -> drop unparsable -> format rules -> fill UNKNOWN (no derived parts yet)."""
    out = timeparts.filter_unparsed(cleaned(df, spec), LOCAL_TS)
    out = clean.regex_nullify(out, spec.format_rules)
    return clean.fill_unknown(out, spec.fill_unknown)


def _derived(df: DataFrame, spec: MovementSpec) -> DataFrame:
    """Time parts and cargo flag: pure functions of columns already present."""
    return clean.bool_flag(timeparts.time_parts(df, spec, LOCAL_TS), spec.cargo)


def validated(df: DataFrame, spec: MovementSpec = FLIGHTS) -> DataFrame:
    """``cleaned`` -> drop unparsable -> format rules -> time parts -> cargo flag -> fill UNKNOWN.

    (Fill and the derived parts touch different columns, so their order is free.)
    """
    return _derived(_checked(df, spec), spec)


def deduplicated(df: DataFrame, spec: MovementSpec = FLIGHTS) -> DataFrame:
    """``validated`` with full-row duplicates removed.

    The derived columns are deterministic functions of the other columns, so
    deduplicating before deriving them yields exactly the same rows, while the
    dedupe shuffle carries narrower rows and the derivation runs once per
    distinct row. The parsed instant stays in the key (it is what is hard to
    recompute); date/hour/weekday/weekend/cargo flag are added after.
    """
    return _derived(quality.dedupe_rows(_checked(df, spec)), spec)


def preprocess(df: DataFrame, spec: MovementSpec = FLIGHTS, label_method: str = "join") -> DataFrame:
    """Clean, validate, dedupe and label a raw movement frame. No actions."""
    return label.label_rows(deduplicated(df, spec), spec, method=label_method)


@dataclass
class PreprocessReports:
    """Lazy reports of one preprocessing run (the reference prints these)."""

    missing_before: DataFrame
    missing_after: DataFrame
    missing_compare: DataFrame
    unparsed: DataFrame
    invalid_formats: DataFrame
    duplicates: DataFrame
    iqr_bounds: DataFrame
    iqr_outliers: DataFrame
    volume: DataFrame
    hourly_labels: DataFrame
    label_distribution: DataFrame
    busiest_windows: DataFrame


def cleaning_summary(raw: DataFrame, spec: MovementSpec = FLIGHTS) -> quality.CleaningSummary:
    """One aggregate over the parsed raw frame: raw missing values, unparsed,
    invalid-format and pre-dedupe counts.

    Raw NULLs are flagged before cleaning (which only rewrites string and code
    columns, so the boolean flags pass through) and counted in the same pass.
    """
    flags = [(c, f"__raw_null_{i}") for i, c in enumerate(raw.columns)]
    tagged = raw.withColumns({f: qcol(c).isNull() for c, f in flags})
    return quality.cleaning_summary(cleaned(tagged, spec), spec.format_rules, LOCAL_TS, flags)


def reports(raw: DataFrame, spec: MovementSpec = FLIGHTS, result: DataFrame | None = None,
            summary: quality.CleaningSummary | None = None) -> PreprocessReports:
    """Lazy reports of ``preprocess(raw)``. Pass ``summary`` (e.g. a written
    :func:`cleaning_summary` frame) so the reports built on it do not each re-run it."""
    result = result if result is not None else preprocess(raw, spec)
    summary = summary if summary is not None else cleaning_summary(raw, spec)
    m_before = summary.missing_before()
    m_after = quality.missing_summary(result)
    return PreprocessReports(
        missing_before=m_before,
        missing_after=m_after,
        missing_compare=quality.missing_compare(m_before, m_after),
        unparsed=summary.unparsed(),
        invalid_formats=summary.invalid_formats(),
        # rows before dedupe: the rows that pass the time filter; after: the result's rows
        duplicates=summary.duplicates(result),
        # The labelled result holds exactly the deduplicated rows (the label join
        # never adds or drops rows), so the hourly fences are taken from it.
        iqr_bounds=quality.iqr_bounds(result, spec.iqr_multiplier),
        iqr_outliers=quality.iqr_outliers(result, spec.iqr_multiplier),
        volume=summary.volume(result, len(raw.columns)),
        hourly_labels=label.hourly_label_counts(result),
        label_distribution=label.label_distribution(result),
        busiest_windows=label.busiest_windows(result),
    )

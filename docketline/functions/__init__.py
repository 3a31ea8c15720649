"""Scalar column functions (built-in Spark expressions only)."""

from .keys import (date_key, iso_weekday, phase_bucket, surrogate_key, week_label,
                   weekday_ordinal)
from .parse import (array_first, case_number_parts, clamp_date, parse_event_ts,
                    parse_filing_ts, parse_json_array)

__all__ = [
    "array_first", "case_number_parts", "clamp_date", "date_key", "iso_weekday",
    "parse_event_ts", "parse_filing_ts", "parse_json_array", "phase_bucket",
    "surrogate_key", "week_label", "weekday_ordinal",
]

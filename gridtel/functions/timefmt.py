"""Timestamp parsing and formatting (session time zone is UTC)."""
from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# --- fixed values: strict RFC3339 (optional fraction, zone required) -------
RFC3339_PATTERN = r"^\d{4}-\d{2}-\d{2}T\d{2}:\d{2}:\d{2}(\.\d+)?(Z|[+-]\d{2}:\d{2})$"
RFC3339_OUT = "yyyy-MM-dd'T'HH:mm:ss'Z'"


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def parse_rfc3339(text) -> Column:
    """Instant of a strict RFC3339 string; NULL for anything else.

    The pattern guard rejects forms a bare cast would accept (date only,
    missing zone); ``try_cast`` handles impossible dates such as month 13.
    """
    t = _c(text)
    return F.when(t.rlike(RFC3339_PATTERN), t.try_cast("timestamp"))


def normalize_ts(text) -> Column:
    """RFC3339 text -> instant truncated to the second."""
    return F.date_trunc("second", parse_rfc3339(text))


def to_rfc3339(ts) -> Column:
    """Instant -> RFC3339 UTC text with second precision."""
    return F.date_format(_c(ts), RFC3339_OUT)


def day_of_week_sunday0(ts) -> Column:
    """0 = Sunday ... 6 = Saturday."""
    return F.dayofweek(_c(ts)) - 1


def weekday_name_padded(ts) -> Column:
    """English day name blank-padded to 9 characters."""
    return F.rpad(F.date_format(_c(ts), "EEEE"), 9, " ")

"""Scalar expressions; all run in the JVM."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

_UNITS = {"us": 1, "ms": 1_000, "s": 1_000_000, "min": 60_000_000, "h": 3_600_000_000, "d": 86_400_000_000}
_STRICT = r"^\d{4}-\d\d-\d\dT\d\d:\d\d:\d\d\.\d{1,9}(Z|[+-]\d\d:?\d\d)$"


def micros(duration: str | int) -> int:
    """'5min', '300 min', '1h', '2D' in microseconds; an int is microseconds already."""
    if isinstance(duration, int):
        return duration
    found = re.fullmatch(r"\s*(\d*\.?\d+)\s*([A-Za-z]+)\s*", duration)
    unit = found and {"m": "min", "minutes": "min", "hours": "h", "hour": "h", "days": "d", "day": "d", "sec": "s"}.get(found[2].lower(), found[2].lower())
    if not found or unit not in _UNITS:
        raise ValueError(f"not a duration: {duration!r}")
    return round(float(found[1]) * _UNITS[unit])


def strict_timestamp(text: Column) -> Column:
    """ISO timestamp with a fraction and a zone; null for any other form."""
    return F.when(text.rlike(_STRICT), text.try_cast("timestamp"))


def lenient_timestamp(text: Column) -> Column:
    """Any form that a cast takes; null for others."""
    return text.try_cast("timestamp")


def fixed_timestamp(text: Column) -> Column:
    """`YYYY-MM-DD HH:MM:SS`, as daily summaries have it; null for any other form."""
    return F.when(text.rlike(r"^\d{4}-\d\d-\d\d \d\d:\d\d:\d\d$"), text.try_cast("timestamp"))


def required_timestamp(text: Column) -> Column:
    """A timestamp, or an error that names the value: for columns in which nothing but times may stand."""
    time = text.try_cast("timestamp")
    return F.when(text.isNull() | time.isNotNull(), time).otherwise(F.raise_error(F.concat(F.lit("not a time: "), text)))


def month_start(name: Column) -> Column:
    """First day of a month named `YYYY-MM`; null for any other form."""
    return F.when(name.rlike(r"^\d{4}-\d\d$"), F.concat(name, F.lit("-01")).try_cast("date"))


def axis_label(date: Column, unit: str) -> Column:
    """Label of a date on an axis of years, months or days."""
    return F.date_format(date, {"year": "yyyy", "month": "yyyy-MM", "day": "yyyy-MM-dd"}[unit])


def normal_source(source: Column) -> Column:
    """White space of any script off both ends, lower case."""
    return F.lower(F.regexp_replace(source, r"(?U)^\s+|\s+$", ""))


def safe_name(name: Column) -> Column:
    """Letters, digits, _ and - of any script stay; others become _."""
    return F.regexp_replace(name, r"[^\p{L}\p{N}_-]", "_")


def clip_upper(value: Column, limit: float | None) -> Column:
    """Values above the limit become it; null stays null."""
    return value if limit is None else F.when(value > limit, F.lit(float(limit))).otherwise(value)


def safe_divide(value: Column, by: Column) -> Column:
    """value / by, or 0 where by is 0, negative or missing."""
    return F.when(by > 0, value / by).otherwise(F.lit(0.0))


def whole(value: Column) -> Column:
    """Cut off towards zero."""
    return value.cast("bigint")


def seconds_between(start: Column, end: Column) -> Column:
    return (F.unix_micros(end) - F.unix_micros(start)) / F.lit(1_000_000)


def month(ts: Column) -> Column:
    return F.date_format(ts, "yyyy-MM")


def stem(path: Column) -> Column:
    """File name without folders and extension."""
    return F.regexp_replace(F.regexp_extract(path, r"([^/]+)$", 1), r"\.[^.]*$", "")


def parent(path: Column) -> Column:
    """Name of the folder a file lies in."""
    return F.regexp_extract(path, r"([^/]+)/[^/]+$", 1)

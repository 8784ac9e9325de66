"""Continuous segments of a series under a gap tolerance."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.scalars import micros, seconds_between


def mark_segments(df: DataFrame, tolerance: str | int, *, keys: Sequence[str] = ("participant_id", "name"), order: Sequence[str] = (), start: str = "start_date", end: str = "end_date") -> DataFrame:
    """Adds segment (0, 1, ...) within each key.

    A segment begins where the gap to the end of the row before (not to the latest end so far)
    exceeds the tolerance; a gap equal to it stays inside. Rows go by start, end, then order.
    """
    line = Window.partitionBy(*keys).orderBy(start, end, *order)
    gap = F.unix_micros(start) - F.unix_micros(F.coalesce(F.lag(end).over(line), F.col(start)))
    opened = df.where(F.col(start).isNotNull() & F.col(end).isNotNull()).withColumn("__new", (gap > micros(tolerance)).cast("long"))
    return opened.withColumn("segment", F.sum("__new").over(line.rowsBetween(Window.unboundedPreceding, 0))).drop("__new")


def segment_summary(df: DataFrame, tolerance: str | int, *, keys: Sequence[str] = ("participant_id", "name"), order: Sequence[str] = (), start: str = "start_date", end: str = "end_date") -> DataFrame:
    """A row per segment: first start, end of the last row, duration_s and n rows."""
    place = F.struct(start, end, *order)
    marked = mark_segments(df, tolerance, keys=keys, order=order, start=start, end=end)
    out = marked.groupBy(*keys, "segment").agg(F.min(start).alias("first_start"), F.max_by(F.col(end), place).alias("last_end"), F.count("*").alias("n"))
    return out.withColumn("duration_s", seconds_between(F.col("first_start"), F.col("last_end")))


def continuous_rows(df: DataFrame, min_duration: str | int, tolerance: str | int, *, keys: Sequence[str] = ("participant_id", "name"), order: Sequence[str] = (), start: str = "start_date", end: str = "end_date") -> DataFrame:
    """Rows of segments that last at least min_duration; no helper column is left.

    The marks and the two ends of a segment come from windows over the same keys, so there is
    one shuffle and no join.
    """
    marked = mark_segments(df, tolerance, keys=keys, order=order, start=start, end=end)
    whole = Window.partitionBy(*keys, "segment").orderBy(start, end, *order).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    span = F.unix_micros(F.last(end).over(whole)) - F.unix_micros(F.first(start).over(whole))
    return marked.withColumn("__span", span).where(F.col("__span") >= micros(min_duration)).drop("__span", "segment")


def total_hours(df: DataFrame, *, start: str = "start_date", end: str = "end_date") -> DataFrame:
    """One row: hours, the accumulated duration cut to whole hours."""
    return df.agg(F.coalesce((F.sum(seconds_between(F.col(start), F.col(end))) / 3600).cast("bigint"), F.lit(0)).alias("hours"))

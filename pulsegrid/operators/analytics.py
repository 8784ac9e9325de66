"""Data behind the charts: filters by period, monthly distributions, feature counts."""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.scalars import clip_upper, month, month_start
from .aggregates import box_stats, fliers


def in_dates(df: DataFrame, date: str, first: str, last: str) -> DataFrame:
    """Rows whose date lies in the period, both ends included."""
    return df.where(F.to_date(date).between(F.lit(first).cast("date"), F.lit(last).cast("date")))


def contained(df: DataFrame, first: str, last: str, start: str = "start_date", end: str = "end_date") -> DataFrame:
    """Events that lie wholly in the period; the last day counts up to its midnight only."""
    return df.where((F.col(start) >= F.lit(first).cast("timestamp")) & (F.col(end) <= F.lit(last).cast("timestamp")))


def daily_sum(df: DataFrame, start: str = "start_date", value: str = "value") -> DataFrame:
    """Sum per date of start; 0 for a day that has only nulls."""
    return df.groupBy(F.to_date(start).alias("date")).agg(F.coalesce(F.sum(value), F.lit(0.0)).alias("value"))


def monthly_values(df: DataFrame, first: str, last: str, *, day_sum: bool = False, limit: float | None = None, start: str = "start_date", end: str = "end_date", value: str = "value") -> DataFrame:
    """(month, value) of events in the period, summed per day if asked, clipped at limit."""
    rows = contained(df, first, last, start, end)
    rows = daily_sum(rows, start, value).withColumnRenamed("date", "__t") if day_sum else rows.select(F.col(start).alias("__t"), F.col(value).alias("value"))
    return rows.select(month(F.col("__t")).alias("month"), clip_upper(F.col("value"), limit).alias("value"))


def duration_hours(daily: DataFrame, first: str, last: str, seconds: str = "seconds", least_top: float = 200.0) -> DataFrame:
    """(date, hours, axis_top) of daily seconds in the period; axis_top is the greatest value shown, least_top at least."""
    days = in_dates(daily, "date", first, last).select("date", (F.col(seconds) / 3600).alias("hours"))
    return days.crossJoin(F.broadcast(days.agg(F.greatest(F.max("hours"), F.lit(least_top)).alias("axis_top"))))  # one row


def month_columns(df: DataFrame, first: str, last: str) -> list[str]:
    """Columns named `YYYY-MM` whose first day lies in the period, in order."""
    named = [c for c in df.columns if re.fullmatch(r"\d{4}-(0[1-9]|1[0-2])", c)]
    return sorted(c for c in named if first <= f"{c}-01" <= last)


def month_matrix_long(df: DataFrame, first: str, last: str, key: str = "participant_id") -> DataFrame:
    """(key, month, month_start, bytes) from a matrix with a column per month, for the months of the period."""
    months = month_columns(df, first, last)
    if not months:
        return df.select(key, F.lit(None).cast("string").alias("month"), F.lit(None).cast("date").alias("month_start"), F.lit(None).cast("bigint").alias("bytes")).limit(0)
    rows = df.select(key, *[F.col(f"`{c}`").cast("bigint").alias(c) for c in months]).unpivot([key], [F.col(f"`{c}`") for c in months], "month", "bytes")
    return rows.select(key, "month", month_start(F.col("month")).alias("month_start"), "bytes")


def month_matrix_totals(df: DataFrame, first: str, last: str, key: str = "participant_id") -> DataFrame:
    """Bytes of all rows per month of the period; 0 for a month of nulls."""
    return month_matrix_long(df, first, last, key).groupBy("month", "month_start").agg(F.coalesce(F.sum("bytes"), F.lit(0)).alias("total"))


def month_fliers(df: DataFrame, first: str, last: str, **how) -> DataFrame:
    """The values of each month that lie beyond its box plot's whiskers."""
    return fliers(monthly_values(df, first, last, **how), ["month"], "value")


def month_box(df: DataFrame, first: str, last: str, **how) -> DataFrame:
    """Box plot numbers per month."""
    return box_stats(monthly_values(df, first, last, **how), ["month"], "value")


def dual_month_box(one: DataFrame, two: DataFrame, first: str, last: str, labels: tuple[str, str], limits: tuple[float | None, float | None] = (None, None), **how) -> DataFrame:
    """Box plot numbers per feature label and month."""
    both = [monthly_values(d, first, last, limit=x, **how).withColumn("feature", F.lit(n)) for d, n, x in zip((one, two), labels, limits, strict=True)]
    return box_stats(both[0].unionByName(both[1]), ["feature", "month"], "value")


def feature_counts(df: DataFrame) -> DataFrame:
    """Features per participant: the row sum of the presence matrix, taken on long data."""
    return df.groupBy("participant_id").agg(F.countDistinct("name").alias("feature_count"))


def row_sum(df: DataFrame, columns: Sequence[str], name: str = "feature_count") -> DataFrame:
    """Sum over the columns of a row, nulls as 0."""
    return df.withColumn(name, F.aggregate(F.array(*[F.coalesce(F.col(c).cast("bigint"), F.lit(0).cast("bigint")) for c in columns]), F.lit(0).cast("bigint"), lambda a, x: a + x))


def top_rows(df: DataFrame, n: int, count: str = "feature_count", order: str = "participant_id") -> DataFrame:
    return df.orderBy(F.desc(count), order).limit(n)


def count_histogram(df: DataFrame, count: str = "feature_count") -> DataFrame:
    """How many rows have each count."""
    return df.groupBy(count).agg(F.count("*").alias("n"))


def keep_top_bins(hist: DataFrame, n: int, count: str = "feature_count") -> DataFrame:
    """Sets all but the n greatest bins to 0. A histogram has a row per feature count, so one task ranks it."""
    place = F.row_number().over(Window.orderBy(F.desc(count)))
    return hist.withColumn("n", F.when(place <= n, F.col("n")).otherwise(F.lit(0)))


def monthly_volume(df: DataFrame, date: str, size: str) -> DataFrame:
    """Bytes per month over all participants."""
    return df.where(F.col(date).isNotNull()).groupBy(month(F.col(date)).alias("month")).agg(F.sum(size).alias("total"))


def year_ticks(months: DataFrame, drop_first: bool = True) -> DataFrame:
    """First month present of each year, the first year left out if asked."""
    years = months.groupBy(F.substring("month", 1, 4).cast("int").alias("year")).agg(F.min("month").alias("first_month"))
    if not drop_first:
        return years
    least = years.agg(F.min("year").alias("__least"))
    return years.crossJoin(F.broadcast(least)).where("year > __least").drop("__least")  # one row

"""Interval events on a fixed time grid."""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..catalog import CUMULATIVE
from ..functions.scalars import micros
from .aggregates import aggregate_values


def grid(start: Column, end: Column, width: str | int = "5min") -> tuple[Column, Column, Column]:
    """(first window's start, last window's end, number of windows) in epoch microseconds.

    The start is rounded down and the end up to the grid; an event on one grid point still covers one
    window. An end before its start by more than a window gives no windows (n = 0).
    """
    w = F.lit(micros(width))
    first = F.unix_micros(start)
    first = first - F.pmod(first, w)
    last = F.unix_micros(end)
    last = last + F.pmod(-last, w)
    last = F.when(last == first, first + w).otherwise(last)
    n = F.greatest(F.lit(0), ((last - first) / w).cast("bigint"))
    return first, last, n


def spread(df: DataFrame, width: str | int = "5min", *, start: str = "start_date", end: str = "end_date", name: str = "name", values: Iterable[str] = ("value",), cumulative: Iterable[str] = CUMULATIVE) -> DataFrame:
    """A row per window that an event covers, start and end replaced by the window's.

    Values of cumulative features are divided by the number of windows; others repeat. Events
    without a start or end give no rows.
    """
    w = micros(width)
    first, last, n = grid(F.col(start), F.col(end), w)
    known = df.where(F.col(start).isNotNull() & F.col(end).isNotNull()).withColumns({"__first": first, "__last": last, "__n": n}).where("__n > 0")
    starts = F.when(F.col("__n") > 0, F.sequence(F.col("__first"), F.col("__last") - w, F.lit(w)))
    shared = {v: F.when(F.col(name).isin(*cumulative), F.col(v) / F.col("__n")).otherwise(F.col(v)) for v in values}
    out = known.withColumns(shared).withColumn("__w", F.explode(starts))
    out = out.withColumns({start: F.timestamp_micros("__w"), end: F.timestamp_micros(F.col("__w") + w)})
    return out.drop("__first", "__last", "__n", "__w")


def window_counts(df: DataFrame, width: str | int = "5min", *, start: str = "start_date", end: str = "end_date") -> DataFrame:
    """Adds n_windows, the number of windows an event covers; null without a start or end."""
    return df.withColumn("n_windows", F.when(F.col(start).isNotNull() & F.col(end).isNotNull(), grid(F.col(start), F.col(end), width)[2]))


def distribute(df: DataFrame, width: str | int = "5min", *, keys: tuple[str, ...] = ("participant_id", "name"), kinds: Mapping[str, str] = {"value": "numeric"}, order: Column | None = None, cumulative: Iterable[str] = CUMULATIVE, start: str = "start_date", end: str = "end_date") -> DataFrame:  # noqa: B006
    """Events spread over the grid and combined per participant, feature and window.

    Contributions of a window are combined by median (numbers), mode (categories) or pointwise median
    (vectors), never added up; other columns keep their first known value by order.
    """
    numbers = [c for c, kind in kinds.items() if kind == "numeric"]
    name = "name" if "name" in keys else keys[-1]
    rows = spread(df, width, start=start, end=end, name=name, values=numbers, cumulative=cumulative)
    return aggregate_values(rows, [*keys, start, end], kinds, F.monotonically_increasing_id() if order is None else order)

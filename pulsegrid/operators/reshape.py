"""Long to wide and back, calendar spines, top-k."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def hourly_matrix(df: DataFrame, ts: str, prefix: str = "h") -> DataFrame:
    """Rows per date and a count for each of the 24 hours, in order, 0 where there is none."""
    hours = [F.count_if(F.hour(ts) == h).alias(f"{prefix}{h:02d}") for h in range(24)]
    return df.where(F.col(ts).isNotNull()).groupBy(F.to_date(ts).alias("date")).agg(*hours)


def wide(df: DataFrame, key: str, name: str, value: Column, names: Sequence[str]) -> DataFrame:
    """A column for each of the named features, in the given order, 0 where it has no row.

    The columns are given, so no extra job looks for them and one shuffle does it.
    """
    return df.groupBy(key).pivot(name, list(names)).agg(value).na.fill(0)


def merge_outer(frames: Sequence[DataFrame], key: str) -> DataFrame:
    """Full outer merge of frames on a key, missing cells 0: a union and one aggregation instead of joins.

    Cells of a column that several frames or rows share are added up.
    """
    columns = sorted({c for f in frames for c in f.columns if c != key})
    rows = frames[0]
    for f in frames[1:]:
        rows = rows.unionByName(f, allowMissingColumns=True)
    return rows.groupBy(key).agg(*[F.coalesce(F.sum(c), F.lit(0)).cast("bigint").alias(c) for c in columns])


def union_all(frames: Sequence[DataFrame]) -> DataFrame:
    """Rows of all frames; columns that one lacks are null there."""
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f, allowMissingColumns=True)
    return out


def long(df: DataFrame, keys: Sequence[str], columns: Sequence[str], name: str = "feature", value: str = "value") -> DataFrame:
    """Columns as rows."""
    return df.unpivot(list(keys), list(columns), name, value)


def monthly_totals(df: DataFrame, date: str, name: str, value: Column) -> DataFrame:
    """Sum per feature and month end; months inside a feature-wide range without rows count 0.

    The spine runs over the months of the whole table, as a resample of a wide frame would.
    """
    sums = df.where(F.col(date).isNotNull()).groupBy(name, F.last_day(date).alias("month_end")).agg(value.alias("total"))
    ends = sums.agg(F.min("month_end").alias("a"), F.max("month_end").alias("b"))
    first = lambda c: F.trunc(c, "month")
    months = ends.where("a is not null").select(F.explode(F.sequence(first("a"), first("b"), F.expr("interval 1 month"))).alias("m")).select(F.last_day("m").alias("month_end"))
    cells = sums.select(name).distinct().crossJoin(F.broadcast(months))  # features times months, both catalog-sized
    return cells.join(sums, [name, "month_end"], "left").withColumn("total", F.coalesce("total", F.lit(0.0)))


def top_names(df: DataFrame, name: str, value: Column, n: int) -> DataFrame:
    """The n names with the greatest totals; ties by name."""
    return df.groupBy(name).agg(value.alias("total")).orderBy(F.desc("total"), name).limit(n)


def ranked(df: DataFrame, *order: Column) -> DataFrame:
    """Adds position from 0. For report-sized inputs: one row per participant or feature."""
    return df.withColumn("position", F.row_number().over(Window.orderBy(*order)) - 1)


def exact_sample(df: DataFrame, n: int, keys: Sequence[str], seed: int = 42) -> DataFrame:
    """Exactly n rows (or all): those with the least digests of seed and keys, so partitions and row order do not matter."""
    digest = F.md5(F.concat_ws("|", F.lit(str(seed)), *[F.col(k).cast("string") for k in keys]))
    return df.orderBy(digest, *keys).limit(n)

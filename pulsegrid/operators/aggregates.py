"""Group aggregates with the tie and null rules of the data."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def numeric(column: str, how: str = "median") -> Column:
    """Median, sum or mean of non-null values; the mean for any other word."""
    value = F.col(column)
    return {"median": F.median, "sum": F.sum}.get(how, F.avg)(value)


def categorical(column: str) -> Column:
    """Most frequent non-null value; the least one among equals."""
    return F.mode(F.col(column), True)


def first_known(column: str, order: Column) -> Column:
    """First non-null value by an explicit order, so it does not depend on how rows arrive."""
    return F.min_by(F.col(column), F.when(F.col(column).isNotNull(), order))


def aggregate_values(df: DataFrame, keys: Sequence[str], kinds: Mapping[str, str], order: Column, how: str = "median") -> DataFrame:
    """One row per key. kinds: numeric, categorical or vector by value column; other columns keep their first known value.

    Vectors (arrays of arrays) take the pointwise median, see pointwise_median.
    """
    vectors = [c for c, kind in kinds.items() if kind == "vector"]
    rest = [c for c in df.columns if c not in {*keys, *kinds}]
    plain = [(categorical(c) if kind == "categorical" else numeric(c, how)).alias(c) for c, kind in kinds.items() if kind != "vector"]
    out = df.groupBy(*keys).agg(*plain, *[first_known(c, order).alias(c) for c in rest]) if plain or rest else df.select(*keys).distinct()
    for c in vectors:
        out = _null_safe_join(out, pointwise_median(df, keys, c), keys)
    return out.select(*[c for c in df.columns if c in out.columns])


def _null_safe_join(left: DataFrame, right: DataFrame, keys: Sequence[str]) -> DataFrame:
    other = right.select(*[F.col(k).alias(f"__{k}") for k in keys], *[c for c in right.columns if c not in keys])
    on = [F.col(k).eqNullSafe(F.col(f"__{k}")) for k in keys]
    return left.join(other, on, "left").drop(*[f"__{k}" for k in keys])


def pointwise_median(df: DataFrame, keys: Sequence[str], column: str) -> DataFrame:
    """Median of ragged lists of lists by position: rows that have a position contribute to it.

    Two explodes and two groupings, all in the JVM; a group's rows never meet in one task at once.
    """
    outer = df.select(*keys, F.posexplode(column).alias("__i", "__inner"))
    inner = outer.select(*keys, "__i", F.posexplode("__inner").alias("__j", "__v"))
    medians = inner.groupBy(*keys, "__i", "__j").agg(F.median("__v").alias("__v"))
    lists = medians.groupBy(*keys, "__i").agg(_in_order("__j", "__v"))
    return lists.groupBy(*keys).agg(_in_order("__i", "__v").alias(column))


def _in_order(position: str, value: str) -> Column:
    pairs = F.array_sort(F.collect_list(F.struct(position, value)))
    return F.transform(pairs, lambda x: x[value]).alias(value)


def dedupe(df: DataFrame, keys: Sequence[str], kinds: Mapping[str, str], order: Column, how: str = "median") -> DataFrame:
    """Rows that share their key (participant, feature, start, end) become one."""
    return aggregate_values(df.dropna(subset=list(keys)), keys, kinds, order, how)


def daily_summary(df: DataFrame, keys: Sequence[str], values: Sequence[str], order: Column) -> DataFrame:
    """Summaries keyed by one time: mean of the values, first known of the rest."""
    return aggregate_values(df.dropna(subset=list(keys)), keys, dict.fromkeys(values, "numeric"), order, "mean")


def duplicate_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys that occur more than once, with their count n."""
    return df.groupBy(*keys).agg(F.count("*").alias("n")).where("n > 1")


def has_duplicates(df: DataFrame, keys: Sequence[str]) -> bool:
    return not duplicate_keys(df, keys).isEmpty()


def _fenced(df: DataFrame, keys: Sequence[str], value: str) -> DataFrame:
    """Rows with a value, the quartiles of their group, and inside: within 1.5 quartile distances of the box."""
    v = F.col(value)
    rows = df.where(v.isNotNull())
    q = rows.groupBy(*keys).agg(F.percentile(v, F.array(*map(F.lit, (0.25, 0.5, 0.75)))).alias("__q"))
    q = q.select(*keys, *[F.col("__q")[k].alias(n) for k, n in enumerate(("q1", "median", "q3"))])
    low, high = F.col("q1") - 1.5 * (F.col("q3") - F.col("q1")), F.col("q3") + 1.5 * (F.col("q3") - F.col("q1"))
    rows = _null_safe_join(rows, q, keys) if keys else rows.crossJoin(F.broadcast(q))  # without keys q is one row
    return rows.withColumn("inside", v.between(low, high))


def box_stats(df: DataFrame, keys: Sequence[str], value: str) -> DataFrame:
    """Box plot numbers: quartiles, whiskers at the last values within 1.5 quartile distances, outliers' count."""
    v = F.col(value)
    return _fenced(df, keys, value).groupBy(*keys, "q1", "median", "q3").agg(
        F.min(F.when(F.col("inside"), v)).alias("whisker_low"),
        F.max(F.when(F.col("inside"), v)).alias("whisker_high"),
        F.count_if(~F.col("inside")).alias("n_outliers"),
        F.count("*").alias("n"),
    )


def fliers(df: DataFrame, keys: Sequence[str], value: str) -> DataFrame:
    """The values a box plot draws one by one: those beyond the whiskers, with the keys of their group."""
    return _fenced(df, keys, value).where(~F.col("inside")).select(*keys, value)

"""Statistics over records: counts, durations, presence, active devices, sizes."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..catalog import NO_TIME_ACCUMULATION
from ..functions.scalars import safe_divide, seconds_between, whole


def daily_counts(df: DataFrame, keys: Sequence[str] = ("participant_id", "name")) -> DataFrame:
    """Records per key and date of collection (datetime, not start_date); rows without date left out."""
    return df.where("datetime is not null").groupBy(*keys, F.to_date("datetime").alias("date")).agg(F.count("*").alias("n"))


def daily_durations(df: DataFrame, keys: Sequence[str] = ("participant_id", "name")) -> DataFrame:
    """Seconds per key and date of collection, cut to whole seconds per key before anything is summed over keys."""
    seconds = F.coalesce(F.sum(seconds_between(F.col("start_date"), F.col("end_date"))), F.lit(0.0))
    return df.where("datetime is not null").groupBy(*keys, F.to_date("datetime").alias("date")).agg(whole(seconds).alias("seconds"))


def time_accumulated(df: DataFrame, skip: Iterable[str] = NO_TIME_ACCUMULATION) -> DataFrame:
    """Records whose time is added up; the skipped features still count for presence and active dates."""
    return df.where(~F.col("name").isin(*skip))


def sum_over_participants(df: DataFrame, values: Sequence[str], keys: Sequence[str] = ("name", "date")) -> DataFrame:
    return df.groupBy(*keys).agg(*[F.sum(v).cast("bigint").alias(v) for v in values])


def active_devices(df: DataFrame) -> DataFrame:
    """Distinct participants per date of collection."""
    return df.where("datetime is not null").groupBy(F.to_date("datetime").alias("date")).agg(F.countDistinct("participant_id").alias("active_devices"))


def presence(df: DataFrame) -> DataFrame:
    """Distinct (participant_id, name) pairs."""
    return df.select("participant_id", "name").distinct()


def feature_summary(df: DataFrame) -> DataFrame:
    """Participants per feature."""
    return df.groupBy(F.col("name").alias("feature")).agg(F.countDistinct("participant_id").alias("count"))


def presence_matrix(df: DataFrame, features: Sequence[str]) -> DataFrame:
    """A row per participant, 0 or 1 per feature, columns in the given order."""
    return df.groupBy("participant_id").agg(*[F.max((F.col("name") == f).cast("bigint")).alias(f) for f in features])


def coverage(df: DataFrame, height: str = "Height", weight: str = "Weight", bmi: str = "BMI") -> DataFrame:
    """One row: participants with height and weight, with BMI, with all three."""
    has = df.groupBy("participant_id").agg(*[F.max(F.col("name") == n).alias(c) for n, c in ((height, "h"), (weight, "w"), (bmi, "b"))])
    return has.agg(F.count_if(F.expr("h and w")).alias("height_weight"), F.count_if("b").alias("bmi"), F.count_if(F.expr("h and w and b")).alias("all_three"))


def activity_totals(durations: DataFrame) -> DataFrame:
    """Seconds per feature and hours rounded half to even."""
    return durations.groupBy("name").agg(F.sum("seconds").alias("seconds")).withColumn("hours", F.bround(F.col("seconds") / 3600).cast("bigint"))


def in_order(report: DataFrame, name: str) -> DataFrame:
    """A report's rows as it is read: sizes and feature counts descending, everything by date ascending; ties by name."""
    first = {"folder_sizes": [F.desc("folder_size_bytes"), "participant_id"], "features_summary": [F.desc("count"), "feature"]}
    return report.orderBy(*first.get(name, [c for c in ("date", "participant_id", "name") if c in report.columns] or report.columns))


def ascending_counts(summary: DataFrame) -> DataFrame:
    """Features by rising count, as a bar chart stacks them; ties by name. position counts from 0."""
    return summary.withColumn("position", F.row_number().over(Window.orderBy("count", "feature")) - 1)  # a row per feature


def percent_lines(classes: DataFrame) -> DataFrame:
    """Classes as printed: `class: n users (p%)` with one decimal, and a last line with both sums, the percentage cut off."""
    line = F.concat_ws("", "class", F.lit(": "), F.col("n").cast("string"), F.lit(" users ("), F.format_string("%.1f", "pct"), F.lit("%)"))
    total = classes.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n"), F.coalesce(F.sum("pct"), F.lit(0.0)).alias("pct"))
    last = total.select(F.lit("Total").alias("class"), F.concat_ws("", F.lit("Total: "), F.col("n").cast("string"), F.lit(" users ("), F.round("pct", 6).cast("int").cast("string"), F.lit("%)")).alias("line"))
    return classes.select("class", line.alias("line")).unionByName(last)


def participants_saved(df: DataFrame) -> DataFrame:
    return df.agg(F.countDistinct("participant_id").alias("participants"))


def folder_sizes(files: DataFrame, key: str, size: str) -> DataFrame:
    """Bytes per folder."""
    return files.groupBy(key).agg(F.sum(size).cast("bigint").alias("folder_size_bytes"))


def size_bins(df: DataFrame, size: str, thresholds: Sequence[float] = (1e6, 10e6, 100e6, 500e6)) -> DataFrame:
    """Share of rows per size class in percent, and cumulative; a size at a threshold is in the class below it."""
    known = F.col(size).isNotNull()
    cumulative = [F.coalesce(F.avg(F.when(known, F.when(F.col(size) <= t, 100.0).otherwise(0.0))), F.lit(0.0)) for t in thresholds]
    one = df.agg(*[c.alias(f"c{k}") for k, c in enumerate(cumulative)])
    n = len(thresholds)
    cells = [F.struct(F.lit(k).alias("bin"), (F.col(f"c{k}") if k < n else F.lit(100.0)).alias("cumulative_pct"), ((F.col(f"c{k}") if k < n else F.lit(100.0)) - (F.col(f"c{k - 1}") if k else F.lit(0.0))).alias("pct")) for k in range(n + 1)]
    return one.select(F.inline(F.array(*cells)))


def histogram(df: DataFrame, value: str, bins: int = 100) -> DataFrame:
    """Equal-width counts; the greatest value is in the last bin. Empty bins have no row."""
    v = F.col(value).cast("double")
    ends = df.agg(F.min(v).alias("__lo"), F.max(v).alias("__hi"))
    at = F.when(F.col("__lo") == F.col("__hi"), F.lit(1)).otherwise(F.least(F.width_bucket(v, F.col("__lo"), F.col("__hi"), F.lit(bins)), F.lit(bins)))
    return df.where(v.isNotNull()).crossJoin(F.broadcast(ends)).groupBy(at.cast("int").alias("bin")).agg(F.count("*").alias("n"))  # ends is one row


def kernel_density(df: DataFrame, value: str, points: int = 50) -> DataFrame:
    """Gaussian kernel density with Scott's bandwidth on an even grid of points over the values' range.

    Values are first counted, so work is distinct values times points; partial sums keep the
    shuffle at one row per point and task.
    """
    v = F.col(value).cast("double")
    counts = df.where(v.isNotNull()).groupBy(v.alias("__v")).agg(F.count("*").alias("__n"))
    ends = df.agg(F.min(v).alias("lo"), F.max(v).alias("hi"), F.stddev_samp(v).alias("sd"), F.count(v).alias("n"))
    step = (F.col("hi") - F.col("lo")) / (points - 1)
    axis = ends.where("n > 1 and sd > 0").select(F.explode(F.sequence(F.lit(0), F.lit(points - 1))).alias("k"), "lo", step.alias("step"), (F.col("sd") * F.pow("n", F.lit(-0.2))).alias("h"), "n")
    axis = axis.select("k", (F.col("lo") + F.col("k") * F.col("step")).alias("x"), "h", "n")
    z = (F.col("x") - F.col("__v")) / F.col("h")
    pairs = counts.crossJoin(F.broadcast(axis))  # axis has `points` rows
    return pairs.groupBy("k", "x").agg((F.sum(F.col("__n") * F.exp(-z * z / 2) / (F.col("h") * F.sqrt(F.lit(2) * F.pi()) * F.col("n")))).alias("density"))


def normalise_by_active(daily: DataFrame, active: DataFrame, values: Sequence[str]) -> DataFrame:
    """Values per active device of the date; 0 where none is known or active."""
    joined = daily.join(active.select("date", "active_devices"), "date", "left")
    return joined.select(*[c for c in daily.columns if c not in values], *[safe_divide(F.col(v), F.col("active_devices")).alias(v) for v in values])


def bmi_classes(df: DataFrame, value: str = "value", cuts: tuple[float, float] = (25.0, 30.0)) -> DataFrame:
    """Participants per class of their median value (below, from, at or above the cuts) and the share in percent."""
    m = F.col("median")
    users = df.groupBy("participant_id").agg(F.median(value).alias("median")).where("median is not null")
    label = F.when(m < cuts[0], "Normal").when(m < cuts[1], "Overweight").otherwise("Obese")
    counts = users.groupBy(label.alias("class")).agg(F.count("*").alias("n"))
    total = counts.agg(F.sum("n").alias("__all"))
    return counts.crossJoin(F.broadcast(total)).select("class", "n", (F.col("n") * 100.0 / F.col("__all")).alias("pct"))  # one row

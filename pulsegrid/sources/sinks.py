"""Writes feature tables, series, logs and reports."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.scalars import safe_name


#: Participants are dealt into so many buckets of the feature table; a bucket is what a run that adds files rewrites.
BUCKETS = 64


def bucket_of(participant: str = "participant_id") -> Column:
    return F.pmod(F.xxhash64(participant), F.lit(BUCKETS)).cast("int")


def write_features(df: DataFrame, path: str, tasks: int = 1) -> None:
    """Feature table as Parquet partitioned by participant bucket and feature; only the partitions that df has are replaced.

    tasks is how many may share a bucket of a feature; callers let it grow with their input.
    """
    named = df.withColumn("bucket", bucket_of()).withColumn("feature", safe_name(F.col("name")))
    dealt = named.repartition("bucket", "feature", F.pmod(F.xxhash64(F.lit("task"), "participant_id", F.to_date("start_date")), F.lit(max(1, tasks))))
    dealt.sortWithinPartitions("bucket", "feature", "participant_id", "start_date", "datetime").write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("bucket", "feature").parquet(path)
    df.sparkSession.catalog.refreshByPath(path)


def read_feature(spark: SparkSession, path: str, name: str) -> DataFrame:
    """One feature; partition pruning reads its files only. No rows if the table lacks it."""
    return spark.read.parquet(path).where(F.col("feature") == safe_name(F.lit(name)))


def write_csv(df: DataFrame, path: str) -> None:
    """One CSV file with a header, rows in the order df has them; for reports of a row per date, feature or participant."""
    df.coalesce(1).write.mode("overwrite").option("header", True).option("timestampFormat", "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX").csv(path)


def write_by_participant(df: DataFrame, path: str) -> None:
    """A folder of CSV per participant, by date; written by as many tasks as the session has, none of which gets all."""
    df.repartition("participant_id").sortWithinPartitions("participant_id", "date").write.mode("overwrite").option("header", True).partitionBy("participant_id").csv(path)


def write_series(df: DataFrame, path: str) -> None:
    """Rows of continuous segments, partitioned by feature; earlier output of these features is replaced."""
    df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("name").parquet(path)


def write_log(files: DataFrame, path: str) -> None:
    """Sorted names of processed files, in as many parts as sorting makes."""
    files.select("filename").distinct().orderBy("filename").write.mode("overwrite").option("header", True).csv(path)


def read_log(spark: SparkSession, path: str) -> DataFrame:
    """Names in a log, nulls left out."""
    return spark.read.option("header", True).schema("filename string").csv(path).where("filename is not null")

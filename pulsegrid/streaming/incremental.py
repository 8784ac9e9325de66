"""Incremental windowing: new record files re-aggregate the window keys they touch."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.query import StreamingQuery

from ..operators.windows import spread

RECORDS = "participant_id long, name string, start_date timestamp, end_date timestamp, value double, ord long"
_KEYS = ["participant_id", "name", "start_date", "end_date"]


def contributions(records: DataFrame, width: str, cumulative: tuple[str, ...]) -> DataFrame:
    """Un-aggregated shares per window with the day of the window, which the store is partitioned by."""
    return spread(records, width, cumulative=cumulative).withColumn("day", F.to_date("start_date"))


def store_batch(batch: DataFrame, batch_id: int, path: str) -> None:
    """Keeps a batch's shares under its own number, so a batch that runs twice overwrites itself."""
    batch.withColumn("batch", F.lit(batch_id)).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("batch", "day").parquet(path)


def combined(spark: SparkSession, path: str) -> DataFrame:
    """Median per window over all shares so far: what one run over all files gives, late rows included."""
    return spark.read.parquet(path).groupBy(*_KEYS).agg(F.median("value").alias("value"), F.count("*").alias("n"))


def start(spark: SparkSession, source: str, store: str, checkpoint: str, *, width: str = "5min", cumulative: tuple[str, ...] = ()) -> StreamingQuery:
    """Follows a folder of record files; each is read once and its shares are stored.

    No state is kept between batches, so late rows need no watermark: they join their window when it is read.
    """
    stream = spark.readStream.schema(RECORDS).parquet(source)
    shares = contributions(stream, width, cumulative)
    return shares.writeStream.foreachBatch(lambda df, k: store_batch(df, k, store)).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()

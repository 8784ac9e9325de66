"""Shared helpers of the training-data operators: inputs, row keys, checkpoints."""

from __future__ import annotations

import tempfile
from uuid import uuid4

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the given Parquet tables, by any path that Spark can read."""
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def id_and_text(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", carry: tuple[str, ...] = ()) -> DataFrame:
    """Only the two columns an operator needs, so other columns cannot clash with its own.

    Columns to carry along travel in one struct, carried.
    """
    carried = [F.struct(*[F.col(f"`{c}`") for c in carry]).alias("carried")] if carry else []
    return docs.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"), F.col(f"`{text_col}`").cast("string").alias("text"), *carried)


def with_carried(ddl: str, rows: DataFrame) -> StructType:
    """Schema of a function over Arrow batches that hands the struct carried on, if rows have it."""
    schema = StructType.fromDDL(ddl)
    return schema.add(rows.schema["carried"]) if "carried" in rows.columns else schema


def held_out(doc_id: Column) -> Column:
    """Rows no model may learn from: crc32 of the id written as text, modulo 4, is 2."""
    return F.coalesce(F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % 4 == 2, F.lit(False))


def shared_folder(spark: SparkSession) -> str:
    """The folder that spark.checkpoint.dir names. Where the session names none, one of this machine if it is the only
    one, as in tests; on a cluster executors could not read each other's files there, so that raises."""
    context = spark.sparkContext
    if context._jsc.sc().getCheckpointDir().isEmpty():
        named = context.getConf().get("spark.checkpoint.dir")
        if not named and not context._jsc.sc().isLocal():
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        context.setCheckpointDir(named or tempfile.mkdtemp(prefix="pulsegrid-checkpoint-"))
    return context._jsc.sc().getCheckpointDir().get()


def cut_lineage(df: DataFrame) -> DataFrame:
    """Reliable checkpoint in the shared folder."""
    shared_folder(df.sparkSession)
    return df.checkpoint(eager=True)


def written(df: DataFrame) -> DataFrame:
    """A table written in the shared folder and read again; it stays there for the application's later reads."""
    path = f"{shared_folder(df.sparkSession)}/{uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.parquet(path)


#: Plans of these alone give the same rows in the same order whenever they run again.
_STEADY = {"Project", "Filter", "SubqueryAlias", "Relation", "LogicalRelation", "LogicalRDD", "LocalRelation", "View"}


def steady(df: DataFrame) -> DataFrame:
    """df itself where a task run again is sure to see the same rows in the same order, else a checkpoint of it.

    Operators that answer to blocks of rows rely on it: a shuffle may hand a retried task its rows in another order.
    """

    def same(plan) -> bool:
        children = plan.children()
        return plan.nodeName().split(" ")[0] in _STEADY and all(same(children.apply(k)) for k in range(children.size()))

    return df if same(df._jdf.queryExecution().analyzed()) else cut_lineage(df)


def dealt(df: DataFrame, key: str, tasks: int):
    """df grouped by key in so many tasks: a number that grows with the input, which the session's default does not."""
    return df.repartition(tasks, key).groupBy(key)


def default_tasks(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def blocks_for(amount: float, per_block: float, least: int = 1) -> int:
    """Number of blocks that keeps each at about per_block; grows in proportion to the input."""
    return max(least, int(-(-amount // per_block)) if amount else least)


def frequent_from(counts: DataFrame, limit: int) -> int:
    """The least n that at most limit rows of counts (n, ...) reach.

    Different values of n are fewer than the square root of twice the sum of n; only they reach the driver.
    """
    return least_count(counts.groupBy("n").count().collect(), limit)


def least_count(sizes: list[tuple[int, int]], limit: int) -> int:
    """The same from pairs (n, rows that have it)."""
    seen = 0
    for n, rows in sorted(sizes, reverse=True):
        seen += rows
        if seen > limit:
            return n + 1
    return 1

"""The three runs end to end: parse and window, statistics, continuous series."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StringType, StructField, StructType

from ..catalog import CUMULATIVE, DAILY_SUMMARY, VALUE_COLUMNS
from ..operators import reshape, statistics
from ..operators.aggregates import daily_summary, dedupe
from ..operators.segments import continuous_rows, total_hours
from ..operators.windows import spread
from ..session import scratch
from ..sources import export, sinks

_NUMBERS = [c for family, columns in VALUE_COLUMNS.items() if family != "daily_summary" for c in columns if c != "voltage_measurements"]
_KINDS = dict.fromkeys(_NUMBERS, "numeric") | {"category": "categorical", "voltage_measurements": "vector"}
_PLACE = ("file", "row_idx", "pos")


def windowed(records: DataFrame, width: str | None = "5min") -> DataFrame:
    """Deduplicated records on the time grid; daily summaries keep their one time and are averaged.

    Everything is recomputed from un-aggregated records, so adding files gives the same result as one run over all.
    """
    summary = records.where(F.col("name") == DAILY_SUMMARY)
    summary = daily_summary(summary.drop("start_date", "end_date"), ["participant_id", "name", "datetime"], VALUE_COLUMNS["daily_summary"], F.struct(*_PLACE))
    events = dedupe(records.where(F.col("name") != DAILY_SUMMARY), ["participant_id", "name", "file", "row_idx", "start_date", "end_date"], _KINDS, F.col("pos"))
    if width:
        rows = spread(events, width, values=_NUMBERS, cumulative=CUMULATIVE)
        events = dedupe(rows, ["participant_id", "name", "start_date", "end_date"], _KINDS, F.struct(*_PLACE))
    return events.unionByName(summary, allowMissingColumns=True)


REJECTS = "file string, row_idx long, reason string"
#: Bytes of input for which one more task shares a bucket of a feature.
_BYTES_PER_TASK = 16 << 30


def run_etl(spark: SparkSession, source: str, target: str, *, width: str | None = "5min", resume: bool = True) -> dict[str, int]:
    """Reads an export tree, writes the feature table, the log of files and the rejects.

    With resume, participants that have new files are recomputed from all their files and replace their rows; only the
    buckets that hold one are written, all at once when the job commits, and the log comes last, so a run that breaks off is
    made good by the next. A tree without any usable row leaves an empty table. Files are parsed twice, for the checks
    and for the records.
    """
    there = export.folder_files(spark, source).withColumn("filename", F.concat_ws("/", "participant_id", "file"))
    tree = export.read_tree(spark, source)
    known = None
    if resume and _exists(spark, f"{target}/log") and _exists(spark, f"{target}/features"):
        known = sinks.read_log(spark, f"{target}/log")
        there = there.join(there.join(known, "filename", "left_anti").select("participant_id").distinct(), "participant_id", "left_semi")
        tree = tree.join(there.select(F.col("participant_id").alias("participant_dir")).distinct(), "participant_dir", "left_semi")
    scratch_path = scratch(spark)
    export.checked(tree).write.parquet(scratch_path)
    checked = spark.read.parquet(scratch_path)
    lost = there.where("length > 0").join(checked.select(F.col("file").alias("path")).distinct(), "path", "left_anti")
    rejects = checked.where("reason is not null").unionByName(lost.select(F.col("path").alias("file"), F.lit(None).cast("long").alias("row_idx"), F.lit("unreadable").alias("reason")))
    records = export.parse_records(export.data_rows(tree))
    out = windowed(records, width)
    schema = StructType([*out.schema.fields, StructField("bucket", IntegerType()), StructField("feature", StringType())])
    if known is not None:
        fresh = records.select("participant_id").distinct()
        touched = [r.bucket for r in fresh.select(sinks.bucket_of().alias("bucket")).distinct().collect()]  # at most BUCKETS
        stored = spark.read.schema(schema).parquet(f"{target}/features").where(F.col("bucket").isin(touched)).drop("bucket", "feature")
        out = out.unionByName(stored.join(fresh, "participant_id", "left_anti"), allowMissingColumns=True)
    sinks.write_features(out, f"{target}/features", 1 + (there.agg(F.sum("length")).first()[0] or 0) // _BYTES_PER_TASK)
    rejects.write.mode("overwrite").parquet(f"{target}/rejects")
    names = there.join(lost.select("path"), "path", "left_anti").select("filename")
    if known is not None:
        sinks.write_log(names.unionByName(known), f"{scratch_path}-log")
        names = sinks.read_log(spark, f"{scratch_path}-log")
    sinks.write_log(names, f"{target}/log")
    saved = spark.read.schema(schema).parquet(f"{target}/features")
    return {"participants": statistics.participants_saved(saved).first()[0], "rejects": spark.read.schema(REJECTS).parquet(f"{target}/rejects").count()}


def _exists(spark: SparkSession, path: str) -> bool:
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(at)


def run_statistics(features: DataFrame, files: DataFrame | None = None) -> dict[str, DataFrame]:
    """All reports over a feature table as long DataFrames; folder sizes too if files (participant_id, length) are given."""
    timed = statistics.time_accumulated(features).where("start_date is not null")
    counts, durations = statistics.daily_counts(timed), statistics.daily_durations(timed)
    sizes = {"folder_sizes": statistics.folder_sizes(files, "participant_id", "length")} if files is not None else {}
    return sizes | {
        "counts_by_participant": counts,
        "durations_by_participant": durations,
        "activity_counts": statistics.sum_over_participants(counts, ["n"]),
        "activity_durations": statistics.sum_over_participants(durations, ["seconds"]),
        "activity_totals": statistics.activity_totals(durations),
        "all_hourly_data": reshape.hourly_matrix(timed, "start_date", prefix=""),
        "features_summary": statistics.feature_summary(features),
        "features_by_id": statistics.presence(features),
        "active_devices": statistics.active_devices(features),
        "coverage": statistics.coverage(features),
    }


def report_forms(reports: dict[str, DataFrame]) -> dict[str, DataFrame]:
    """The reports as their readers expect them: a column per feature, 0 where there is none, rows in order.

    Features come in the order of the feature summary, which has a row per feature and is collected.
    """
    names = [r.feature for r in statistics.in_order(reports["features_summary"], "features_summary").collect()]
    out = {}
    for name, report in reports.items():
        if name in ("counts_by_participant", "durations_by_participant"):
            keyed = report.withColumn("key", F.struct("participant_id", "date"))
            wide = reshape.wide(keyed, "key", "name", F.sum(report.columns[-1]), names).select("key.participant_id", "key.date", *[F.col(f"`{n}`") for n in names])
        elif name in ("activity_counts", "activity_durations"):
            wide = reshape.wide(report, "date", "name", F.sum(report.columns[-1]), names)
        else:
            wide = statistics.presence_matrix(report, names) if name == "features_by_id" else report
        out[name] = wide if name.endswith("_by_participant") else statistics.in_order(wide, name)
    return out


def write_statistics(reports: dict[str, DataFrame], target: str) -> None:
    """Each report as CSV with a header; those by participant in a folder for each."""
    for name, report in (report_forms(reports) if "features_summary" in reports else reports).items():
        (sinks.write_by_participant if name.endswith("_by_participant") else sinks.write_csv)(report, f"{target}/logfile_{name}")


def run_series(features: DataFrame, names: list[str], target: str, *, min_duration: str = "60min", tolerance: str = "1min") -> int:
    """Continuous rows of the named features, written by feature; returns accumulated whole hours."""
    rows = continuous_rows(features.where(F.col("name").isin(*names)), min_duration, tolerance)
    sinks.write_series(rows, target)
    saved = features.sparkSession.read.schema(rows.schema).parquet(target)
    return total_hours(saved.where(F.col("name").isin(*names))).first()[0]

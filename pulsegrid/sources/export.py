"""Reads export trees <parent>/<participant>/*.csv into records, and keeps what it rejects."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..catalog import DAILY_SUMMARY, IGNORED, SOURCE
from ..functions.literals import literal_records
from ..functions.scalars import fixed_timestamp, lenient_timestamp, normal_source, parent, stem, strict_timestamp

RAW = "name string, data string, data_source string, participant_id string, datetime string, created_at string, updated_at string"
#: Keys of records with columns of their own; further keys stay in `extras` as a map of JSON texts.
NUMBERS = ("value", "blood_pressure_systolic_value", "blood_pressure_diastolic_value", "average_heart_rate", "sampling_frequency", "apple_stand_hours", "apple_exercise_time", "active_energy_burned", "apple_stand_hours_goal", "apple_exercise_time_goal", "active_energy_burned_goal")


#: Columns a file may have; a file with more is rejected.
MAX_COLUMNS = 200
_FILES = {"recursiveFileLookup": True, "pathGlobFilter": "*.csv"}
_NAMES = [f.strip().split(" ")[0] for f in RAW.split(",")]
_ROWS = f"{RAW}, file string, participant_dir string, row_idx long, problem string"


def _by_name(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Columns by each file's own header. A file is read by one task from its first row on, which is the header."""
    names = [*_NAMES, "file", "participant_dir", "row_idx", "problem"]
    kinds = [pa.string()] * (len(_NAMES) + 2) + [pa.int64(), pa.string()]
    file, header, line = None, {}, 0
    for batch in batches:
        lists: dict[int, list] = {}
        rows: list[tuple] = []
        for k, path in enumerate(batch["file"].to_pylist()):
            if path != file:
                file, line = path, 0
                cells = [batch.column(c)[k].as_py() for c in range(MAX_COLUMNS + 1)]
                header = {cells[c].lstrip("\ufeff"): c for c in reversed(range(len(cells))) if cells[c] is not None}
                problem = f"more than {MAX_COLUMNS} columns" if cells[-1] is not None else None if "data_source" in header else "no column data_source"
                header = {n: c for n, c in header.items() if n in _NAMES} if problem is None else None
                rows.append((*[None] * len(_NAMES), path, path.split("/")[-2], 0, problem))
                for c in (header or {}).values():
                    lists.setdefault(c, batch.column(c).to_pylist())
                continue
            line += 1
            if header is not None:
                for c in header.values():
                    if c not in lists:
                        lists[c] = batch.column(c).to_pylist()
                rows.append((*[lists[header[n]][k] if n in header else None for n in _NAMES], path, path.split("/")[-2], line, None))
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True) if rows else [()] * len(names), kinds, strict=True)], names)


def read_tree(spark: SparkSession, path: str) -> DataFrame:
    """Raw rows of all participants with file, participant_dir and row place from 1, and for each file a row 0 that
    says by its problem why the file could not be used, if so; log files are left out.

    Files may have any columns in any order: each is read once, by one task, which takes the wanted columns by name;
    missing ones are null.
    """
    names = [f"c{k}" for k in range(MAX_COLUMNS + 1)]  # the last one only shows that a header is too long
    schema = ", ".join(f"{n} string" for n in names)
    rows = spark.read.options(multiLine=True, escape='"', ignoreCorruptFiles=True, **_FILES).schema(schema).csv(path)
    rows = rows.select(*names, F.col("_metadata.file_path").alias("file")).where(~F.regexp_extract("file", r"([^/]+)$", 1).startswith("logfile"))
    return rows.mapInArrow(_by_name, _ROWS)


def read_raw(spark: SparkSession, path: str) -> DataFrame:
    """The raw rows of a tree."""
    return data_rows(read_tree(spark, path))


def data_rows(tree: DataFrame) -> DataFrame:
    return tree.where("row_idx > 0").drop("problem")


def _wanted() -> Column:
    return (normal_source(F.col("data_source")) == SOURCE) & ~F.coalesce(F.col("name").isin(*IGNORED), F.lit(False))


def checked(tree: DataFrame) -> DataFrame:
    """(file, row_idx, reason): row 0 of every file, with a reason if it could not be used, and the rows that no record can
    be read from."""
    literal = literal_records(F.when(_wanted(), F.col("data")))
    reason = F.when(F.col("row_idx") == 0, F.col("problem")).when(_wanted() & literal.isNull(), F.when(F.col("data").isNull(), "no data").otherwise("not a literal of records"))
    return tree.select("file", "row_idx", reason.alias("reason")).where("row_idx = 0 or reason is not null")


def parse_records(raw: DataFrame) -> DataFrame:
    """One row per record of a literal; rows that checked names have none.

    A row's own datetime replaces a record's, as null if it does not parse. Daily summaries write their own in one
    fixed form. Times that do not parse are null, and records without their key time are left out later by deduplication.
    """
    parsed = raw.where(_wanted()).withColumn("__records", literal_records(F.col("data")))
    each = parsed.select("*", F.posexplode("__records").alias("pos", "__r"))
    get = lambda key: F.element_at("__r", F.lit(key))
    known = ("start_date", "end_date", "datetime", "voltage_measurements", *NUMBERS)
    numbers = [get(k).try_cast("double").alias(k) for k in NUMBERS]
    return each.select(
        F.coalesce("participant_id", "participant_dir").alias("participant_id"),
        "name",
        strict_timestamp(get("start_date")).alias("start_date"),
        strict_timestamp(get("end_date")).alias("end_date"),
        F.when(F.col("datetime").isNotNull(), lenient_timestamp(F.col("datetime"))).when(F.col("name") == DAILY_SUMMARY, fixed_timestamp(get("datetime"))).otherwise(lenient_timestamp(get("datetime"))).alias("datetime"),
        lenient_timestamp(F.col("created_at")).alias("created_at"),
        lenient_timestamp(F.col("updated_at")).alias("updated_at"),
        *numbers,
        F.when(get("value").try_cast("double").isNull(), get("value")).alias("category"),
        F.from_json(get("voltage_measurements"), "array<array<double>>").alias("voltage_measurements"),
        F.map_filter("__r", lambda k, _: ~k.isin(*known, "id", "metadata", "source_id", "source_name")).alias("extras"),
        "data_source",
        "file",
        "row_idx",
        "pos",
    )


def folder_files(spark: SparkSession, path: str, logs: bool = False) -> DataFrame:
    """(participant_id, path, file, length) of all CSV files, their contents unread; log files only if asked."""
    files = spark.read.format("binaryFile").options(**_FILES).load(path)
    out = files.select(parent(F.col("path")).alias("participant_id"), "path", stem(F.col("path")).alias("file"), "length")
    return out if logs else out.where(~F.array_contains(F.split("file", "_"), "logfile"))

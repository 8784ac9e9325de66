from __future__ import annotations

import csv
from datetime import datetime, timedelta, timezone

from pyspark.sql import functions as F

from pulsegrid.plans import pipelines
from pulsegrid.sources import export, sinks
from pulsegrid.streaming import incremental


def literal(*records) -> str:
    return f"'{list(records)!r}'"


def record(start: str, end: str, value, **more) -> dict:
    return {"id": 1, "start_date": f"2024-01-01T{start}:00.000+0000", "end_date": f"2024-01-01T{end}:00.000+0000", "value": value} | more


def write(path, rows, columns=("name", "data", "data_source", "participant_id", "datetime")) -> None:
    path.parent.mkdir(parents=True, exist_ok=True)
    with path.open("w", newline="") as f:
        out = csv.writer(f)
        out.writerow(columns)
        out.writerows(rows)


def tree(tmp_path):
    write(tmp_path / "in/101/jan.csv", [("StepCount", literal(record("10:03", "10:12", 90), record("10:00", "10:05", 10, note="x")), "AppleHealthkit ", "101", "2024-01-01"), ("HeartRate", literal(record("10:00", "10:05", 70)), "other", "101", "2024-01-01"), ("Mindful", literal(record("10:00", "10:05", 1)), "applehealthkit", "101", "2024-01-01"), ("StepCount", "'nonsense'", "applehealthkit", "101", "2024-01-01")])
    write(tmp_path / "in/102/jan.csv", [(literal({"apple_stand_hours": 4.0}, {"apple_stand_hours": 6.0}), "ActivitySummary", "applehealthkit", "102", "2024-01-02")], ("data", "name", "data_source", "participant_id", "datetime"))
    write(tmp_path / "in/102/logfile_x.csv", [("StepCount",)], ("name",))
    return str(tmp_path / "in"), str(tmp_path / "out")


def test_etl(spark, tmp_path):
    source, target = tree(tmp_path)
    assert pipelines.run_etl(spark, source, target) == {"participants": 2, "rejects": 1}
    steps = sinks.read_feature(spark, f"{target}/features", "StepCount").orderBy("start_date").collect()
    assert [r.value for r in steps] == [20.0, 30.0, 30.0]
    assert sinks.read_feature(spark, f"{target}/features", "ActivitySummary").first().apple_stand_hours == 5.0
    assert sorted(r.filename for r in sinks.read_log(spark, f"{target}/log").collect()) == ["101/jan", "102/jan"]


def test_etl_resumes(spark, tmp_path):
    source, target = tree(tmp_path)
    pipelines.run_etl(spark, source, target)
    write(tmp_path / "in/101/feb.csv", [("StepCount", literal(record("10:00", "10:05", 50)), "applehealthkit", "101", "2024-01-01")])
    pipelines.run_etl(spark, source, target)
    steps = sinks.read_feature(spark, f"{target}/features", "StepCount").orderBy("start_date").collect()
    assert [r.value for r in steps] == [30.0, 30.0, 30.0]  # the median of 30, 10 and 50, not of 20 and 50
    assert sinks.read_feature(spark, f"{target}/features", "ActivitySummary").count() == 1


def test_etl_of_a_tree_without_usable_rows(spark, tmp_path):
    write(tmp_path / "in/7/a.csv", [("StepCount", "'nonsense'", "applehealthkit", "7", "2024-01-01")])
    write(tmp_path / "in/7/b.csv", [("StepCount", "'[]'")], ("name", "data"))
    source, target = str(tmp_path / "in"), str(tmp_path / "out")
    assert pipelines.run_etl(spark, source, target) == {"participants": 0, "rejects": 2}
    reasons = {r.reason for r in spark.read.parquet(f"{target}/rejects").collect()}
    assert reasons == {"not a literal of records", "no column data_source"}
    write(tmp_path / "in/8/c.csv", [("StepCount", literal(record("10:00", "10:05", 50)), "applehealthkit", "8", "2024-01-01")])
    assert pipelines.run_etl(spark, source, target)["participants"] == 1


def test_a_row_replaces_the_time_of_its_records(spark, tmp_path):
    """Also when its own does not parse. Summaries write their time in one form."""
    own = record("10:00", "10:05", 1, datetime="2024-02-02 00:00:00")
    rows = [("HeartRate", literal(own), "applehealthkit", "1", x) for x in ("2024-01-01", "not a time", "")]
    summary = [("ActivitySummary", literal({"apple_stand_hours": 1.0, "datetime": x}), "applehealthkit", "1", "") for x in ("2024-02-02 10:00:00", "2024-02-02T10:00:00Z")]
    write(tmp_path / "in/1/a.csv", rows + summary)
    out = export.parse_records(export.read_raw(spark, str(tmp_path / "in"))).orderBy("row_idx").collect()
    assert [r.datetime and r.datetime.strftime("%m-%d %H") for r in out] == ["01-01 00", None, "02-02 00", "02-02 10", None]


def test_files_with_any_header_are_read_once_by_name(spark, tmp_path):
    for k in range(120):  # as many different headers
        write(tmp_path / f"in/{k % 5}/f{k}.csv", [(f"x{k}", "HeartRate", literal(record("10:00", "10:05", k)), "applehealthkit", str(k % 5))], (f"extra{k}", "name", "data", "data_source", "participant_id"))
    write(tmp_path / "in/9/wide.csv", [["1"] * 250], [f"c{k}" for k in range(250)])
    tree = export.read_tree(spark, str(tmp_path / "in"))
    assert sorted(r.value for r in export.parse_records(export.data_rows(tree)).collect()) == [float(k) for k in range(120)]
    assert [r.reason for r in export.checked(tree).where("reason is not null").collect()] == ["more than 200 columns"]


def test_statistics_and_series(spark, tmp_path):
    source, target = tree(tmp_path)
    pipelines.run_etl(spark, source, target)
    features = spark.read.parquet(f"{target}/features")
    reports = pipelines.run_statistics(features, export.folder_files(spark, source, logs=True))
    assert reports["active_devices"].count() == 2
    assert {r.feature: r["count"] for r in reports["features_summary"].collect()} == {"StepCount": 1, "ActivitySummary": 1}
    assert reports["activity_totals"].where("name = 'StepCount'").first().seconds == 900
    pipelines.write_statistics(reports, target)
    sizes = spark.read.option("header", True).csv(f"{target}/logfile_folder_sizes").collect()
    assert [r.participant_id for r in sizes] == ["101", "102"] and int(sizes[0].folder_size_bytes) > int(sizes[1].folder_size_bytes)
    wide = spark.read.option("header", True).csv(f"{target}/logfile_activity_counts")
    assert wide.columns == ["date", "ActivitySummary", "StepCount"] and wide.first().StepCount == "3"
    assert spark.read.option("header", True).csv(f"{target}/logfile_features_by_id").columns == ["participant_id", "ActivitySummary", "StepCount"]
    assert pipelines.run_series(features, ["StepCount"], f"{target}/series", min_duration="15min") == 0
    assert spark.read.parquet(f"{target}/series").count() == 3


def test_folder_files(spark, tmp_path):
    source, _ = tree(tmp_path)
    assert export.folder_files(spark, source).count() == 2
    assert export.folder_files(spark, source, logs=True).count() == 3


def test_incremental_equals_one_pass(spark, tmp_path):
    start = datetime(2024, 1, 1, tzinfo=timezone.utc)
    rows = [(k % 3, "s", start + timedelta(minutes=k), start + timedelta(minutes=k + 7), float(k), k) for k in range(60)]
    df = spark.createDataFrame(rows, incremental.RECORDS)
    folders = [str(tmp_path / x) for x in ("in", "store", "checkpoint")]
    for part in (F.col("ord") < 30, F.col("ord") >= 30):
        df.where(part).coalesce(1).write.mode("append").parquet(folders[0])
        incremental.start(spark, *folders, cumulative=("s",)).awaitTermination()
    once = incremental.contributions(df, "5min", ("s",)).groupBy("participant_id", "name", "start_date", "end_date").agg(F.median("value").alias("value"), F.count("*").alias("n"))
    assert sorted(incremental.combined(spark, folders[1]).collect()) == sorted(once.collect())

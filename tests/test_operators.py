from __future__ import annotations

from datetime import date, datetime, timedelta, timezone

import pytest
from pyspark.sql import functions as F

from pulsegrid import catalog
from pulsegrid.functions import scalars
from pulsegrid.functions.literals import records_of
from pulsegrid.operators import aggregates, analytics, reshape, segments, selection, statistics, windows

DAY = datetime(2024, 1, 1, tzinfo=timezone.utc)


def at(hm: str) -> datetime:
    h, m = map(int, hm.split(":"))
    return DAY + timedelta(hours=h, minutes=m)


def events(spark, rows, name="StepCount"):
    return spark.createDataFrame([(1, name, at(a), at(b), float(v), k) for k, (a, b, v) in enumerate(rows)], "participant_id long, name string, start_date timestamp, end_date timestamp, value double, ord long")


@pytest.mark.parametrize(("start", "end", "n"), [("12:03", "12:12", 3), ("12:00", "12:00", 1), ("12:03", "12:01", 1), ("12:13", "12:01", 0), ("12:07", "12:03", 1)])
def test_grid(spark, start, end, n):
    df = events(spark, [(start, end, 1)])
    assert windows.window_counts(df).first().n_windows == n
    assert windows.spread(df).count() == n


def test_cumulative_values_are_shared_and_levels_repeat(spark):
    assert [r.value for r in windows.spread(events(spark, [("12:03", "12:12", 90)])).collect()] == [30.0] * 3
    assert [r.value for r in windows.spread(events(spark, [("12:03", "12:12", 70)], "HeartRate")).collect()] == [70.0] * 3


def test_windows_combine_by_median(spark):
    df = events(spark, [("12:00", "12:05", 10), ("12:00", "12:05", 30)])
    assert [r.value for r in windows.distribute(df, order=F.col("ord")).collect()] == [20.0]


def test_shares_add_up(spark):
    df = events(spark, [("10:01", "10:59", 7), ("23:58", "23:59", 3), ("11:00", "13:00", 11)])
    assert windows.spread(df).agg(F.round(F.sum("value"), 9)).first()[0] == 21.0


def test_mode_takes_the_least_of_equals(spark):
    df = spark.createDataFrame([(1, x) for x in "baba"], "k int, v string")
    assert df.groupBy("k").agg(aggregates.categorical("v").alias("v")).first().v == "a"


def test_first_known_value(spark):
    df = spark.createDataFrame([(1, 0, None), (1, 1, 5), (1, 2, 6)], "k int, ord int, v int")
    assert df.groupBy("k").agg(aggregates.first_known("v", F.col("ord")).alias("v")).first().v == 5


def test_ragged_vectors(spark):
    df = spark.createDataFrame([(1, [[1.0, 2.0], [3.0, 4.0]]), (1, [[5.0, 6.0]])], "k int, v array<array<double>>")
    assert aggregates.pointwise_median(df, ["k"], "v").first().v == [[3.0, 4.0], [3.0, 4.0]]


def test_dedupe_is_idempotent(spark):
    df = events(spark, [("12:00", "12:05", 1), ("12:00", "12:05", 3), ("12:10", "12:15", 4)])
    keys = ["participant_id", "name", "start_date", "end_date"]
    once = aggregates.dedupe(df, keys, {"value": "numeric"}, F.col("ord"))
    assert sorted(once.collect()) == sorted(aggregates.dedupe(once, keys, {"value": "numeric"}, F.col("ord")).collect())
    assert aggregates.has_duplicates(df, keys)
    assert not aggregates.has_duplicates(once, keys)


def test_segments_use_the_previous_end(spark):
    df = events(spark, [("00:00", "00:05", 1), ("00:03", "00:04", 1), ("00:06", "00:08", 1)])
    assert [r.segment for r in segments.mark_segments(df, "1min", order=["ord"]).orderBy("ord").collect()] == [0, 0, 1]


def test_segment_limits_are_inclusive(spark):
    df = events(spark, [("00:00", "00:05", 1), ("00:06", "01:00", 1)])
    assert segments.continuous_rows(df, "60min", "1min", order=["ord"]).count() == 2
    assert segments.continuous_rows(df, "61min", "1min", order=["ord"]).count() == 0
    assert segments.total_hours(df).first().hours == 0
    assert segments.total_hours(df.limit(0)).first().hours == 0


@pytest.mark.parametrize(("text", "known"), [("2024-01-01T00:00:00.000+0000", True), ("2024-01-01T00:00:00+0000", False), ("2024-01-01", False), ("2024-01-01T00:00:00.5Z", True), (None, False)])
def test_strict_timestamps(spark, text, known):
    df = spark.createDataFrame([(text,)], "t string").select(scalars.strict_timestamp(F.col("t")).alias("t"))
    assert (df.first().t is not None) == known


def test_scalars(spark):
    df = spark.createDataFrame([(None, None, 1.9), (1.0, 0.0, -1.9), (9.0, 2.0, 2.5)], "v double, by double, w double")
    got = df.select(scalars.clip_upper(F.col("v"), 5).alias("c"), scalars.safe_divide(F.col("w"), F.col("by")).alias("d"), scalars.whole(F.col("w")).alias("t")).collect()
    assert [r.c for r in got] == [None, 1.0, 5.0]
    assert [r.d for r in got] == [0.0, 0.0, 1.25]
    assert [r.t for r in got] == [1, -1, 2]
    assert scalars.micros("5min") == 300_000_000 == scalars.micros("0.5 min") * 10
    with pytest.raises(ValueError, match="duration"):
        scalars.micros("soon")


def test_sources(spark):
    df = spark.createDataFrame([(" AppleHealthKit\t",), (None,), ("other",)], "data_source string")
    assert selection.from_source(df).count() == 1
    assert selection.anonymise(spark.createDataFrame([(1, 2)], "id int, value int")).columns == ["value"]


@pytest.mark.parametrize(("text", "known"), [("'[{'a': None}]'", '[{"a": null}]'), ("'[{\"a\": null}]'", None), ("'{'a': (1, 2)}'", '[{"a": [1, 2]}]'), ("'[1]'", None), (None, None), ("", None), ("'[]'", "[]")])
def test_literals(text, known):
    assert records_of(text) == known


def test_families():
    assert catalog.value_columns(["value", "average_heart_rate"]) == ["value"]
    assert catalog.value_columns(["average_heart_rate"]) == ["average_heart_rate"]
    assert catalog.family([]) == "daily_summary"
    assert catalog.is_cumulative("StepCount")
    assert not catalog.is_cumulative("HeartRate")


def test_outer_merge_fills_zero(spark):
    a = spark.createDataFrame([(date(2024, 1, 1), 2)], "date date, a long")
    b = spark.createDataFrame([(date(2024, 1, 2), 3)], "date date, b long")
    assert sorted(map(tuple, reshape.merge_outer([a, b], "date").collect())) == [(date(2024, 1, 1), 2, 0), (date(2024, 1, 2), 0, 3)]


def test_months_without_rows(spark):
    df = spark.createDataFrame([(date(2024, 1, 5), "a", 1.0), (date(2024, 3, 5), "a", 2.0)], "d date, name string, v double")
    assert [r.total for r in reshape.monthly_totals(df, "d", "name", F.sum("v")).orderBy("month_end").collect()] == [1.0, 0.0, 2.0]


def test_sizes_at_a_threshold(spark):
    df = spark.createDataFrame([(1e6,), (2e6,)], "s double")
    assert [r.pct for r in statistics.size_bins(df, "s").orderBy("bin").collect()] == [50.0, 50.0, 0.0, 0.0, 0.0]


def test_histogram_keeps_the_greatest_value(spark):
    df = spark.createDataFrame([(float(k),) for k in range(11)], "v double")
    assert sum(r.n for r in statistics.histogram(df, "v", 10).collect()) == 11
    assert statistics.histogram(df, "v", 10).agg(F.max("bin")).first()[0] == 10


def test_body_mass_classes(spark):
    df = spark.createDataFrame([(1, 25.0), (2, 30.0), (3, 24.9), (4, None)], "participant_id int, value double")
    assert {r["class"]: r.n for r in statistics.bmi_classes(df).collect()} == {"Overweight": 1, "Obese": 1, "Normal": 1}


def test_normalising_without_active_devices(spark):
    daily = spark.createDataFrame([(date(2024, 1, 1), 6), (date(2024, 1, 2), 6), (date(2024, 1, 3), 6)], "date date, n long")
    active = spark.createDataFrame([(date(2024, 1, 1), 3), (date(2024, 1, 2), 0)], "date date, active_devices long")
    assert [r.n for r in statistics.normalise_by_active(daily, active, ["n"]).orderBy("date").collect()] == [2.0, 0.0, 0.0]


def test_coverage_looks_for_the_files_names(spark):
    rows = [(1, "Height"), (1, "Weight"), (1, "BMI"), (2, "BMI"), (3, "Height"), (3, "Weight"), (4, "Height")]
    assert tuple(statistics.coverage(spark.createDataFrame(rows, "participant_id int, name string")).first()) == (2, 2, 1)


def test_percent_lines(spark):
    assert statistics.percent_lines(spark.createDataFrame([], "class string, n long, pct double")).first().line == "Total: 0 users (0%)"
    lines = statistics.percent_lines(spark.createDataFrame([("Normal", 1, 100 / 3), ("Obese", 2, 200 / 3)], "class string, n long, pct double")).collect()
    assert [r.line for r in lines] == ["Normal: 1 users (33.3%)", "Obese: 2 users (66.7%)", "Total: 3 users (100%)"]


def test_required_times_raise(spark):
    df = spark.createDataFrame([("2024-01-01 10:00:00",), (None,)], "t string").select(scalars.required_timestamp(F.col("t")).alias("t"))
    assert df.where("t is not null").count() == 1
    with pytest.raises(Exception, match="not a time: soon"):
        spark.createDataFrame([("soon",)], "t string").select(scalars.required_timestamp(F.col("t")).alias("t")).collect()


def test_month_columns(spark):
    df = spark.createDataFrame([(1, 5, None, 7, "x"), (2, 1, None, 1, "y")], "participant_id int, `2024-01` long, `2024-02` long, `2024-03` long, note string")
    assert analytics.month_columns(df, "2024-01-02", "2024-03-01") == ["2024-02", "2024-03"]
    assert sorted((r.month, r.total) for r in analytics.month_matrix_totals(df, "2024-01-01", "2024-12-31").collect()) == [("2024-01", 6), ("2024-02", 0), ("2024-03", 8)]
    assert analytics.month_matrix_totals(df, "2025-01-01", "2025-12-31").count() == 0
    few = spark.createDataFrame([("2024-13",), ("2024-02",), ("soon",)], "m string").select(scalars.month_start(F.col("m")).alias("d")).collect()
    assert [r.d for r in few] == [None, date(2024, 2, 1), None]


def test_fliers_lie_beyond_the_whiskers(spark):
    df = spark.createDataFrame([("a", float(v)) for v in [1, 2, 3, 4, 5, 100]] + [("b", 1.0), ("b", None)], "k string, v double")
    assert [tuple(r) for r in aggregates.fliers(df, ["k"], "v").collect()] == [("a", 100.0)]
    assert sum(r.n_outliers for r in aggregates.box_stats(df, ["k"], "v").collect()) == 1


def test_a_sample_does_not_depend_on_partitions(spark):
    df = spark.range(500)
    a, b = (sorted(r.id for r in reshape.exact_sample(d, 20, ["id"]).collect()) for d in (df, df.orderBy(F.desc("id")).repartition(7)))
    assert a == b and len(a) == 20 and a != sorted(r.id for r in reshape.exact_sample(df, 20, ["id"], seed=1).collect())


def test_sources_with_any_blanks(spark):
    df = spark.createDataFrame([("\u00a0\u3000AppleHealthKit\u2003",)], "data_source string")
    assert selection.from_source(df).count() == 1


def test_a_day_of_nulls_sums_to_zero(spark):
    df = spark.createDataFrame([(at("10:00"), None)], "start_date timestamp, value double")
    assert analytics.daily_sum(df).first().value == 0.0


def test_skip_and_resume(spark):
    ids = spark.createDataFrame([(1,), (2,)], "participant_id long")
    done = spark.createDataFrame([(1,)], "participant_id long")
    assert selection.skip_ids(ids, done, skip=True, resume=False).count() == 1
    assert selection.skip_ids(ids, done, skip=True, resume=True).count() == 2

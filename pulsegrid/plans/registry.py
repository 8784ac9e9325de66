"""Queries over the driver's tables: each applies one operator; SQL beside it says the same for DuckDB.

Events stand in for records: an event lasts (event_id * 7919) % 1800 seconds from its time.
Times are returned as epoch microseconds and averages rounded to 6 places, so both engines give equal values.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..catalog import value_columns
from ..functions.literals import literal_records
from ..functions.scalars import axis_label, lenient_timestamp, parent, required_timestamp, safe_name, strict_timestamp
from ..operators import aggregates as agg
from ..operators import analytics, reshape, segments, selection, statistics, windows
from ..session import scratch
from ..sources import export, sinks
from ..streaming.incremental import contributions
from .pipelines import run_etl, run_statistics, write_statistics

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}

CUMULATIVE = ("click", "purchase")
TYPES = ("click", "error", "purchase", "signup", "view")
REC = """WITH rec AS (
  SELECT user_id AS participant_id, event_type AS name, ts AS start_date, ts + to_seconds((event_id * 7919) % 1800) AS end_date,
         CAST(ts AS DATE) AS date, value, event_id AS ord, props, epoch_us(ts) AS su, epoch_us(ts) + ((event_id * 7919) % 1800) * 1000000 AS eu
  FROM events)"""


def query(sql: str | None = None, rec: bool = False) -> Callable[[Query], Query]:
    def register(f: Query) -> Query:
        QUERIES[f.__name__] = f
        if sql:
            ORACLES[f.__name__] = f"{REC}{sql}" if rec else sql
        return f

    return register


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def records(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = table(spark, sf_dir, "events")
    start = F.col("ts").cast("timestamp")
    end = F.timestamp_micros(F.unix_micros(start) + (F.col("event_id") * 7919) % 1800 * 1_000_000)
    return e.select(F.col("user_id").alias("participant_id"), F.col("event_type").alias("name"), start.alias("start_date"), end.alias("end_date"), F.to_date(start).alias("datetime"), "value", F.col("event_id").alias("ord"), "props")


def us(column: str, name: str) -> Column:
    return F.unix_micros(column).alias(name)


def r6(column: str | Column, name: str) -> Column:
    return F.round(column, 6).alias(name)


# Windows ------------------------------------------------------------------------------------------


@query(
    """, w AS (
  SELECT participant_id, name, value, ord, (su // 300000000) * 300000000 AS ws,
         CASE WHEN ((eu + 299999999) // 300000000) * 300000000 = (su // 300000000) * 300000000 THEN (su // 300000000) * 300000000 + 300000000
              ELSE ((eu + 299999999) // 300000000) * 300000000 END AS we FROM rec),
x AS (SELECT participant_id, name, ord, unnest(generate_series(ws, we - 300000000, 300000000)) AS start_us,
             CASE WHEN name IN ('click', 'purchase') THEN value / ((we - ws) // 300000000) ELSE value END AS v FROM w)
SELECT participant_id, name, start_us, start_us + 300000000 AS end_us, round(median(v), 6) AS value, min(ord) AS first_ord
FROM x GROUP BY ALL""",
    rec=True,
)
def window_distribute(spark, sf_dir):
    rec = records(spark, sf_dir).drop("datetime", "props")
    out = windows.distribute(rec, "5min", order=F.col("ord"), cumulative=CUMULATIVE)
    return out.select("participant_id", "name", us("start_date", "start_us"), us("end_date", "end_us"), r6("value", "value"), F.col("ord").alias("first_ord"))


@query(
    """ SELECT ord, CAST(greatest(0, (CASE WHEN we = ws THEN ws + 300000000 ELSE we END - ws) // 300000000) AS BIGINT) AS n_windows
FROM (SELECT ord, (su // 300000000) * 300000000 AS ws, ((eu + 299999999) // 300000000) * 300000000 AS we FROM rec)""",
    rec=True,
)
def window_single_count(spark, sf_dir):
    return windows.window_counts(records(spark, sf_dir)).select("ord", "n_windows")


@query(
    "SELECT user_id, event_type, epoch_us(date_trunc('hour', ts)) AS hour_us, count(*) AS n, round(sum(value), 6) AS total FROM events GROUP BY user_id, event_type, date_trunc('hour', ts)"
)
def dedupe_sum(spark, sf_dir):
    hours = table(spark, sf_dir, "events").withColumn("hour", F.date_trunc("hour", F.col("ts").cast("timestamp")))
    return hours.groupBy("user_id", "event_type", us("hour", "hour_us")).agg(F.count("*").alias("n"), r6(agg.numeric("value", "sum"), "total"))


# Deduplication ------------------------------------------------------------------------------------


def _by_hour(spark, sf_dir) -> DataFrame:
    e = table(spark, sf_dir, "events")
    return e.select("user_id", "event_type", F.date_trunc("hour", F.col("ts").cast("timestamp")).alias("hour"), "value", "props", "event_id")


@query("SELECT user_id, event_type, epoch_us(date_trunc('hour', ts)) AS hour_us, round(median(value), 6) AS value, arg_min(props, event_id) AS props FROM events GROUP BY user_id, event_type, date_trunc('hour', ts)")
def dedupe_median(spark, sf_dir):
    out = agg.dedupe(_by_hour(spark, sf_dir), ["user_id", "event_type", "hour"], {"value": "numeric"}, F.col("event_id"))
    return out.select("user_id", "event_type", us("hour", "hour_us"), r6("value", "value"), "props")


@query("SELECT user_id, event_type, epoch_us(date_trunc('hour', ts)) AS hour_us, round(avg(value), 6) AS value FROM events GROUP BY user_id, event_type, date_trunc('hour', ts)")
def dedupe_mean(spark, sf_dir):
    out = agg.dedupe(_by_hour(spark, sf_dir).drop("props"), ["user_id", "event_type", "hour"], {"value": "numeric"}, F.col("event_id"), "mean")
    return out.select("user_id", "event_type", us("hour", "hour_us"), r6("value", "value"))


@query(
    """SELECT user_id, date, event_type FROM (
  SELECT user_id, CAST(ts AS DATE) AS date, event_type, row_number() OVER (PARTITION BY user_id, CAST(ts AS DATE) ORDER BY count(*) DESC, event_type) AS k
  FROM events GROUP BY user_id, CAST(ts AS DATE), event_type) WHERE k = 1"""
)
def dedupe_mode(spark, sf_dir):
    e = table(spark, sf_dir, "events").select("user_id", F.to_date("ts").alias("date"), "event_type", "event_id")
    return agg.dedupe(e, ["user_id", "date"], {"event_type": "categorical"}, F.col("event_id")).select("user_id", "date", "event_type")


@query(" SELECT participant_id, date, round(avg(value), 6) AS value, arg_min(name, ord) AS name FROM rec GROUP BY participant_id, date", rec=True)
def activity_mean(spark, sf_dir):
    rec = records(spark, sf_dir).select("participant_id", F.col("datetime").alias("date"), "value", "name", "ord")
    return agg.daily_summary(rec, ["participant_id", "date"], ["value"], F.col("ord")).select("participant_id", "date", r6("value", "value"), "name")


@query("SELECT user_id, event_type, epoch_us(date_trunc('hour', ts)) AS hour_us, count(*) AS n FROM events GROUP BY user_id, event_type, date_trunc('hour', ts) HAVING count(*) > 1")
def duplicate_keys(spark, sf_dir):
    return agg.duplicate_keys(_by_hour(spark, sf_dir), ["user_id", "event_type", "hour"]).select("user_id", "event_type", us("hour", "hour_us"), "n")


@query(
    """WITH v AS (SELECT label, unnest(embedding) AS x, generate_subscripts(embedding, 1) AS i FROM embeddings)
SELECT label, CAST(i - 1 AS INTEGER) AS position, round(median(CAST(x AS DOUBLE)), 6) AS median FROM v GROUP BY label, i"""
)
def vector_pointwise_median(spark, sf_dir):
    e = table(spark, sf_dir, "embeddings").select("label", F.transform("embedding", lambda x: F.array(x.cast("double"))).alias("v"))
    return agg.pointwise_median(e, ["label"], "v").select("label", F.posexplode("v").alias("position", "x")).select("label", "position", r6(F.col("x")[0], "median"))


# Selection ----------------------------------------------------------------------------------------


@query("SELECT event_id, epoch_us(ts) AS ts_us, user_id, event_type, value FROM events")
def anonymise(spark, sf_dir):
    rows = table(spark, sf_dir, "events").withColumnRenamed("props", "metadata").withColumn("source_name", F.lit("watch"))
    out = selection.anonymise(rows)
    return out.select(*[c for c in out.columns if c != "ts"], F.unix_micros(F.col("ts").cast("timestamp")).alias("ts_us"))


@query("SELECT doc_id, source FROM documents WHERE lower(trim(source)) = 'src1'")
def source_filter(spark, sf_dir):
    padded = table(spark, sf_dir, "documents").select("doc_id", "source", F.concat(F.lit(" \t"), F.upper("source"), F.lit("\n ")).alias("data_source"))
    return selection.from_source(padded, "src1").select("doc_id", "source")


@query(" SELECT ord, su AS start_us, eu AS end_us FROM rec WHERE start_date >= TIMESTAMP '2024-01-05' AND end_date <= TIMESTAMP '2024-01-20'", rec=True)
def range_contained(spark, sf_dir):
    return analytics.contained(records(spark, sf_dir), "2024-01-05", "2024-01-20").select("ord", us("start_date", "start_us"), us("end_date", "end_us"))


@query("SELECT o_orderkey AS filename FROM orders WHERE NOT EXISTS (SELECT 1 FROM lineitem WHERE l_orderkey = o_orderkey AND l_quantity > 45)")
def unprocessed_files(spark, sf_dir):
    log = table(spark, sf_dir, "lineitem").where("l_quantity > 45").select(F.col("l_orderkey").alias("filename"))
    return selection.unprocessed(table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("filename")), log)


@query("SELECT o_orderkey AS filename FROM orders WHERE EXISTS (SELECT 1 FROM lineitem WHERE l_orderkey = o_orderkey AND l_quantity > 45)")
def processed_files(spark, sf_dir):
    log = table(spark, sf_dir, "lineitem").where("l_quantity > 45").select(F.col("l_orderkey").alias("filename"))
    return selection.processed(table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("filename")), log)


@query("SELECT c_custkey AS participant_id FROM customer WHERE EXISTS (SELECT 1 FROM orders WHERE o_custkey = c_custkey AND o_orderstatus = 'F')")
def select_dirs(spark, sf_dir):
    wanted = table(spark, sf_dir, "orders").where("o_orderstatus = 'F'").select(F.col("o_custkey").alias("participant_id"))
    return selection.select_ids(table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("participant_id")), wanted)


@query("SELECT c_custkey AS participant_id FROM customer WHERE NOT EXISTS (SELECT 1 FROM orders WHERE o_custkey = c_custkey)")
def skip_dirs(spark, sf_dir):
    present = table(spark, sf_dir, "orders").select(F.col("o_custkey").alias("participant_id"))
    return selection.skip_ids(table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("participant_id")), present, skip=True, resume=False)


@query("SELECT DISTINCT source AS name, regexp_replace(source || '/ä b.c', '[^\\p{L}\\p{N}_-]', '_', 'g') AS safe FROM documents")
def safe_names(spark, sf_dir):
    names = table(spark, sf_dir, "documents").select(F.col("source").alias("name")).distinct()
    return names.select("name", safe_name(F.concat("name", F.lit("/ä b.c"))).alias("safe"))


@query("SELECT * FROM (VALUES ('scalar', 'value'), ('pressure', 'blood_pressure_systolic_value'), ('pressure', 'blood_pressure_diastolic_value'), ('ecg', 'average_heart_rate'), ('ecg', 'sampling_frequency'), ('summary', 'apple_stand_hours')) t(case_name, value_column)")
def value_column_choice(spark, sf_dir):
    cases = {"scalar": ["start_date", "value", "average_heart_rate"], "pressure": ["blood_pressure_systolic_value", "blood_pressure_diastolic_value"], "ecg": ["average_heart_rate", "sampling_frequency"], "summary": ["apple_stand_hours", "other"]}
    return spark.createDataFrame([(k, c) for k, have in cases.items() for c in value_columns(have)], "case_name string, value_column string")


# Parsing ------------------------------------------------------------------------------------------


@query("SELECT event_id, CAST(json_extract(props, '$.k') AS BIGINT) AS k, CASE WHEN event_id % 2 = 0 THEN 'yes' END AS note FROM events WHERE event_id % 10 <> 9")
def parse_literal(spark, sf_dir):
    k = F.get_json_object("props", "$.k")
    good = F.concat(F.lit("'[{'k': "), k, F.lit(", 'note': "), F.when(F.col("event_id") % 2 == 0, F.lit("'yes'")).otherwise(F.lit("None")), F.lit("}]'"))
    bad = F.concat(F.lit("'[{\"k\": "), k, F.lit(", \"note\": null}]'"))
    rows = table(spark, sf_dir, "events").select("event_id", literal_records(F.when(F.col("event_id") % 10 == 9, bad).otherwise(good)).alias("r")).where("r is not null")
    return rows.select("event_id", F.explode("r").alias("r")).select("event_id", F.col("r")["k"].try_cast("bigint").alias("k"), F.col("r")["note"].alias("note"))


@query("SELECT event_id, CAST(p AS INTEGER) AS pos, epoch_us(ts) + p * 60000000 AS start_us, round(value + p, 6) AS value FROM events, (VALUES (0), (1)) t(p)")
def explode_records(spark, sf_dir):
    at = lambda p: F.date_format(F.timestamp_micros(F.unix_micros(F.col("ts").cast("timestamp")) + p * 60_000_000), "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'+0000'")
    one = lambda p: F.concat(F.lit("{'start_date': '"), at(p), F.lit("', 'value': "), (F.col("value") + p).cast("string"), F.lit("}"))
    rows = table(spark, sf_dir, "events").select("event_id", literal_records(F.concat(F.lit("'["), one(0), F.lit(", "), one(1), F.lit("]'"))).alias("r"))
    return rows.select("event_id", F.posexplode("r").alias("pos", "r")).select("event_id", "pos", F.unix_micros(strict_timestamp(F.col("r")["start_date"])).alias("start_us"), r6(F.col("r")["value"].try_cast("double"), "value"))


@query("SELECT event_id, CASE WHEN event_id % 3 <> 0 THEN epoch_us(date_trunc('second', ts)) + CASE WHEN event_id % 3 = 1 THEN 500000 ELSE 500000 - 7200000000 END ELSE -1 END AS strict_us, CASE WHEN event_id % 3 = 0 THEN epoch_us(date_trunc('second', ts)) WHEN event_id % 3 = 1 THEN epoch_us(date_trunc('second', ts)) + 500000 ELSE epoch_us(date_trunc('second', ts)) + 500000 - 7200000000 END AS lenient_us FROM events")
def timestamp_parsing(spark, sf_dir):
    stamp = F.date_format(F.col("ts").cast("timestamp"), "yyyy-MM-dd'T'HH:mm:ss")
    text = F.concat(stamp, F.when(F.col("event_id") % 3 == 0, "+0000").when(F.col("event_id") % 3 == 1, ".5Z").otherwise(".500+02:00"))
    return table(spark, sf_dir, "events").select("event_id", text.alias("t")).select("event_id", F.coalesce(F.unix_micros(strict_timestamp(F.col("t"))), F.lit(-1)).alias("strict_us"), F.unix_micros(lenient_timestamp(F.col("t"))).alias("lenient_us"))


# Segments -----------------------------------------------------------------------------------------

_SEG = """, l AS (SELECT *, lag(eu) OVER (PARTITION BY participant_id, name ORDER BY su, eu, ord) AS pe FROM rec),
s AS (SELECT *, sum(CASE WHEN su - coalesce(pe, su) > 21600000000 THEN 1 ELSE 0 END) OVER (PARTITION BY participant_id, name ORDER BY su, eu, ord ROWS UNBOUNDED PRECEDING) AS seg FROM l),
g AS (SELECT participant_id, name, seg, min(su) AS first_us, arg_max(eu, (su, eu, ord)) AS last_us, count(*) AS n FROM s GROUP BY ALL)"""
_WHEN = {"tolerance": "6h", "order": ["ord"]}


@query(f"{_SEG} SELECT ord, su AS start_us, eu AS end_us FROM s JOIN g USING (participant_id, name, seg) WHERE last_us - first_us >= 18000000000", rec=True)
def segments_valid_rows(spark, sf_dir):
    return segments.continuous_rows(records(spark, sf_dir), "300min", **_WHEN).select("ord", us("start_date", "start_us"), us("end_date", "end_us"))


@query(f"{_SEG} SELECT participant_id, name, CAST(seg AS BIGINT) AS segment, first_us, last_us, n, round((last_us - first_us) / 1000000.0, 6) AS duration_s FROM g", rec=True)
def segment_summary(spark, sf_dir):
    out = segments.segment_summary(records(spark, sf_dir), **_WHEN)
    return out.select("participant_id", "name", "segment", us("first_start", "first_us"), us("last_end", "last_us"), "n", r6("duration_s", "duration_s"))


@query(f"{_SEG} SELECT CAST(trunc(sum(eu - su) / 3600000000.0) AS BIGINT) AS hours FROM s JOIN g USING (participant_id, name, seg) WHERE last_us - first_us >= 18000000000", rec=True)
def segment_total_hours(spark, sf_dir):
    return segments.total_hours(segments.continuous_rows(records(spark, sf_dir), "300min", **_WHEN))


# Statistics ---------------------------------------------------------------------------------------


@query(" SELECT date, " + ", ".join(f"count(*) FILTER (hour(start_date) = {h}) AS h{h:02d}" for h in range(24)) + " FROM rec GROUP BY date", rec=True)
def hourly_matrix(spark, sf_dir):
    return reshape.hourly_matrix(records(spark, sf_dir), "start_date")


@query(" SELECT participant_id, name, date, count(*) AS n FROM rec GROUP BY ALL", rec=True)
def daily_counts(spark, sf_dir):
    return statistics.daily_counts(records(spark, sf_dir))


_DUR = """, t AS (SELECT participant_id, name, date, CAST(trunc(sum(eu - su) / 1000000.0) AS BIGINT) AS seconds FROM rec WHERE name <> 'error' GROUP BY participant_id, name, date)"""


@query(f"{_DUR} SELECT participant_id, name, date, seconds FROM t", rec=True)
def daily_durations(spark, sf_dir):
    return statistics.daily_durations(statistics.time_accumulated(records(spark, sf_dir), ["error"]))


@query(f"{_DUR} SELECT name, date, CAST(sum(seconds) AS BIGINT) AS seconds FROM t GROUP BY name, date", rec=True)
def sum_over_participants(spark, sf_dir):
    return statistics.sum_over_participants(daily_durations(spark, sf_dir), ["seconds"])


@query(f"{_DUR} SELECT name, CAST(sum(seconds) AS BIGINT) AS seconds, CAST(round_even(sum(seconds) / 3600.0, 0) AS BIGINT) AS hours FROM t GROUP BY name", rec=True)
def activity_totals(spark, sf_dir):
    return statistics.activity_totals(daily_durations(spark, sf_dir))


@query(" SELECT date, " + ", ".join(f"count(*) FILTER (name = '{t}') AS \"{t}\"" for t in TYPES) + " FROM rec GROUP BY date", rec=True)
def daily_wide_outer(spark, sf_dir):
    n = statistics.daily_counts(records(spark, sf_dir), ["name"])
    return reshape.merge_outer([n.where(F.col("name") == t).select("date", F.col("n").alias(t)) for t in TYPES], "date")


@query(" SELECT participant_id, date, " + ", ".join(f"CAST(count(*) FILTER (name = '{t}') AS BIGINT) AS \"{t}\"" for t in TYPES) + " FROM rec GROUP BY participant_id, date", rec=True)
def daily_pivot(spark, sf_dir):
    n = statistics.daily_counts(records(spark, sf_dir)).withColumn("key", F.struct("participant_id", "date"))
    return reshape.wide(n, "key", "name", F.sum("n"), TYPES).select("key.participant_id", "key.date", *TYPES)


@query(" SELECT date, count(DISTINCT participant_id) AS active_devices FROM rec GROUP BY date", rec=True)
def active_devices(spark, sf_dir):
    return statistics.active_devices(records(spark, sf_dir))


@query(" SELECT name AS feature, count(DISTINCT participant_id) AS count FROM rec GROUP BY name", rec=True)
def feature_summary(spark, sf_dir):
    return statistics.feature_summary(records(spark, sf_dir))


@query(" SELECT participant_id, " + ", ".join(f"CAST(max(CASE WHEN name = '{t}' THEN 1 ELSE 0 END) AS BIGINT) AS \"{t}\"" for t in TYPES) + " FROM rec GROUP BY participant_id", rec=True)
def presence_matrix(spark, sf_dir):
    return statistics.presence_matrix(records(spark, sf_dir), TYPES)


@query(" SELECT DISTINCT participant_id, name FROM rec", rec=True)
def presence_pairs(spark, sf_dir):
    return statistics.presence(records(spark, sf_dir))


@query(" SELECT count(DISTINCT participant_id) AS participants FROM rec", rec=True)
def participants_saved(spark, sf_dir):
    return statistics.participants_saved(records(spark, sf_dir))


@query(
    """, p AS (SELECT participant_id, bool_or(name = 'view') AS h, bool_or(name = 'click') AS w, bool_or(name = 'error') AS b FROM rec GROUP BY participant_id)
SELECT count(*) FILTER (h AND w) AS height_weight, count(*) FILTER (b) AS bmi, count(*) FILTER (h AND w AND b) AS all_three FROM p""",
    rec=True,
)
def coverage_hw_bmi(spark, sf_dir):
    files = F.create_map(*[F.lit(x) for x in ("view", "Height", "click", "Weight", "error", "BMI")])
    return statistics.coverage(records(spark, sf_dir).withColumn("name", files[F.col("name")]))


@query("SELECT source, CAST(sum(n_chars) AS BIGINT) AS folder_size_bytes FROM documents GROUP BY source")
def folder_sizes(spark, sf_dir):
    return statistics.folder_sizes(table(spark, sf_dir, "documents"), "source", "n_chars").orderBy(F.desc("folder_size_bytes"), "source")


@query(
    """WITH c AS (SELECT avg(CASE WHEN n_chars <= 500 THEN 100.0 ELSE 0 END) AS a, avg(CASE WHEN n_chars <= 2000 THEN 100.0 ELSE 0 END) AS b, avg(CASE WHEN n_chars <= 8000 THEN 100.0 ELSE 0 END) AS d FROM documents)
SELECT bin, round(cum, 6) AS cumulative_pct, round(pct, 6) AS pct FROM (SELECT 0 AS bin, a AS cum, a AS pct FROM c UNION ALL SELECT 1, b, b - a FROM c UNION ALL SELECT 2, d, d - b FROM c UNION ALL SELECT 3, 100.0, 100.0 - d FROM c)"""
)
def size_bins(spark, sf_dir):
    out = statistics.size_bins(table(spark, sf_dir, "documents"), "n_chars", (500, 2000, 8000))
    return out.select("bin", r6("cumulative_pct", "cumulative_pct"), r6("pct", "pct"))


@query("SELECT source, CAST(row_number() OVER (ORDER BY s, source) - 1 AS INTEGER) AS position, s AS folder_size_bytes FROM (SELECT source, CAST(sum(n_chars) AS BIGINT) AS s FROM documents GROUP BY source)")
def size_ranks(spark, sf_dir):
    sizes = statistics.folder_sizes(table(spark, sf_dir, "documents"), "source", "n_chars")
    return reshape.ranked(sizes, F.col("folder_size_bytes"), F.col("source")).select("source", "position", "folder_size_bytes")


@query(
    """WITH e AS (SELECT min(n_chars) AS lo, max(n_chars) AS hi FROM documents)
SELECT CAST(least(100, floor((n_chars - lo) * 100.0 / (hi - lo)) + 1) AS INTEGER) AS bin, count(*) AS n FROM documents, e WHERE n_chars IS NOT NULL GROUP BY 1"""
)
def size_histogram(spark, sf_dir):
    return statistics.histogram(table(spark, sf_dir, "documents"), "n_chars")


_BOX = """SELECT {keys} round(q1, 6) AS q1, round(med, 6) AS median, round(q3, 6) AS q3,
  round(min(v) FILTER (v BETWEEN q1 - 1.5 * (q3 - q1) AND q3 + 1.5 * (q3 - q1)), 6) AS whisker_low,
  round(max(v) FILTER (v BETWEEN q1 - 1.5 * (q3 - q1) AND q3 + 1.5 * (q3 - q1)), 6) AS whisker_high,
  count(*) FILTER (NOT v BETWEEN q1 - 1.5 * (q3 - q1) AND q3 + 1.5 * (q3 - q1)) AS n_outliers, count(*) AS n
FROM (SELECT *, quantile_cont(v, 0.25) OVER w AS q1, quantile_cont(v, 0.5) OVER w AS med, quantile_cont(v, 0.75) OVER w AS q3 FROM x WHERE v IS NOT NULL WINDOW w AS ({part}))
GROUP BY {keys} q1, med, q3"""


def _box(df: DataFrame, *keys: str) -> DataFrame:
    return df.select(*keys, *[r6(c, c) for c in ("q1", "median", "q3", "whisker_low", "whisker_high")], "n_outliers", "n")


@query("WITH x AS (SELECT source, CAST(n_chars AS DOUBLE) AS v FROM documents) " + _BOX.format(keys="source,", part="PARTITION BY source"))
def size_box(spark, sf_dir):
    return _box(agg.box_stats(table(spark, sf_dir, "documents").withColumn("v", F.col("n_chars").cast("double")), ["source"], "v"), "source")


@query(
    """WITH v AS (SELECT CAST(n_chars AS DOUBLE) AS v FROM documents WHERE n_chars IS NOT NULL),
e AS (SELECT min(v) AS lo, max(v) AS hi, stddev_samp(v) * pow(count(*), -0.2) AS h, count(*) AS n FROM v),
a AS (SELECT k, lo + k * ((hi - lo) / 49) AS x, h, n FROM e, (SELECT CAST(unnest(range(50)) AS INTEGER) AS k))
SELECT k, round(x, 6) AS x, round(1e6 * sum(exp(-((x - v) / h) * ((x - v) / h) / 2) / (h * sqrt(2 * pi()) * n)), 6) AS density_e6 FROM v, a GROUP BY k, x"""
)
def kde(spark, sf_dir):
    out = statistics.kernel_density(table(spark, sf_dir, "documents"), "n_chars")
    return out.select("k", r6("x", "x"), r6(F.col("density") * 1e6, "density_e6"))


# Analytics ----------------------------------------------------------------------------------------

_FC = ", f AS (SELECT participant_id, count(DISTINCT name) AS feature_count FROM rec GROUP BY participant_id)"


def _counts(spark, sf_dir) -> DataFrame:
    return analytics.feature_counts(records(spark, sf_dir))


@query(f"{_FC} SELECT participant_id, feature_count FROM f ORDER BY feature_count DESC, participant_id LIMIT 50", rec=True)
def top_features_by_row(spark, sf_dir):
    matrix = statistics.presence_matrix(records(spark, sf_dir), TYPES)
    return analytics.top_rows(analytics.row_sum(matrix, TYPES), 50).select("participant_id", "feature_count")


@query(f"{_FC} SELECT feature_count, count(*) AS n FROM f GROUP BY feature_count", rec=True)
def feature_count_hist(spark, sf_dir):
    return analytics.count_histogram(_counts(spark, sf_dir))


@query(f"{_FC} SELECT feature_count, CASE WHEN row_number() OVER (ORDER BY feature_count DESC) <= 2 THEN n ELSE 0 END AS n FROM (SELECT feature_count, count(*) AS n FROM f GROUP BY feature_count)", rec=True)
def hist_keep_top_bins(spark, sf_dir):
    return analytics.keep_top_bins(feature_count_hist(spark, sf_dir), 2)


@query("SELECT * FROM customer ORDER BY md5('42|' || c_custkey), c_custkey LIMIT 50")
def sample_n(spark, sf_dir):
    return reshape.exact_sample(table(spark, sf_dir, "customer"), 50, ["c_custkey"])


@query(" SELECT date, count(DISTINCT participant_id) AS active_devices FROM rec WHERE date BETWEEN DATE '2024-01-05' AND DATE '2024-01-10' GROUP BY date", rec=True)
def active_range(spark, sf_dir):
    return analytics.in_dates(active_devices(spark, sf_dir), "date", "2024-01-05", "2024-01-10")


@query(""", d AS (SELECT date, CAST(trunc(sum(eu - su) / 1000000.0) AS BIGINT) / 3600.0 AS hours FROM rec WHERE date BETWEEN DATE '2024-01-05' AND DATE '2024-01-20' GROUP BY date)
SELECT date, round(hours, 6) AS hours, round(greatest(max(hours) OVER (), 200), 6) AS axis_top FROM d""", rec=True)
def duration_hours(spark, sf_dir):
    days = statistics.daily_durations(records(spark, sf_dir), [])
    return analytics.duration_hours(days, "2024-01-05", "2024-01-20").select("date", r6("hours", "hours"), r6("axis_top", "axis_top"))


def _orders(spark, sf_dir) -> DataFrame:
    at = F.col("o_orderdate").cast("timestamp")
    return table(spark, sf_dir, "orders").select(at.alias("start_date"), at.alias("end_date"), F.col("o_totalprice").alias("value"), "o_orderstatus")


_YEAR = "o_orderdate >= TIMESTAMP '1995-01-01' AND o_orderdate <= TIMESTAMP '1995-12-31'"


@query(f"WITH x AS (SELECT strftime(o_orderdate, '%Y-%m') AS month, CASE WHEN o_totalprice > 300000 THEN 300000.0 ELSE o_totalprice END AS v FROM orders WHERE {_YEAR}) " + _BOX.format(keys="month,", part="PARTITION BY month"))
def month_box(spark, sf_dir):
    return _box(analytics.month_box(_orders(spark, sf_dir), "1995-01-01", "1995-12-31", limit=300000), "month")


@query(f"""WITH x AS (SELECT strftime(o_orderdate, '%Y-%m') AS month, o_totalprice AS v FROM orders WHERE {_YEAR}),
q AS (SELECT *, quantile_cont(v, 0.25) OVER w AS a, quantile_cont(v, 0.75) OVER w AS b FROM x WHERE v IS NOT NULL WINDOW w AS (PARTITION BY month))
SELECT month, round(v, 4) AS value FROM q WHERE NOT v BETWEEN a - 1.5 * (b - a) AND b + 1.5 * (b - a)""")
def month_fliers(spark, sf_dir):
    return analytics.month_fliers(_orders(spark, sf_dir), "1995-01-01", "1995-12-31").select("month", F.round("value", 4).alias("value"))


@query(
    f"""WITH x AS (SELECT 'open' AS feature, strftime(o_orderdate, '%Y-%m') AS month, CASE WHEN o_totalprice > 200000 THEN 200000.0 ELSE o_totalprice END AS v FROM orders WHERE {_YEAR} AND o_orderstatus = 'O'
UNION ALL SELECT 'other', strftime(o_orderdate, '%Y-%m'), o_totalprice FROM orders WHERE {_YEAR} AND o_orderstatus <> 'O') """
    + _BOX.format(keys="feature, month,", part="PARTITION BY feature, month")
)
def dual_month_box(spark, sf_dir):
    o = _orders(spark, sf_dir)
    return _box(analytics.dual_month_box(o.where("o_orderstatus = 'O'"), o.where("o_orderstatus <> 'O'"), "1995-01-01", "1995-12-31", ("open", "other"), (200000, None)), "feature", "month")


@query(f"SELECT month, round(CASE WHEN v > 2000000 THEN 2000000.0 ELSE v END, 4) AS value, CAST(count(*) AS BIGINT) AS n FROM (SELECT strftime(o_orderdate, '%Y-%m') AS month, sum(o_totalprice) AS v FROM orders WHERE {_YEAR} GROUP BY CAST(o_orderdate AS DATE), 1) GROUP BY ALL")
def day_sum_clip(spark, sf_dir):
    days = analytics.monthly_values(_orders(spark, sf_dir), "1995-01-01", "1995-12-31", day_sum=True, limit=2000000)
    return days.groupBy("month", F.round("value", 4).alias("value")).agg(F.count("*").alias("n"))


def _shipped(spark, sf_dir) -> DataFrame:
    return table(spark, sf_dir, "lineitem").select(F.col("l_returnflag").alias("name"), F.to_date("l_shipdate").alias("date"), F.col("l_quantity").alias("q"))


@query(
    """WITH s AS (SELECT l_returnflag AS name, last_day(l_shipdate) AS month_end, sum(l_quantity) AS total FROM lineitem GROUP BY ALL),
m AS (SELECT last_day(CAST(unnest(generate_series(date_trunc('month', min(month_end)), date_trunc('month', max(month_end)), INTERVAL 1 MONTH)) AS DATE)) AS month_end FROM s)
SELECT name, month_end, coalesce(total, 0.0) AS total FROM (SELECT DISTINCT name FROM s) CROSS JOIN m LEFT JOIN s USING (name, month_end)"""
)
def monthly_resample(spark, sf_dir):
    return reshape.monthly_totals(_shipped(spark, sf_dir), "date", "name", F.sum("q"))


@query(
    """WITH s AS (SELECT l_returnflag AS name, last_day(l_shipdate) AS month_end, sum(l_quantity) AS total FROM lineitem GROUP BY ALL),
t AS (SELECT name FROM s GROUP BY name ORDER BY sum(total) DESC, name LIMIT 2),
m AS (SELECT last_day(CAST(unnest(generate_series(date_trunc('month', min(month_end)), date_trunc('month', max(month_end)), INTERVAL 1 MONTH)) AS DATE)) AS month_end FROM s)
SELECT name, month_end, coalesce(total, 0.0) AS total FROM t CROSS JOIN m LEFT JOIN s USING (name, month_end)"""
)
def top_activities_monthly(spark, sf_dir):
    months = monthly_resample(spark, sf_dir)
    return months.join(F.broadcast(reshape.top_names(months, "name", F.sum("total"), 2).select("name")), "name", "left_semi")  # two rows


@query(" SELECT name, CAST(count(*) AS BIGINT) AS total FROM rec WHERE date BETWEEN DATE '2024-01-05' AND DATE '2024-01-20' GROUP BY name ORDER BY total DESC, name LIMIT 3", rec=True)
def agg_totals_counts(spark, sf_dir):
    return reshape.top_names(analytics.in_dates(records(spark, sf_dir), "datetime", "2024-01-05", "2024-01-20"), "name", F.count("*"), 3)


@query(" SELECT name, round(sum(eu - su) / 3600000000.0, 6) AS hours FROM rec WHERE date BETWEEN DATE '2024-01-05' AND DATE '2024-01-20' GROUP BY name ORDER BY sum(eu - su) DESC, name LIMIT 3", rec=True)
def agg_totals_durations(spark, sf_dir):
    rows = analytics.in_dates(records(spark, sf_dir), "datetime", "2024-01-05", "2024-01-20")
    return reshape.top_names(rows, "name", F.sum(F.unix_micros("end_date") - F.unix_micros("start_date")), 3).select("name", r6(F.col("total") / 3.6e9, "hours"))


@query(f", c AS (SELECT date, {', '.join(f'count(*) FILTER (name = {chr(39)}{t}{chr(39)}) AS {t}' for t in TYPES)} FROM rec WHERE date BETWEEN DATE '2024-01-05' AND DATE '2024-01-20' GROUP BY date) SELECT date, feature, value FROM c UNPIVOT (value FOR feature IN ({', '.join(TYPES)}))", rec=True)
def heatmap_long(spark, sf_dir):
    days = analytics.in_dates(daily_wide_outer(spark, sf_dir), "date", "2024-01-05", "2024-01-20")
    return reshape.long(days, ["date"], list(TYPES))


@query("SELECT strftime(o_orderdate, '%Y-%m') AS month, round(sum(o_totalprice), 2) AS total FROM orders GROUP BY 1")
def monthly_volume(spark, sf_dir):
    o = table(spark, sf_dir, "orders").withColumn("at", F.col("o_orderdate").cast("timestamp"))
    return analytics.monthly_volume(o, "at", "o_totalprice").select("month", F.round("total", 2).alias("total"))


@query("WITH m AS (SELECT CAST(year(o_orderdate) AS INTEGER) AS year, min(strftime(o_orderdate, '%Y-%m')) AS first_month FROM orders GROUP BY 1) SELECT * FROM m WHERE year > (SELECT min(year) FROM m)")
def year_ticks(spark, sf_dir):
    return analytics.year_ticks(monthly_volume(spark, sf_dir))


@query(
    """, m AS (SELECT participant_id, median(value) AS v FROM rec GROUP BY participant_id),
c AS (SELECT CASE WHEN v < 4 THEN 'Normal' WHEN v < 6 THEN 'Overweight' ELSE 'Obese' END AS class, count(*) AS n FROM m WHERE v IS NOT NULL GROUP BY 1)
SELECT class, n, round(n * 100.0 / sum(n) OVER (), 6) AS pct FROM c""",
    rec=True,
)
def bmi_classes(spark, sf_dir):
    return statistics.bmi_classes(records(spark, sf_dir), cuts=(4.0, 6.0)).select("class", "n", r6("pct", "pct"))


@query(
    """, d AS (SELECT name, date, count(*) AS n FROM rec GROUP BY ALL), a AS (SELECT date, count(DISTINCT participant_id) AS k FROM rec GROUP BY date)
SELECT name, date, round(CASE WHEN k > 0 THEN n / CAST(k AS DOUBLE) ELSE 0.0 END, 6) AS n FROM d LEFT JOIN a USING (date)""",
    rec=True,
)
def norm_by_active(spark, sf_dir):
    rec = records(spark, sf_dir)
    return statistics.normalise_by_active(statistics.daily_counts(rec, ["name"]), statistics.active_devices(rec), ["n"]).select("name", "date", r6("n", "n"))


_MONTHS = [f"1995-{k:02d}" for k in range(1, 13)] + [f"1996-{k:02d}" for k in range(1, 13)]


def month_matrix(spark, sf_dir) -> DataFrame:
    """A row per customer and a column per month, as the matrix of bytes per participant that charts start from."""
    o = table(spark, sf_dir, "orders").select(F.col("o_custkey").alias("participant_id"), F.date_format("o_orderdate", "yyyy-MM").alias("month"), F.col("o_totalprice").cast("bigint").alias("bytes"))
    return o.groupBy("participant_id").pivot("month", _MONTHS).agg(F.sum("bytes"))


_CELLS = "WITH c AS (SELECT o_custkey AS participant_id, strftime(o_orderdate, '%Y-%m') AS month, CAST(sum(CAST(trunc(o_totalprice) AS BIGINT)) AS BIGINT) AS bytes FROM orders WHERE o_orderdate BETWEEN TIMESTAMP '1995-03-15' AND TIMESTAMP '1996-06-30 23:59:59' GROUP BY ALL)"


@query(f"{_CELLS} SELECT month, CAST(month || '-01' AS DATE) AS month_start, CAST(sum(bytes) AS BIGINT) AS total FROM c WHERE month BETWEEN '1995-04' AND '1996-06' GROUP BY month")
def month_matrix_totals(spark, sf_dir):
    """The period begins in the middle of March 1995, whose column therefore is left out."""
    return analytics.month_matrix_totals(month_matrix(spark, sf_dir), "1995-03-15", "1996-06-30")


@query(f"{_CELLS} SELECT participant_id, month, CAST(month || '-01' AS DATE) AS month_start, bytes FROM c WHERE month BETWEEN '1995-04' AND '1995-06'")
def month_matrix_long(spark, sf_dir):
    return analytics.month_matrix_long(month_matrix(spark, sf_dir), "1995-03-15", "1995-06-30").where("bytes is not null")


@query("SELECT DISTINCT CAST(o_orderdate AS DATE) AS date, strftime(o_orderdate, '%Y') AS year, strftime(o_orderdate, '%Y-%m') AS month, strftime(o_orderdate, '%Y-%m-%d') AS day FROM orders")
def axis_labels(spark, sf_dir):
    dates = table(spark, sf_dir, "orders").select(F.to_date("o_orderdate").alias("date")).distinct()
    return dates.select("date", *[axis_label(F.col("date"), u).alias(u) for u in ("year", "month", "day")])


@query(" , f AS (SELECT name AS feature, count(DISTINCT participant_id) AS count FROM rec GROUP BY name) SELECT feature, count, CAST(row_number() OVER (ORDER BY count, feature) - 1 AS INTEGER) AS position FROM f", rec=True)
def feature_counts_ascending(spark, sf_dir):
    return statistics.ascending_counts(feature_summary(spark, sf_dir))


@query(
    """, m AS (SELECT participant_id, median(value) AS v FROM rec GROUP BY participant_id),
c AS (SELECT CASE WHEN v < 4 THEN 'Normal' WHEN v < 6 THEN 'Overweight' ELSE 'Obese' END AS class, count(*) AS n FROM m WHERE v IS NOT NULL GROUP BY 1),
p AS (SELECT class, n, n * 100.0 / sum(n) OVER () AS pct FROM c)
SELECT class, class || ': ' || n || ' users (' || printf('%.1f', pct) || '%)' AS line FROM p
UNION ALL SELECT 'Total', 'Total: ' || sum(n) || ' users (' || CAST(trunc(round(sum(pct), 6)) AS INTEGER) || '%)' FROM p""",
    rec=True,
)
def bmi_summary_lines(spark, sf_dir):
    return statistics.percent_lines(statistics.bmi_classes(records(spark, sf_dir), cuts=(4.0, 6.0)))


@query("SELECT event_id, epoch_us(ts) AS at_us FROM events")
def required_times(spark, sf_dir):
    text = F.date_format(F.col("ts").cast("timestamp"), "yyyy-MM-dd HH:mm:ss.SSSSSS")
    return table(spark, sf_dir, "events").select("event_id", F.unix_micros(required_timestamp(text)).alias("at_us"))


# Files: each query writes to a new folder of the shared one and reads from there ------------------------------


def export_tree(spark, sf_dir) -> str:
    """Customers as an export: a folder per nation, half of the rows of each in a file with its columns in another order."""
    c = table(spark, sf_dir, "customer")
    at = lambda s: F.date_format(F.timestamp_seconds(F.lit(1704067200) + F.col("c_custkey") * 60 + s), "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'+0000'")
    record = F.concat(F.lit("'[{'id': 1, 'start_date': '"), at(0), F.lit("', 'end_date': '"), at(60), F.lit("', 'value': "), F.col("c_acctbal").cast("string"), F.lit("}]'"))
    rows = c.select(F.col("c_nationkey").alias("folder"), F.lit("HeartRate").alias("name"), F.when(F.col("c_custkey") % 10 == 0, "'nonsense'").otherwise(record).alias("data"), F.when(F.col("c_custkey") % 10 == 1, "other").otherwise(" AppleHealthKit").alias("data_source"), F.col("c_nationkey").cast("string").alias("participant_id"), F.lit("2024-01-01").alias("datetime"), (F.col("c_custkey") % 2).alias("half"))
    path = scratch(spark)
    for half, columns in ((0, ("name", "data", "data_source", "participant_id", "datetime")), (1, ("datetime", "participant_id", "data", "note", "data_source", "name"))):
        rows.where(F.col("half") == half).withColumn("note", F.lit("a, b")).select("folder", *columns).repartition("folder").write.mode("append").partitionBy("folder").option("header", True).option("escape", '"').csv(path)
    return path


@query("SELECT CAST(c_nationkey AS VARCHAR) AS participant_id, name, CAST(1704067200 + c_custkey * 60 AS BIGINT) * 1000000 AS start_us, round(c_acctbal, 6) AS value, 'folder=' || c_nationkey AS participant_dir FROM customer, (SELECT 'HeartRate' AS name) WHERE c_custkey % 10 > 1")
def export_records(spark, sf_dir):
    raw = export.read_raw(spark, export_tree(spark, sf_dir))
    out = export.parse_records(raw)
    return out.select("participant_id", "name", us("start_date", "start_us"), r6("value", "value"), parent(F.col("file")).alias("participant_dir"))


@query("SELECT 'folder=' || c_nationkey AS participant_dir, 'not a literal of records' AS reason, count(*) AS n FROM customer WHERE c_custkey % 10 = 0 GROUP BY ALL")
def export_rejects(spark, sf_dir):
    found = export.checked(export.read_tree(spark, export_tree(spark, sf_dir))).where("reason is not null")
    return found.groupBy(parent(F.col("file")).alias("participant_dir"), "reason").agg(F.count("*").alias("n"))


_BY_WINDOW = "SELECT CAST(c_nationkey AS VARCHAR) AS participant_id, ((1704067200 + c_custkey * 60) // 300) * 300000000 AS start_us, round(median(c_acctbal), 6) AS value FROM customer WHERE c_custkey % 10 > 1 GROUP BY ALL"


@query(_BY_WINDOW)
def etl_resumed(spark, sf_dir):
    """A run over the files, and a second that finds nothing new, which leaves the table as it is."""
    source, target = export_tree(spark, sf_dir), scratch(spark)
    for _ in range(2):
        run_etl(spark, source, target)
    rows = sinks.read_feature(spark, f"{target}/features", "HeartRate")
    return rows.select("participant_id", us("start_date", "start_us"), r6("value", "value"))


@query("SELECT 'folder=' || c_nationkey AS participant_dir, CAST(count(DISTINCT c_custkey % 2) AS BIGINT) AS files FROM customer GROUP BY c_nationkey")
def etl_log(spark, sf_dir):
    source, target = export_tree(spark, sf_dir), scratch(spark)
    run_etl(spark, source, target)
    log = sinks.read_log(spark, f"{target}/log")
    return log.groupBy(F.substring_index("filename", "/", 1).alias("participant_dir")).agg(F.count("*").alias("files"))


def _reports(spark, sf_dir) -> str:
    target = scratch(spark)
    files = table(spark, sf_dir, "documents").select(F.col("source").alias("participant_id"), F.col("n_chars").alias("length"))
    reports = run_statistics(records(spark, sf_dir), files)
    write_statistics({k: reports[k] for k in ("folder_sizes", "features_summary", "features_by_id", "activity_counts", "activity_durations", "active_devices", "counts_by_participant")}, target)
    return target


def _in_file_order(rows: DataFrame) -> DataFrame:
    """place: the row's number in its one file."""
    return rows.withColumn("place", F.monotonically_increasing_id())


@query("SELECT source AS participant_id, CAST(sum(n_chars) AS BIGINT) AS folder_size_bytes, row_number() OVER (ORDER BY sum(n_chars) DESC, source) - 1 AS place FROM documents GROUP BY source")
def report_folder_sizes(spark, sf_dir):
    return _in_file_order(spark.read.option("header", True).schema("participant_id string, folder_size_bytes long").csv(f"{_reports(spark, sf_dir)}/logfile_folder_sizes"))


@query(" SELECT name AS feature, count(DISTINCT participant_id) AS count, row_number() OVER (ORDER BY count(DISTINCT participant_id) DESC, name) - 1 AS place FROM rec GROUP BY name", rec=True)
def report_features_summary(spark, sf_dir):
    return _in_file_order(spark.read.option("header", True).schema("feature string, count long").csv(f"{_reports(spark, sf_dir)}/logfile_features_summary"))


@query(" SELECT date, " + ", ".join(f"count(*) FILTER (name = '{t}') AS \"{t}\"" for t in TYPES) + ", row_number() OVER (ORDER BY date) - 1 AS place FROM rec GROUP BY date", rec=True)
def report_activity_counts(spark, sf_dir):
    rows = spark.read.option("header", True).csv(f"{_reports(spark, sf_dir)}/logfile_activity_counts")
    return _in_file_order(rows.select(F.col("date").cast("date"), *[F.col(t).cast("long") for t in TYPES]))


@query(" SELECT CAST(participant_id AS BIGINT) AS participant_id, date, " + ", ".join(f"count(*) FILTER (name = '{t}') AS \"{t}\"" for t in TYPES) + " FROM rec GROUP BY participant_id, date", rec=True)
def report_counts_by_participant(spark, sf_dir):
    rows = spark.read.option("header", True).csv(f"{_reports(spark, sf_dir)}/logfile_counts_by_participant")
    return rows.select(F.col("participant_id").cast("long"), F.col("date").cast("date"), *[F.col(t).cast("long") for t in TYPES])


@query(f"{_SEG} SELECT participant_id, name, CAST(count(*) AS BIGINT) AS n FROM s JOIN g USING (participant_id, name, seg) WHERE last_us - first_us >= 18000000000 AND name = 'click' GROUP BY ALL", rec=True)
def series_written(spark, sf_dir):
    """Continuous rows of one feature, written twice; the second run replaces the first."""
    target = scratch(spark)
    rows = segments.continuous_rows(records(spark, sf_dir).where("name = 'click'"), "300min", **_WHEN)
    for _ in range(2):
        sinks.write_series(rows, target)
    return spark.read.schema(rows.schema).parquet(target).groupBy("participant_id", "name").agg(F.count("*").alias("n"))


# Sets ---------------------------------------------------------------------------------------------


@query("SELECT c_custkey AS id, c_name AS name, c_mktsegment AS segment, -1 AS nation FROM customer UNION ALL SELECT s_suppkey, s_name, NULL, s_nationkey FROM supplier")
def union_missing_cols(spark, sf_dir):
    c = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("id"), F.col("c_name").alias("name"), F.col("c_mktsegment").alias("segment"))
    s = table(spark, sf_dir, "supplier").select(F.col("s_suppkey").alias("id"), F.col("s_name").alias("name"), F.col("s_nationkey").alias("nation"))
    return reshape.union_all([c, s]).na.fill({"nation": -1})


@query("SELECT DISTINCT date FROM (SELECT CAST(ts AS DATE) AS date FROM events WHERE event_type = 'click' UNION SELECT CAST(ts AS DATE) FROM events WHERE event_type = 'view')")
def union_dates(spark, sf_dir):
    rec = records(spark, sf_dir)
    days = [rec.where(F.col("name") == t).select(F.col("datetime").alias("date")) for t in ("click", "view")]
    return reshape.union_all(days).distinct()


ORACLES["append_rededupe"] = ORACLES["window_distribute"].replace(", min(ord) AS first_ord", ", count(*) AS n")


def append_rededupe(spark, sf_dir):
    """Two loads split at a date, combined again from un-aggregated shares: equal to one pass over all."""
    rec = records(spark, sf_dir).drop("datetime", "props")
    early, late = rec.where("start_date < timestamp'2024-01-15'"), rec.where("start_date >= timestamp'2024-01-15'")
    shares = reshape.union_all([contributions(x, "5min", CUMULATIVE) for x in (early, late)])
    keys = ["participant_id", "name", "start_date", "end_date"]
    out = shares.groupBy(*keys).agg(F.median("value").alias("value"), F.count("*").alias("n"))
    return out.select("participant_id", "name", us("start_date", "start_us"), us("end_date", "end_us"), r6("value", "value"), "n")


QUERIES["append_rededupe"] = append_rededupe

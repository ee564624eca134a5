"""Scenarios with a rate for each stream, many rules, benchmark summaries, big-endian fields, watermarks."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import codecs
from ..operators import faults, percentile
from ..operators import stream_metrics as sm
from ..plans import scenario
from ..sources import events
from ..streaming import windows
from .files import temporary

HOUR, DAY = 3_600_000_000, events.DAY_US
DUR = float(events.DURATION_S)
#: Three hundred rules, more than one literal array holds.
MANY = [faults.Rule("delay", (None, "imu", "gps")[i % 3], i * 7200.0, 5400.0 + i, delay_ms=float(i)) for i in range(300)]
RATES = {"imu": 6 / 3600, "gps": 1 / 3600, "can": 2.5 / 3600}
STORY = scenario.Scenario(
    "two-rates", DUR, {"imu": RATES["imu"], "gps": RATES["gps"]}, (faults.Rule("burst_loss", "imu", 86_400.0, 172_800.0), faults.Rule("process_restart", "gps", 86_400.0, 86_400.0)),
    tuple(scenario.Assertion(*c) for c in (("imu_drop_rate_pct", "greater_than", 10.0), ("gps_drop_rate_pct", "less_than", 1.0), ("imu_received", "greater_than", 5.0), ("can_received", "equals", 0.0))),
)
LATE, WIDTH = 6 * HOUR, 12 * HOUR


def _frames(spark, sf):
    return events.frames(spark, sf).withColumn("t_s", (F.col("us") - events.START_US) / 1e6)


def fault_many_rules(spark, sf):
    """Frames cut to their hour, so that many are equal; each stays a row."""
    rows = events.frames(spark, sf).select("stream", (F.expr(f"(us - {events.START_US}) div {HOUR}") * 3600.0).alias("t_s"))
    counted = faults.with_active(rows, MANY).select("stream", F.size("active").cast("long").alias("n_rules"))
    return counted.groupBy("stream", "n_rules").agg(F.count(F.lit(1)).alias("n"))


def scenario_rates(spark, sf):
    return sm.stream_metrics(events.frames(spark, sf), RATES, DUR).select("stream", "received", "drop_rate_pct")


def scenario_run(spark, sf):
    return scenario.run(_frames(spark, sf), STORY, events.RATE_HZ)[1].select("scenario", "metric", "operator", "value", F.round("actual", 6).alias("actual"), "found", "passed")


def scenario_restarts(spark, sf):
    return scenario.restarts(_frames(spark, sf), STORY)


def bench_summary(spark, sf):
    samples = events.frames(spark, sf).select(F.col("stream").alias("name"), F.col("id").alias("pos"), F.floor(F.col("latency") * 1000).alias("ns"))
    return sm.bench_summary(samples)


def size_classes(spark, sf):
    sizes = F.array(*[F.lit(x) for x in (64, 1024, 65536, 1048576, 4194304, 7)])
    rows = events.frames(spark, sf).select(codecs.size_class(sizes[(F.col("id") % 6).cast("int")]).alias("size_class"))
    return rows.groupBy("size_class").agg(F.count(F.lit(1)).alias("n"))


def big_endian_fields(spark, sf):
    rows = events.frames(spark, sf).select("id", "us", F.concat(codecs.be_bytes(F.col("us"), 8), codecs.be_bytes(F.col("id"), 4), F.col("stream").cast("binary")).alias("raw"))
    size = F.octet_length("raw") - 12
    return rows.select("id", F.hex(F.substring("raw", 1, 12)).alias("hexed"), codecs.be_uint(F.col("raw"), 0, 8).alias("us"), codecs.be_uint(F.col("raw"), 8, 4).alias("back"), codecs.be_string(F.col("raw"), 12, size).alias("stream"), codecs.be_uint(F.col("raw"), 16, 8).alias("short"))


def arrival_order(spark, sf):
    """First and last as recorded, where every thirteenth frame arrives hours late."""
    late = F.when(F.col("id") % 13 == 0, F.col("us") + 5 * HOUR).otherwise(F.col("us"))
    rows = events.frames(spark, sf).withColumn("us", late)
    return sm.stream_metrics(rows, events.RATE_HZ, DUR, order="id").select("stream", "first_us", "last_us", "drop_rate_pct")


def watermark_counts(spark, sf):
    """The final windows of a streaming query over the events, run to its end and written as a table."""
    schema = "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string"
    stream = spark.readStream.schema(schema).option("pathGlobFilter", "events.parquet").parquet(sf)
    counts = windows.watermarked_counts(stream, "ts", "event_type", "12 hours", "6 hours")
    path = temporary(spark, "windows")
    query = counts.writeStream.outputMode("append").format("parquet").option("checkpointLocation", temporary(spark, "progress")).trigger(availableNow=True).start(path)
    query.awaitTermination()
    return spark.read.schema("event_type string, start_us bigint, n bigint").parquet(path)


D = lambda x: f"{x!r}e0" if "e" not in repr(x) else repr(x)
_RATE = "CASE stream " + " ".join(f"WHEN '{k}' THEN {D(v)}" for k, v in RATES.items()) + " ELSE 0e0 END"
_DROP = f"CASE WHEN n >= 2 AND w > 0 THEN CASE WHEN r * w > 0 THEN 100e0 * greatest(0e0, r * w - (n - 1)) / (r * w) ELSE 0e0 END WHEN r > 0 THEN 100e0 * greatest(0e0, r * {D(DUR)} - n) / (r * {D(DUR)}) ELSE 0e0 END"
_T = f"{events.SQL}, f AS (SELECT *, (us - {events.START_US}) / 1e6 AS t_s FROM frames)"
_RUN = f"{_T}, k AS (SELECT * FROM f WHERE stream = 'gps' OR (stream = 'imu' AND NOT (t_s >= 86400 AND t_s < 259200))), b AS (SELECT stream, n, round({_DROP}, 6) AS d FROM (SELECT stream, count(*) AS n, (max(us) - min(us)) / 1e6 AS w, {_RATE} AS r FROM k GROUP BY stream)), m AS (SELECT stream || '_drop_rate_pct' AS metric, d AS actual FROM b UNION ALL SELECT stream || '_received', CAST(n AS DOUBLE) FROM b)"
_CHECKS = ", ".join(f"('{a.metric}', '{a.operator}', {D(a.value)})" for a in STORY.assertions)
_SAMPLES = f"{events.SQL}, s AS (SELECT stream AS name, floor(latency * 1000) AS ns, row_number() OVER (PARTITION BY stream ORDER BY id) - 1 AS i, count(*) OVER (PARTITION BY stream) AS total FROM frames), k AS (SELECT name, CAST(ns AS DOUBLE) AS ns FROM s WHERE i >= floor(total * 0.1e0))"

SQL = {
    "fault_many_rules": f"{events.SQL}, f AS (SELECT id, stream, ((us - {events.START_US}) // {HOUR}) * 3600e0 AS t_s FROM frames), {faults.rules_sql(MANY)}, a AS (SELECT f.id, any_value(f.stream) AS stream, count(rule_id) AS n_rules FROM f LEFT JOIN rules r ON (r.stream IS NULL OR r.stream = f.stream) AND t_s >= start_s AND t_s < start_s + duration_s GROUP BY f.id) SELECT stream, n_rules, count(*) AS n FROM a GROUP BY ALL",
    "scenario_rates": f"{events.SQL} SELECT stream, n AS received, round({_DROP}, 6) AS drop_rate_pct FROM (SELECT stream, count(*) AS n, (max(us) - min(us)) / 1e6 AS w, {_RATE} AS r FROM frames GROUP BY stream)",
    "scenario_run": f"{_RUN} SELECT 'two-rates' AS scenario, a.metric, a.operator, a.value, round(coalesce(actual, 0e0), 6) AS actual, actual IS NOT NULL AS found, actual IS NOT NULL AND CASE a.operator WHEN 'less_than' THEN actual < a.value WHEN 'greater_than' THEN actual > a.value ELSE abs(actual - a.value) <= 1e-9 END AS passed FROM (VALUES {_CHECKS}) a(metric, operator, value) LEFT JOIN m USING (metric)",
    "scenario_restarts": f"{_T} SELECT 'gps' AS stream, min(id) AS id FROM f WHERE stream = 'gps' AND t_s >= 86400 AND t_s < 172800 HAVING count(*) > 0",
    "bench_summary": f"{_SAMPLES}, p AS ({percentile.percentiles_sql('k', 'name', 'ns', sm.PERCENTILES)}) SELECT name, iterations, p50, p99, p999, round(CASE WHEN total > 0 THEN iterations * 1e9 / total ELSE 0e0 END, 6) AS msgs_per_sec FROM p JOIN (SELECT name, count(*) AS iterations, sum(ns) AS total FROM k GROUP BY name) USING (name)",
    "size_classes": f"{events.SQL} SELECT CASE id % 6 WHEN 0 THEN '64b' WHEN 1 THEN '1kb' WHEN 2 THEN '64kb' WHEN 3 THEN '1mb' WHEN 4 THEN '4mb' ELSE '?' END AS size_class, count(*) AS n FROM frames GROUP BY 1",
    "big_endian_fields": f"{events.SQL} SELECT id, printf('%016X', us) || printf('%08X', id) AS hexed, us, id AS back, stream, CAST(NULL AS BIGINT) AS short FROM frames",
    "arrival_order": f"{events.SQL}, l AS (SELECT stream, id, CASE WHEN id % 13 = 0 THEN us + {5 * HOUR} ELSE us END AS us FROM frames) SELECT stream, first_us, last_us, round({_DROP}, 6) AS drop_rate_pct FROM (SELECT *, (last_us - first_us) / 1e6 AS w, {D(events.RATE_HZ)} AS r FROM (SELECT stream, count(*) AS n, arg_min(us, id) AS first_us, arg_max(us, id) AS last_us FROM l GROUP BY stream))",
    "watermark_counts": f"{events.SQL}, c AS (SELECT event_type, epoch_us(ts) // {WIDTH} * {WIDTH} AS start_us, count(*) AS n FROM events GROUP BY ALL) SELECT * FROM c WHERE start_us + {WIDTH} <= (SELECT (max(us) - {LATE}) // 1000 * 1000 FROM frames)",
}
QUERIES = {f.__name__: f for f in (fault_many_rules, scenario_rates, scenario_run, scenario_restarts, bench_summary, size_classes, big_endian_fields, arrival_order, watermark_counts)}

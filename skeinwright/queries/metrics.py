"""Metrics, assertions, roll-ups, reports and windows."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import ordered, percentile
from ..operators import stream_metrics as sm
from ..plans import report, scenario
from ..sources import events

HOUR = 3_600_000_000
DUR, RATE = events.DURATION_S, events.RATE_HZ
BOUNDS = [1.0, 2.0, 5.0, 10.0, 20.0, 50.0, 100.0, 200.0, 500.0]
CHECKS = [("imu_latency_p99_ms", "less_than", 150.0), ("gps_drop_rate_pct", "greater_than", 0.0), ("can_sequence_gaps", "equals", 0.0), ("camera_received", "not_equals", 0.0), ("radar_received", "less_than", 1.0)]
SCENARIO = scenario.Scenario("month", float(DUR), {}, (), tuple(scenario.Assertion(*c) for c in CHECKS))


def _metrics(spark, sf):
    return sm.stream_metrics(events.frames(spark, sf), RATE, DUR)


def _long(spark, sf):
    return sm.unpivot(_metrics(spark, sf))


def _evaluated(spark, sf):
    return scenario.evaluate(scenario.assertions_table(spark, [SCENARIO]), _long(spark, sf))


def _report(spark, sf):
    return report.build(events.frames(spark, sf).select("stream").distinct(), _long(spark, sf))


def stream_metrics(spark, sf):
    return _metrics(spark, sf)


def latency_percentiles(spark, sf):
    return percentile.exact_percentiles(events.frames(spark, sf), "stream", "latency", sm.PERCENTILES)


def drop_rate(spark, sf):
    base = events.frames(spark, sf).groupBy("stream").agg(F.count(F.lit(1)).alias("n"), ((F.max("us") - F.min("us")) / 1e6).alias("w"))
    return base.select("stream", F.round(sm.drop_rate(F.col("n"), F.col("w"), RATE, DUR), 6).alias("drop_rate_pct"))


def sequence_gaps(spark, sf):
    return ordered.sequence_gaps(events.frames(spark, sf), "stream", "id", "id", F.floor(F.col("id") / 4096))


def metric_unpivot(spark, sf):
    return _long(spark, sf)


def latency_histogram(spark, sf):
    rows = sm.histogram(events.frames(spark, sf), BOUNDS)
    return rows.select("stream", F.when(F.col("le") == float("inf"), "+Inf").otherwise(F.col("le").cast("int").cast("string")).alias("le"), "n")


def scenario_assertions(spark, sf):
    return _evaluated(spark, sf).drop("pos")


def scenario_result(spark, sf):
    return scenario.verdicts(spark.createDataFrame([("month",)], "scenario string"), _evaluated(spark, sf))


def parallel_rollup(spark, sf):
    frames = events.frames(spark, sf).withColumn("scenario", F.concat(F.lit("run"), (F.col("id") % 4).cast("string")))
    base = frames.groupBy("scenario").agg(F.count(F.lit(1)).cast("double").alias("received"))
    ranks = percentile.exact_percentiles(frames, "scenario", "latency", {"p99": 0.99})
    long = base.join(ranks, "scenario").select("scenario", F.expr("stack(2, 'received', received, 'p99', p99) as (metric, value)"))
    rules = [(f"run{i}", i, m, op, v) for i in range(4) for m, op, v in (("received", "greater_than", 0.0), ("p99", "less_than", 60.0 + 20 * i))]
    checks = spark.createDataFrame(rules, scenario.ASSERTIONS)
    names = base.select("scenario")
    return scenario.roll_up(scenario.verdicts(names, scenario.evaluate(checks, long, ("scenario", "metric"))))


def scenario_matrix(spark, sf):
    names = spark.createDataFrame([("a", 0), ("b", 1), ("c", 2)], "scenario string, pos int")
    return scenario.matrix(names, 4, 9100)


def report_build(spark, sf):
    return _report(spark, sf)


def report_html_rows(spark, sf):
    return report.bars(_report(spark, sf)).drop("p99_text")


def report_json(spark, sf):
    return report.to_json(_report(spark, sf), _evaluated(spark, sf), "month", "2024-01-31T00:00:00Z", DUR)


def _reports(spark, sf):
    """Four weekly reports, written as files and read back."""
    from .files import temporary

    days = events.frames(spark, sf).withColumn("week", F.floor((F.col("us") - events.START_US) / (7 * events.DAY_US)))
    ranks = percentile.exact_percentiles(days.withColumn("g", F.concat_ws("|", "week", "stream")), "g", "latency", sm.PERCENTILES)
    entry = F.struct(F.split("g", r"\|")[1].alias("key"), F.struct(F.col("p99").alias("latency_p99_ms")).alias("value"))
    week = F.split("g", r"\|")[0]
    rows = ranks.groupBy(week.alias("week")).agg(F.map_from_entries(F.collect_list(entry)).alias("per_sensor"), F.max("p99").alias("top"))
    whole = F.struct(F.concat(F.lit("week"), "week").alias("scenario"), F.when(F.col("top") < 400, "PASS").otherwise("FAIL").alias("result"), F.struct("per_sensor").alias("metrics"))
    folder = temporary(spark, "reports")
    rows.select("week", F.to_json(whole).alias("value")).repartition("week").write.partitionBy("week").text(folder)
    return report.scan(spark, f"{folder}/*")


def report_scan(spark, sf):
    return _reports(spark, sf).select("scenario", "result", F.size("metrics.per_sensor").alias("sensors"))


def report_summary(spark, sf):
    return report.summary(_reports(spark, sf))


def latest_per_sensor(spark, sf):
    return report.latest_per_sensor(_reports(spark, sf), "scenario")


def topk_latency(spark, sf):
    return events.frames(spark, sf).select("id", "stream", "latency").orderBy(F.desc("latency"), "id").limit(20)


def set_ops(spark, sf):
    hours = lambda s: events.frames(spark, sf, streams=(s,)).select(F.expr(f"us div {HOUR}").alias("hour"))
    both = hours("camera").intersect(hours("lidar")).select("hour", F.lit("both").alias("part"))
    return both.unionByName(hours("camera").subtract(hours("lidar")).select("hour", F.lit("camera_only").alias("part")))


def tumbling_rate(spark, sf):
    return events.frames(spark, sf).groupBy("stream", (F.expr(f"us div {6 * HOUR}") * (6 * HOUR)).alias("start_us")).agg(F.count(F.lit(1)).alias("n"))


def sliding_rate(spark, sf):
    rows = events.frames(spark, sf).select("stream", F.timestamp_micros("us").alias("t"))
    found = rows.groupBy("stream", F.window("t", "6 hours", "1 hour").alias("w")).agg(F.count(F.lit(1)).alias("n"))
    return found.select("stream", F.unix_micros("w.start").alias("start_us"), "n")


def session_activity(spark, sf):
    return ordered.sessions(events.frames(spark, sf), "stream", "us", HOUR)


def asof_align(spark, sf):
    of = lambda s: events.frames(spark, sf, streams=(s,)).withColumn("link", F.lit(0))
    left = of("camera").select("link", "us", "id")
    right = of("gps").select("link", "us", F.col("latency").alias("gps_latency"))
    return ordered.as_of(left, right, "link", "us", "gps_latency", "gps_latency", 24 * HOUR).select("id", "us", "gps_latency")


def live_gauges(spark, sf):
    """The received counts as a streaming query leaves them, run to its end."""
    schema = "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string"
    stream = spark.readStream.schema(schema).option("pathGlobFilter", "events.parquet").parquet(sf)
    gauges = stream.groupBy("event_type").agg(F.count(F.lit(1)).alias("received"), F.max("value").alias("max_latency"))
    name = "skeinwright_live_gauges"
    query = gauges.writeStream.outputMode("complete").format("memory").queryName(name).trigger(availableNow=True).start()
    query.awaitTermination()
    return spark.table(name)


D = lambda x: f"{x!r}e0" if "e" not in repr(x) else repr(x)
PCT = percentile.percentiles_sql("frames", "stream", "latency", sm.PERCENTILES)
_DROP = (
    f"round(CASE WHEN n >= 2 AND w > 0 THEN 100e0 * greatest(0e0, {D(RATE)} * w - (n - 1)) / ({D(RATE)} * w)"
    f" ELSE 100e0 * greatest(0e0, {D(RATE * DUR)} - n) / {D(RATE * DUR)} END, 6)"
)
_BASE = f"b AS (SELECT stream, received, round(received / {D(float(DUR))}, 9) AS msgs_per_sec, first_us, last_us, {_DROP} AS drop_rate_pct FROM (SELECT stream, count(*) AS received, count(*) AS n, min(us) AS first_us, max(us) AS last_us, (max(us) - min(us)) / 1e6 AS w FROM frames GROUP BY stream))"
_GAPS = "g AS (SELECT stream, CAST(sum(CASE WHEN id % 65536 <> (p + 1) % 65536 THEN 1 ELSE 0 END) AS BIGINT) AS gaps FROM (SELECT stream, id, lag(id) OVER (PARTITION BY stream ORDER BY id) AS p FROM frames) GROUP BY stream)"
METRICS_SQL = f"{events.SQL}, {_BASE}, {_GAPS}, p AS ({PCT}), sm AS (SELECT b.*, p50, p99, p999, gaps AS sequence_gaps FROM b JOIN p USING (stream) JOIN g USING (stream))"
LONG_SQL = f"{METRICS_SQL}, m AS (" + " UNION ALL ".join(f"SELECT stream || '_{k}' AS metric, CAST({c} AS DOUBLE) AS value FROM sm" for k, c in sm.METRICS.items()) + ")"
_VALUES = ", ".join(f"('{m}', '{op}', {D(v)})" for m, op, v in CHECKS)
_HOLDS = "CASE operator WHEN 'less_than' THEN actual < value WHEN 'greater_than' THEN actual > value WHEN 'equals' THEN abs(actual - value) <= 1e-9 ELSE abs(actual - value) > 1e-9 END"
CHECK_SQL = f"{LONG_SQL}, e AS (SELECT scenario, metric, operator, value, actual, found, found AND {_HOLDS} AS passed FROM (SELECT 'month' AS scenario, a.metric, a.operator, a.value, coalesce(m.value, 0e0) AS actual, m.value IS NOT NULL AS found FROM (VALUES {_VALUES}) a(metric, operator, value) LEFT JOIN m USING (metric)))"
REPORT_SQL = f"{METRICS_SQL}, r AS (SELECT stream, msgs_per_sec AS msgs_sec, drop_rate_pct, p50 AS latency_p50_ms, p99 AS latency_p99_ms, p999 AS latency_p999_ms, sequence_gaps, received FROM sm)"
_ROLL_PCT = percentile.percentiles_sql("f4", "scenario", "latency", {"p99": 0.99})

_WEEKS = f"{events.SQL}, w AS (SELECT (us - {events.START_US}) // {7 * events.DAY_US} AS week, stream, latency, (us - {events.START_US}) // {7 * events.DAY_US} || '|' || stream AS g FROM frames), p AS ({percentile.percentiles_sql('w', 'g', 'latency', {'p99': 0.99})})"

SQL = {
    "stream_metrics": f"{METRICS_SQL} SELECT * FROM sm",
    "latency_percentiles": f"{events.SQL} {PCT}",
    "drop_rate": f"{events.SQL}, {_BASE} SELECT stream, drop_rate_pct FROM b",
    "sequence_gaps": f"{events.SQL}, {_GAPS} SELECT * FROM g",
    "metric_unpivot": f"{LONG_SQL} SELECT * FROM m",
    "latency_histogram": f"{events.SQL} SELECT stream, le, count(*) AS n FROM (SELECT stream, CASE " + " ".join(f"WHEN latency <= {D(b)} THEN '{int(b)}'" for b in BOUNDS) + " ELSE '+Inf' END AS le FROM frames) GROUP BY stream, le",
    "scenario_assertions": f"{CHECK_SQL} SELECT * FROM e",
    "scenario_result": f"{CHECK_SQL} SELECT 'month' AS scenario, bool_and(passed) AS passed, count(*) AS n_assertions, count(*) FILTER (passed) AS n_passed FROM e",
    "parallel_rollup": f"{events.SQL}, f4 AS (SELECT 'run' || (id % 4) AS scenario, latency FROM frames), p AS ({_ROLL_PCT}), v AS (SELECT scenario, p99 < 60e0 + 20e0 * CAST(scenario[4:] AS INT) AS ok FROM p) SELECT count(*) AS total_scenarios, count(*) FILTER (ok) AS scenarios_passed, count(*) FILTER (NOT ok) AS scenarios_failed, 2 * count(*) AS total_assertions, count(*) + count(*) FILTER (ok) AS assertions_passed, bool_and(ok) AS all_passed FROM v",
    "scenario_matrix": "SELECT s.name AS scenario, k * 3 + pos AS run_index, '/scenario_' || (k * 3 + pos) AS namespace, 9100 + k * 3 + pos AS metrics_port FROM (VALUES ('a', CAST(0 AS BIGINT)), ('b', 1), ('c', 2)) s(name, pos), range(4) t(k)",
    "report_build": f"{REPORT_SQL} SELECT * FROM r",
    "report_html_rows": f"{REPORT_SQL} SELECT stream, CAST(floor(100e0 * latency_p99_ms / greatest(max(latency_p99_ms) OVER (), 1e0)) AS BIGINT) AS bar_width FROM r",
    "latest_per_sensor": f"{_WEEKS} SELECT split_part(g, '|', 2) AS sensor, max_by(p99, split_part(g, '|', 1)) AS latency_p99_ms FROM p GROUP BY 1",
    "report_scan": f"{_WEEKS}, r AS (SELECT 'week' || split_part(g, '|', 1) AS scenario, CASE WHEN max(p99) < 400 THEN 'PASS' ELSE 'FAIL' END AS result, CAST(count(*) AS INT) AS sensors FROM p GROUP BY 1) SELECT * FROM r",
    "report_summary": f"{_WEEKS}, r AS (SELECT max(p99) < 400 AS ok FROM p GROUP BY split_part(g, '|', 1)) SELECT count(*) FILTER (ok) AS passed, count(*) FILTER (NOT ok) AS failed FROM r",
    "live_gauges": "SELECT event_type, count(*) AS received, max(value) AS max_latency FROM events GROUP BY 1",
    "topk_latency": f"{events.SQL} SELECT id, stream, latency FROM frames ORDER BY latency DESC, id LIMIT 20",
    "set_ops": f"{events.SQL}, c AS (SELECT DISTINCT us // {HOUR} AS hour FROM frames WHERE stream = 'camera'), l AS (SELECT DISTINCT us // {HOUR} AS hour FROM frames WHERE stream = 'lidar') SELECT hour, 'both' AS part FROM (SELECT * FROM c INTERSECT SELECT * FROM l) UNION ALL SELECT hour, 'camera_only' AS part FROM (SELECT * FROM c EXCEPT SELECT * FROM l)",
    "tumbling_rate": f"{events.SQL} SELECT stream, us // {6 * HOUR} * {6 * HOUR} AS start_us, count(*) AS n FROM frames GROUP BY ALL",
    "sliding_rate": f"{events.SQL} SELECT stream, (us // {HOUR} - k) * {HOUR} AS start_us, count(*) AS n FROM frames, range(6) t(k) GROUP BY ALL",
    "session_activity": f"{events.SQL}, s AS (SELECT stream, us, sum(brk) OVER (PARTITION BY stream ORDER BY us, id) AS sid FROM (SELECT stream, us, id, CASE WHEN us - lag(us) OVER (PARTITION BY stream ORDER BY us, id) < {HOUR} THEN 0 ELSE 1 END AS brk FROM frames)) SELECT stream, min(us) AS start_us, max(us) AS end_us, count(*) AS n FROM s GROUP BY stream, sid",
    "asof_align": f"{events.SQL} SELECT l.id, l.us, r.latency AS gps_latency FROM (SELECT * FROM frames WHERE stream = 'camera') l ASOF LEFT JOIN (SELECT * FROM frames WHERE stream = 'gps') r ON l.us >= r.us",
}
QUERIES = {f.__name__: f for f in (stream_metrics, latency_percentiles, drop_rate, sequence_gaps, metric_unpivot, latency_histogram, scenario_assertions, scenario_result, parallel_rollup, scenario_matrix, report_build, report_html_rows, report_json, report_scan, report_summary, latest_per_sensor, topk_latency, set_ops, tumbling_rate, sliding_rate, session_activity, asof_align, live_gauges)}

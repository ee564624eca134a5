"""Reports: built from metrics, as JSON rows, as one HTML page, and read back."""

from __future__ import annotations

import html

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Fields of a sensor's report (fixed values), the metric of each, and its type.
FIELDS = {"msgs_sec": ("msgs_per_sec", "double"), "drop_rate_pct": ("drop_rate_pct", "double"), "latency_p50_ms": ("latency_p50_ms", "double"), "latency_p99_ms": ("latency_p99_ms", "double"), "latency_p999_ms": ("latency_p999_ms", "double"), "sequence_gaps": ("sequence_gaps", "long"), "received": ("received", "long")}


def build(streams: DataFrame, metrics: DataFrame) -> DataFrame:
    """One row for each of ``streams`` (stream): its fields from long metrics (metric, value), 0 if missing."""
    names = [m for m, _ in FIELDS.values()]
    pattern = "^(.*)_(" + "|".join(names) + ")$"
    split = metrics.select(F.regexp_extract("metric", pattern, 1).alias("s"), F.regexp_extract("metric", pattern, 2).alias("m"), "value")
    wide = split.groupBy("s").pivot("m", names).agg(F.first("value"))
    joined = streams.join(wide, F.col("stream") == F.col("s"), "left")
    return joined.select("stream", *[F.coalesce(F.col(m), F.lit(0.0)).cast(kind).alias(f) for f, (m, kind) in FIELDS.items()])


def bars(report: DataFrame) -> DataFrame:
    """(stream, p99 text, bar width in percent of the largest p99, 1 at least)."""
    top = report.agg(F.greatest(F.max("latency_p99_ms"), F.lit(1.0)).alias("top"))
    # one row
    both = report.join(F.broadcast(top))
    return both.select("stream", F.format_string("%.3f", "latency_p99_ms").alias("p99_text"), F.floor(100.0 * F.col("latency_p99_ms") / F.col("top")).cast("long").alias("bar_width"))


def to_json(report: DataFrame, evaluated: DataFrame, name: str, timestamp: str, duration_s: float) -> DataFrame:
    """One row (scenario, json), keys in alphabetical order."""
    sensors = report.select(F.struct("stream", F.struct(*[F.col(f) for f in sorted(FIELDS)])).alias("e")).agg(F.map_from_entries(F.array_sort(F.collect_list("e"))).alias("per_sensor"))
    verdict = lambda ok: F.when(ok, "PASS").otherwise("FAIL")
    one = F.struct("pos", F.struct("actual", "found", "metric", "operator", verdict(F.col("passed")).alias("result"), F.col("value").alias("threshold")).alias("a"))
    checks = evaluated.agg(F.array_sort(F.collect_list(one)).alias("rows"), F.coalesce(F.bool_and("passed"), F.lit(True)).alias("ok"))
    zero = F.lit(0)
    transport = F.struct(F.lit(0.0).alias("bytes_sec"), zero.alias("crc_failures"), zero.alias("retransmits"), zero.alias("sequence_gaps"))
    # both sides are one row
    joined = sensors.join(F.broadcast(checks))
    whole = F.struct(
        F.transform("rows", lambda x: x["a"]).alias("assertions"), F.lit(float(duration_s)).alias("duration_seconds"),
        F.struct("per_sensor", transport.alias("transport")).alias("metrics"), F.lit(0.0).alias("replay_recovery_ms"),
        verdict(F.col("ok")).alias("result"), F.lit(name).alias("scenario"), F.lit(timestamp).alias("timestamp"),
    )
    return joined.select(F.lit(name).alias("scenario"), F.to_json(whole).alias("json"))


SCHEMA = "scenario string, timestamp string, duration_seconds double, result string, assertions array<struct<metric:string,operator:string,threshold:double,actual:double,found:boolean,result:string>>, metrics struct<per_sensor:map<string,struct<msgs_sec:double,drop_rate_pct:double,latency_p50_ms:double,latency_p99_ms:double,latency_p999_ms:double,sequence_gaps:bigint,received:bigint>>>"


def scan(spark: SparkSession, folder: str) -> DataFrame:
    """Reports of a folder with their paths; what isn't one is skipped."""
    rows = spark.read.schema(SCHEMA).option("multiLine", True).option("mode", "DROPMALFORMED").json(folder)
    return rows.select("*", F.col("_metadata.file_path").alias("path")).filter("scenario is not null")


def summary(reports: DataFrame) -> DataFrame:
    return reports.agg(F.count_if(F.col("result") == "PASS").alias("passed"), F.count_if(F.col("result") != "PASS").alias("failed"))


def latest_per_sensor(reports: DataFrame, order: str = "path") -> DataFrame:
    """(sensor, p99) of the last report, in path order, that has the sensor."""
    rows = reports.select(order, F.explode("metrics.per_sensor").alias("sensor", "m"))
    return rows.groupBy("sensor").agg(F.max_by("m.latency_p99_ms", order).alias("latency_p99_ms"))


def to_html(report: DataFrame, evaluated: DataFrame, name: str) -> str:
    """A page without scripts or outside references; both tables are short."""
    cell = lambda x: f"<td>{html.escape(str(x), quote=True).replace('&#x27;', chr(39))}</td>"
    checks = "".join(
        "<tr>" + cell(r.metric) + cell(r.operator) + cell(f"{r.value:.3f}") + cell(f"{r.actual:.3f}" if r.found else "—") + cell("PASS" if r.passed else "FAIL") + "</tr>"
        for r in evaluated.orderBy("pos").collect()
    )
    lines = "".join(
        "<tr>" + cell(r.stream) + cell(r.p99_text) + f'<td><div style="background:#47a;height:1em;width:{r.bar_width}%"></div></td></tr>'
        for r in bars(report).orderBy("stream").collect()
    )
    return f"<!DOCTYPE html><html><head><meta charset='utf-8'><title>{html.escape(name)}</title></head><body><h1>{html.escape(name)}</h1><table>{checks}</table><table>{lines}</table></body></html>"

"""Metric expositions and benchmark logs as text: rendered, parsed and looked up."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: What a sample line and a label look like (fixed values).
SAMPLE = r"^([a-zA-Z_:][a-zA-Z0-9_:]*)(?:\{([^}]*)\})?\s+(.+)$"
LABEL = r'(\w+)="((?:[^"\\]|\\.)*)"'
BENCH = r"^\[BENCH\]\s+(\S+)\s+(.+)$"
PAIR = r"(\w+/?\w*)=([0-9.eE+-]+)"


def parse_exposition(lines: DataFrame, line: str = "line") -> DataFrame:
    """Adds name, labels and value to lines that are samples; others go."""
    text = F.trim(F.col(line))
    rows = lines.withColumn("_t", text).filter((F.col("_t") != "") & ~F.col("_t").startswith("#") & F.col("_t").rlike(SAMPLE))
    inner = F.regexp_extract("_t", SAMPLE, 2)
    labels = F.map_from_entries(
        F.filter(
            F.arrays_zip(F.regexp_extract_all(inner, F.lit(LABEL), F.lit(1)).alias("k"), F.regexp_extract_all(inner, F.lit(LABEL), F.lit(2)).alias("v")),
            lambda x: x["k"].isNotNull(),
        )
    )
    value = F.split(F.regexp_extract("_t", SAMPLE, 3), r"\s+")[0].try_cast("double")
    return rows.select(*lines.columns, F.regexp_extract("_t", SAMPLE, 1).alias("name"), labels.alias("labels"), value.alias("value")).filter("value is not null")


def sensor_values(samples: DataFrame, name: str, order: str) -> DataFrame:
    """(sensor, value): of each sensor the last sample of a family."""
    mine = samples.filter((F.col("name") == name) & F.col("labels")["sensor"].isNotNull())
    return mine.groupBy(F.col("labels")["sensor"].alias("sensor")).agg(F.max_by("value", order).alias("value"))


def scalar(samples: DataFrame, name: str, order: str, default: float = 0.0) -> DataFrame:
    """The first sample's value, or the default."""
    return samples.filter(F.col("name") == name).agg(F.coalesce(F.min_by("value", order), F.lit(default)).alias("value"))


def registry(updates: DataFrame) -> DataFrame:
    """(name, labels, value) after updates (pos, op, name, labels string, value): a gauge keeps the last, a
    counter the sum."""
    last = F.max_by("value", "pos")
    return updates.groupBy("op", "name", "labels").agg(F.when(F.col("op") == "gauge", last).otherwise(F.sum("value")).alias("value"))


def escape(value: Column) -> Column:
    """Label text: backslash and quote get a backslash, a newline becomes \\n."""
    return F.replace(F.replace(F.replace(value, F.lit("\\"), F.lit("\\\\")), F.lit('"'), F.lit('\\"')), F.lit("\n"), F.lit("\\n"))


def six_digits(value: Column) -> Column:
    """A number with six significant digits, without trailing zeros, as C++ streams show it."""
    size = F.floor(F.log10(F.abs(value))).cast("int")
    plain = F.when(value == 0, F.lit("0")).otherwise(
        F.regexp_replace(
            F.regexp_replace(F.format_string("%.10f", F.round(value * F.pow(F.lit(10.0), (F.lit(5) - size).cast("double"))) / F.pow(F.lit(10.0), (F.lit(5) - size).cast("double"))), r"(\.\d*?)0+$", "$1"), r"\.$", ""
        )
    )
    mantissa = F.format_string("%.5f", value / F.pow(F.lit(10.0), size.cast("double")))
    exponent = F.concat(F.when(size < 0, "-").otherwise("+"), F.lpad(F.abs(size).cast("string"), 2, "0"))
    science = F.concat(F.regexp_replace(F.regexp_replace(mantissa, r"(\.\d*?)0+$", "$1"), r"\.$", ""), F.lit("e"), exponent)
    return F.when((value != 0) & ((size >= 6) | (size < -4)), science).otherwise(plain)


def whole_in_full(value: Column) -> Column:
    """A whole number below 2^63 with all its digits, any other number with six significant ones; null stays null."""
    whole = value.try_cast("bigint")
    return F.when((F.abs(value) < 2.0**63) & (whole.cast("double") == value), whole.cast("string")).when(value.isNotNull(), six_digits(value))


def render(series: DataFrame, kinds: dict[str, str] | None = None, helps: dict[str, str] | None = None, number: Callable[[Column], Column] = six_digits) -> DataFrame:
    """(name, text) for each family of (name, labels map, value): its TYPE line and its series, by labels.
    ``number`` shows a value; six digits lose the last ones of counts and ids from 1,000,000 on."""
    shown = F.array_join(F.transform(F.array_sort(F.map_entries("labels")), lambda e: F.concat(e["key"], F.lit('="'), escape(e["value"]), F.lit('"'))), ",")
    key = F.array_join(F.transform(F.array_sort(F.map_entries("labels")), lambda e: F.concat(e["key"], F.lit("="), e["value"], F.lit(";"))), "")
    line = F.concat(F.col("name"), F.when(F.size("labels") > 0, F.concat(F.lit("{"), shown, F.lit("}"))).otherwise(""), F.lit(" "), number(F.col("value")))
    kind = F.coalesce(F.create_map(*[F.lit(x) for kv in (kinds or {"": ""}).items() for x in kv])[F.col("name")], F.lit("gauge"))
    told = F.create_map(*[F.lit(x) for kv in (helps or {"": ""}).items() for x in kv])[F.col("name")]
    head = F.concat(F.coalesce(F.concat(F.lit("# HELP "), F.col("name"), F.lit(" "), told, F.lit("\n")), F.lit("")), F.lit("# TYPE "), F.col("name"), F.lit(" "), kind)
    lines = F.transform(F.array_sort(F.collect_list(F.struct(key.alias("k"), line.alias("l")))), lambda x: x["l"])
    return series.groupBy("name").agg(lines.alias("lines")).select("name", F.array_join(F.concat(F.array(head), F.col("lines")), "\n").alias("text"))


def parse_bench(lines: DataFrame, line: str = "line", order: str = "pos") -> DataFrame:
    """(name, field, value) of benchmark lines; of lines with one name the last counts."""
    rows = lines.withColumn("_t", F.trim(F.col(line))).filter(F.col("_t").rlike(BENCH))
    rows = rows.select(F.regexp_extract("_t", BENCH, 1).alias("name"), F.regexp_extract("_t", BENCH, 2).alias("rest"), F.col(order).alias("o"))
    last = rows.groupBy("name").agg(F.max_by("rest", "o").alias("rest"))
    pairs = F.arrays_zip(F.regexp_extract_all("rest", F.lit(PAIR), F.lit(1)).alias("k"), F.regexp_extract_all("rest", F.lit(PAIR), F.lit(2)).alias("v"))
    return last.select("name", F.explode(pairs).alias("p")).select("name", F.replace("p.k", F.lit("/"), F.lit("_")).alias("field"), F.col("p.v").cast("double").alias("value"))


def gate(current: DataFrame, baseline: DataFrame, p99_pct: float = 10.0, rate_pct: float = 5.0, drop_points: float = 0.1) -> DataFrame:
    """(name, field, baseline, current, delta, verdict): NEW without a baseline; a p99 or a drop rate that
    rises too far fails, a rate that falls too far warns. Vanished baselines are silent."""
    base = baseline.withColumnsRenamed({"name": "bn", "field": "bf", "value": "base"})
    known = baseline.select(F.col("name").alias("kn")).distinct()
    fresh = current.select("name").distinct().join(known, F.col("name") == F.col("kn"), "left_anti")
    fresh = fresh.select("name", F.lit("-").alias("field"), *[F.lit(None).cast("double").alias(c) for c in ("baseline", "current", "delta")], F.lit("NEW").alias("verdict"))
    both = current.join(base, (F.col("name") == F.col("bn")) & (F.col("field") == F.col("bf")))
    cur, old = F.col("value"), F.col("base")
    relative = 100.0 * (cur - old) / old
    p99 = F.when(cur > old * (1 + p99_pct / 100.0), "FAIL").otherwise("ok")
    rate = F.when(cur < old * (1 - rate_pct / 100.0), "WARN").otherwise("ok")
    drop = F.when(cur - old > drop_points, "FAIL").otherwise("ok")
    is_ = lambda f: F.col("field") == f
    gated = both.filter((is_("p99") & (old > 0)) | (is_("msgs_sec") & (old > 0)) | is_("drop_rate_pct"))
    verdict = F.when(is_("p99"), p99).when(is_("msgs_sec"), rate).otherwise(drop)
    delta = F.when(is_("drop_rate_pct"), cur - old).otherwise(relative)
    return fresh.unionByName(gated.select("name", "field", old.alias("baseline"), cur.alias("current"), delta.alias("delta"), verdict.alias("verdict")))

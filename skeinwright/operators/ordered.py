"""Operators over rows in order: lag across slices, sequence numbers, gaps, replay, as-of.

Streams are few and long, so an order is cut into slices of time; what a slice needs of the one before
is carried by one row a slice.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def sequence_gaps(df: DataFrame, group: str, order: str, sequence: str, slice_: Column, modulus: int = 65536) -> DataFrame:
    """(group, gaps): how often a row's sequence isn't its predecessor's successor modulo ``modulus``.

    ``slice_`` is a monotone function of ``order`` that cuts it into slices."""
    rows = df.select(F.col(group).alias("g"), F.col(order).alias("o"), F.pmod(F.col(sequence), F.lit(modulus)).alias("s"), slice_.alias("sl"))
    inner = Window.partitionBy("g", "sl").orderBy("o")
    broken = lambda before, now: (now != F.pmod(before + 1, F.lit(modulus))).cast("long")
    within = rows.withColumn("gap", F.coalesce(broken(F.lag("s").over(inner), F.col("s")), F.lit(0)))
    slices = within.groupBy("g", "sl").agg(F.sum("gap").alias("gaps"), F.min_by("s", "o").alias("first"), F.max_by("s", "o").alias("last"))
    outer = Window.partitionBy("g").orderBy("sl")
    joined = slices.withColumn("gap", F.coalesce(broken(F.lag("last").over(outer), F.col("first")), F.lit(0)))
    return joined.groupBy(F.col("g").alias(group)).agg(F.sum(F.col("gaps") + F.col("gap")).alias("gaps"))


def lag_across(df: DataFrame, group: str, order: str, value: str, slice_: Column, out: str) -> DataFrame:
    """Adds the previous row's ``value`` in its group's order, null for the first; values aren't null."""
    rows = df.withColumn("_sl", slice_)
    ends = rows.groupBy(F.col(group).alias("_g"), F.col("_sl").alias("_s")).agg(F.max_by(value, order).alias("_end"))
    ends = ends.withColumn("_carried", F.lag("_end").over(Window.partitionBy("_g").orderBy("_s"))).drop("_end")
    inner = Window.partitionBy(group, "_sl").orderBy(order)
    joined = rows.withColumn("_in", F.lag(value).over(inner)).join(ends, F.col(group).eqNullSafe(F.col("_g")) & F.col("_sl").eqNullSafe(F.col("_s")))
    return joined.withColumn(out, F.coalesce("_in", "_carried")).drop("_sl", "_g", "_s", "_in", "_carried")


def numbered(df: DataFrame, group: str, order: list[str], slice_: Column, out: str = "sequence") -> DataFrame:
    """Adds each row's 0-based number in its group's order; ``slice_`` is monotone in the order."""
    rows = df.withColumn("_sl", slice_)
    sizes = rows.groupBy(F.col(group).alias("_g"), F.col("_sl").alias("_s")).agg(F.count(F.lit(1)).alias("_n"))
    before = Window.partitionBy("_g").orderBy("_s").rowsBetween(Window.unboundedPreceding, -1)
    sizes = sizes.withColumn("_before", F.coalesce(F.sum("_n").over(before), F.lit(0)))
    inner = Window.partitionBy(group, "_sl").orderBy(*order)
    placed = rows.withColumn("_r", F.row_number().over(inner)).join(sizes, F.col(group).eqNullSafe(F.col("_g")) & F.col("_sl").eqNullSafe(F.col("_s")))
    return placed.withColumn(out, (F.col("_before") + F.col("_r") - 1).cast("long")).drop("_sl", "_r", "_g", "_s", "_n", "_before")


def schedule(df: DataFrame, time: str, speed: float = 1.0, mode: str = "fast", start: int | None = None) -> DataFrame:
    """Replay order and due time: rows from ``start`` on, with ``due_us`` since the first of them.

    ``deterministic`` has no pauses, ``real_time`` takes speed 1, ``fast`` divides by ``speed``."""
    rows = df if start is None else df.filter(F.col(time) >= start)
    rate = {"deterministic": None, "real_time": 1.0, "fast": speed}[mode]
    first = rows.agg(F.min(time).alias("_first"))
    # one row: the start of the replay
    both = rows.join(F.broadcast(first))
    due = F.lit(0) if rate is None else F.floor((F.col(time) - F.col("_first")) / rate)
    return both.withColumn("due_us", due.cast("long")).drop("_first")


def as_of(left: DataFrame, right: DataFrame, key: str, time: str, value: str, out: str, width: int) -> DataFrame:
    """Adds to each left row the right side's ``value`` of the latest time at or before its own, with the
    same key. Both sides are cut into slices of ``width``; each slice gets the last value before it."""
    names = left.columns
    l = left.withColumn("_side", F.lit(1)).withColumn("_value", F.lit(None).cast(right.schema[value].dataType))
    r = right.select(F.col(key), F.col(time), F.lit(0).alias("_side"), F.col(value).alias("_value"))
    both = l.unionByName(r, allowMissingColumns=True).withColumn("_slice", F.floor(F.col(time) / width))
    inner = Window.partitionBy(key, "_slice").orderBy(time, "_side").rowsBetween(Window.unboundedPreceding, 0)
    seen = both.withColumn("_last", F.last("_value", ignorenulls=True).over(inner))
    ends = r.groupBy(F.col(key).alias("_k"), F.floor(F.col(time) / width).alias("_s")).agg(F.max_by("_value", time).alias("_end"))
    marks = both.select(F.col(key).alias("_k"), F.col("_slice").alias("_s")).distinct().join(ends, ["_k", "_s"], "left")
    before = Window.partitionBy("_k").orderBy("_s").rowsBetween(Window.unboundedPreceding, -1)
    marks = marks.select("_k", "_s", F.last("_end", ignorenulls=True).over(before).alias("_carried"))
    done = seen.filter("_side = 1").join(marks, (F.col(key) == F.col("_k")) & (F.col("_slice") == F.col("_s")), "left")
    return done.select(*names, F.coalesce("_last", "_carried").alias(out))


def sessions(df: DataFrame, group: str, time: str, gap: int) -> DataFrame:
    """(group, start, end, n) of runs of rows less than ``gap`` microseconds apart."""
    rows = df.select(group, F.timestamp_micros(time).alias("_t"))
    found = rows.groupBy(group, F.session_window("_t", f"{gap // 1_000_000} seconds").alias("w")).agg(F.max("_t").alias("last"), F.count(F.lit(1)).alias("n"))
    return found.select(group, F.unix_micros("w.start").alias("start_us"), F.unix_micros("last").alias("end_us"), "n")

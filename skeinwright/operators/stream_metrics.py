"""Per-stream counts, rates, percentiles, drop rates and gaps, and what is made of them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .ordered import numbered, sequence_gaps
from .percentile import exact_percentiles

PERCENTILES = {"p50": 0.5, "p99": 0.99, "p999": 0.999}
#: Names of a stream's metrics (fixed values) and the columns that hold them.
METRICS = {
    "received": "received",
    "msgs_per_sec": "msgs_per_sec",
    "latency_p50_ms": "p50",
    "latency_p99_ms": "p99",
    "latency_p999_ms": "p999",
    "drop_rate_pct": "drop_rate_pct",
    "sequence_gaps": "sequence_gaps",
}
HOUR_US = 3_600_000_000


def rate_of(rates: float | dict[str, float], group: str = "stream") -> Column:
    """The rate that messages are expected at: one for all, or each stream's own (0 where it has none)."""
    if not isinstance(rates, dict):
        return F.lit(float(rates))
    own = F.create_map(*[F.lit(x) for k, v in rates.items() for x in (k, float(v))])[F.col(group)] if rates else F.lit(None)
    return F.coalesce(own, F.lit(0.0))


def drop_rate(n: Column, window_s: Column, rate_hz: float | Column, duration_s: float) -> Column:
    """Percent of expected messages that are missing: over the observed window where there are two or more
    messages in a window of some length, else over the whole duration."""
    rate = rate_hz if isinstance(rate_hz, Column) else F.lit(rate_hz)
    steady = rate * window_s
    whole = rate * duration_s
    pct = lambda expected, got: 100.0 * F.greatest(F.lit(0.0), expected - got) / expected
    return F.when((n >= 2) & (window_s > 0), F.when(steady > 0, pct(steady, n - 1)).otherwise(0.0)).otherwise(
        F.when(whole > 0, pct(whole, n)).otherwise(0.0)
    )


def stream_metrics(frames: DataFrame, rate_hz: float | dict[str, float], duration_s: float, group: str = "stream", order: str | None = None) -> DataFrame:
    """One row per stream of frames (stream, id, us, latency). The first and last arrival are the least and the
    greatest, or with ``order`` those first and last recorded, which differ where messages are late."""
    first, last = (F.min_by("us", order), F.max_by("us", order)) if order else (F.min("us"), F.max("us"))
    seconds = (F.col("last_us") - F.col("first_us")) / 1e6
    base = frames.groupBy(group).agg(F.count(F.lit(1)).alias("received"), first.alias("first_us"), last.alias("last_us"))
    base = base.select(
        group,
        "received",
        F.round((F.col("received") / duration_s) if duration_s > 0 else F.lit(0.0), 9).alias("msgs_per_sec"),
        "first_us",
        "last_us",
        F.round(drop_rate(F.col("received"), seconds, rate_of(rate_hz, group), duration_s), 6).alias("drop_rate_pct"),
    )
    ranks = exact_percentiles(frames, group, "latency", PERCENTILES)
    gaps = sequence_gaps(frames, group, "id", "id", F.floor(F.col("id") / 4096)).withColumnRenamed("gaps", "sequence_gaps")
    return base.join(ranks, group, "left").join(gaps, group, "left").fillna(0.0, list(PERCENTILES))


def bench_summary(samples: DataFrame, warmup: float = 0.1, group: str = "name", value: str = "ns", order: str = "pos") -> DataFrame:
    """(name, iterations, p50, p99, p999, msgs_per_sec) of timed operations, in nanoseconds: of n samples in order, the
    first floor(n * warmup) are left out."""
    rows = samples.select(F.col(group).alias("g"), F.col(value).cast("double").alias("v"), F.col(order).alias("o"))
    placed = numbered(rows, "g", ["o"], F.floor(F.col("o") / 4096), "n")
    totals = samples.groupBy(F.col(group).alias("tg")).agg(F.count(F.lit(1)).alias("total"))
    kept = placed.join(totals, F.col("g").eqNullSafe(F.col("tg"))).filter(F.col("n") >= F.floor(F.col("total") * warmup))
    sums = kept.groupBy(F.col("g").alias("sg")).agg(F.count(F.lit(1)).alias("iterations"), F.sum("v").alias("ns"))
    ranks = exact_percentiles(kept, "g", "v", PERCENTILES)
    rate = F.when(F.col("ns") > 0, F.col("iterations") * 1e9 / F.col("ns")).otherwise(0.0)
    return ranks.join(sums, F.col("g").eqNullSafe(F.col("sg"))).select(F.col("g").alias(group), "iterations", *PERCENTILES, F.round(rate, 6).alias("msgs_per_sec"))


def unpivot(metrics: DataFrame, group: str = "stream") -> DataFrame:
    """(metric, value): seven keys for each stream."""
    pairs = ", ".join(f"'{name}', cast({column} as double)" for name, column in METRICS.items())
    return metrics.select(group, F.expr(f"stack({len(METRICS)}, {pairs}) as (m, value)")).select(F.concat_ws("_", group, "m").alias("metric"), "value")


def histogram(frames: DataFrame, bounds: list[float], group: str = "stream") -> DataFrame:
    """(stream, le, n): rows at most at each bound and over the one before; over all bounds: infinity."""
    le = F.lit(float("inf"))
    for b in reversed(bounds):
        le = F.when(F.col("latency") <= b, F.lit(float(b))).otherwise(le)
    return frames.groupBy(group, le.alias("le")).agg(F.count(F.lit(1)).alias("n"))

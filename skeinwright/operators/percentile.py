"""Exact lower-nearest-rank percentiles of large groups.

The percentile p of n values is the value at place floor(p * (n - 1)) of their order, 0 for no values.
Groups may be few and huge, so no group is sorted: values are counted in ``BINS`` equal ranges between
the group's least and greatest, running counts tell which range holds each wanted place, and only rows
of these ranges are ranked, equal values as one.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

BINS = 2048


def _bin(value: Column, low: Column, high: Column, bins: int) -> Column:
    share = (value - low) / F.when(high > low, high - low).otherwise(F.lit(1.0))
    return F.least(F.floor(share * bins), F.lit(bins - 1)).cast("int")


def rank_place(p: float, n: Column) -> Column:
    """The 0-based place of percentile p among n ordered values."""
    return F.floor(F.lit(p) * (n - 1)).cast("long")


def exact_percentiles(df: DataFrame, group: str, value: str, ps: dict[str, float], bins: int = BINS) -> DataFrame:
    """One row per group: the group and a column for each of ``ps``; null values don't count."""
    rows = df.filter(F.col(value).isNotNull()).select(F.col(group).alias("g"), F.col(value).cast("double").alias("v"))
    ends = rows.groupBy("g").agg(F.min("v").alias("low"), F.max("v").alias("high"))
    ranged = rows.join(ends.withColumnRenamed("g", "eg"), F.col("g").eqNullSafe(F.col("eg"))).withColumn("b", _bin(F.col("v"), F.col("low"), F.col("high"), bins))
    counts = ranged.groupBy("g", "b").agg(F.count(F.lit(1)).alias("c"), F.min("v").alias("least"), F.max("v").alias("most"))
    upto = Window.partitionBy("g").orderBy("b")  # at most `bins` rows a group
    counts = counts.withColumn("after", F.sum("c").over(upto)).withColumn("n", F.sum("c").over(Window.partitionBy("g")))
    places = F.array(*[F.struct(F.lit(k).alias("name"), rank_place(p, F.col("n")).alias("k")) for k, p in ps.items()])
    wanted = counts.withColumn("w", F.explode(places)).filter("w.k >= after - c and w.k < after")
    wanted = wanted.select(F.col("g").alias("wg"), F.col("b").alias("wb"), F.col("w.name").alias("name"), (F.col("w.k") - F.col("after") + F.col("c")).alias("k"), "least", "most")
    done = wanted.filter("least = most").select(F.col("wg").alias("g"), "name", F.col("least").alias("v"))
    inside = ranged.join(wanted.filter("least < most"), F.col("g").eqNullSafe(F.col("wg")) & (F.col("b") == F.col("wb")))
    # equal values are one row with their count, so a frequent value can't fill a task
    inside = inside.groupBy("g", "name", "k", "v").agg(F.count(F.lit(1)).alias("c"))
    ordered = Window.partitionBy("g", "name").orderBy("v")
    found = inside.withColumn("after", F.sum("c").over(ordered)).filter("k >= after - c and k < after")
    values = done.unionByName(found.select("g", "name", "v"))
    picked = [F.max(F.when(F.col("name") == k, F.col("v"))).alias(k) for k in ps]
    return values.groupBy("g").agg(*picked).withColumnRenamed("g", group)


def percentiles_sql(rows: str, group: str, value: str, ps: dict[str, float]) -> str:
    """The same in DuckDB, by row numbers."""
    picks = ", ".join(f"max(CASE WHEN r = floor({p} * (n - 1)) THEN {value} END) AS {k}" for k, p in ps.items())
    ranked = f"SELECT {group}, {value}, row_number() OVER (PARTITION BY {group} ORDER BY {value}) - 1 AS r, count(*) OVER (PARTITION BY {group}) AS n FROM {rows} WHERE {value} IS NOT NULL"
    return f"SELECT {group}, {picks} FROM ({ranked}) GROUP BY {group}"

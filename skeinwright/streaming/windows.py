"""Windows of streams with a watermark: rows that come later than it are dropped, windows before it are final."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def watermarked_counts(df: DataFrame, time: str, group: str, width: str, delay: str) -> DataFrame:
    """(group, start_us, n) of the tumbling windows that are final, once each, when the greatest time seen less
    ``delay`` has passed their end; later rows of such a window are left out. In batch all windows are final."""
    rows = df.select(F.col(group).alias("g"), F.col(time).cast("timestamp").alias("at")).withWatermark("at", delay)
    counts = rows.groupBy("g", F.window("at", width).alias("w")).agg(F.count(F.lit(1)).alias("n"))
    return counts.select(F.col("g").alias(group), F.unix_micros("w.start").alias("start_us"), "n")

"""Delays over a stream: a delayed row waits in the state store until the watermark has passed its due time.

Rows without a delay go on at once. The order of what a watermark lets go is that of the due times; equal ones
keep the order in which they came. ``flush`` is the end of a log: what still waits, in the same order.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor

from ..shipping import ship

OUT = "stream string, id bigint, due_us bigint, delayed boolean"
FIELDS = ["stream", "id", "due_us", "delayed"]


class _Waiting(StatefulProcessor):
    def init(self, handle) -> None:
        self.handle = handle
        self.held = handle.getListState("held", "id bigint, due_us bigint")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        for part in rows:
            now = part[part.delay_us <= 0]
            later = part[part.delay_us > 0]
            for r in later.itertuples():
                due = int(r.us + r.delay_us)
                self.held.appendValue((int(r.id), due))
                self.handle.registerTimer(-(-due // 1000))
            yield pd.DataFrame({"stream": key[0], "id": now.id, "due_us": now.us, "delayed": False}, columns=FIELDS)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        passed = expiredTimerInfo.getExpiryTimeInMs() * 1000
        waiting = [(int(r[0]), int(r[1])) for r in self.held.get()] if self.held.exists() else []
        due = sorted((w for w in waiting if w[1] <= passed), key=lambda w: w[1])
        rest = [w for w in waiting if w[1] > passed]
        if rest:
            self.held.put(rest)
        else:
            self.held.clear()
        yield pd.DataFrame([(key[0], i, at, True) for i, at in due], columns=FIELDS)

    def close(self) -> None:
        pass


def delay_stream(df: DataFrame, late: str = "0 seconds") -> DataFrame:
    """What rows (stream, id, us, delay_us) emit, as (stream, id, due_us, delayed): at once without a delay, else
    when a row that comes more than ``late`` after the due time shows that it has passed."""
    spark = df.sparkSession
    ship(spark)
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")
    rows = df.select("stream", "id", "us", F.coalesce("delay_us", F.lit(0)).alias("delay_us"), F.timestamp_micros("us").alias("at")).withWatermark("at", late)
    return rows.groupBy("stream").transformWithStateInPandas(_Waiting(), OUT, "Append", "EventTime")


def flush(rows: DataFrame, emitted: DataFrame) -> DataFrame:
    """The rows (stream, id, us, delay_us) that a stream of them has not emitted, in the order of their due times."""
    left = rows.join(emitted, ["stream", "id"], "left_anti")
    return left.select("stream", "id", (F.col("us") + F.coalesce("delay_us", F.lit(0))).alias("due_us"), F.lit(True).alias("delayed")).orderBy("due_us", "id")

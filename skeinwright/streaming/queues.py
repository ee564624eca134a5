"""Bounded queues between a stream and a drain that takes one item a period, and resends of stale data."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .folds import ordered_fold, stateful_stream

#: The policy of each kind of sensor (fixed values); others drop the newest.
POLICIES = {"camera": "overwrite_oldest", "imu": "batch_accumulate", "can": "never_drop", "lidar": "drop_newest", "gps": "drop_newest"}
OUT = "stream string, enqueued bigint, dropped bigint, overwritten bigint, blocked bigint, occupancy bigint, max_occupancy bigint"
FIELDS = ("occ", "k", "enqueued", "dropped", "overwritten", "blocked", "top")


def start() -> tuple:
    return (0, 0, 0, 0, 0, 0, 0)


def make_step(capacity: int, period: int):
    """Drains happen at multiples of ``period``, before an arrival at the same time."""

    def step(state: tuple, row: dict) -> tuple[tuple, list[dict]]:
        occ, k, enqueued, dropped, overwritten, blocked, top = state
        now = max(row["t"] // period, k)
        occ, k = max(occ - (now - k), 0), now
        policy = POLICIES.get(row["stream"], "drop_newest")
        if occ < capacity:
            occ, enqueued = occ + 1, enqueued + 1
        elif policy == "overwrite_oldest":
            overwritten, enqueued = overwritten + 1, enqueued + 1
        elif policy == "never_drop":  # the producer waits for the next drain
            blocked, enqueued, k = blocked + 1, enqueued + 1, k + 1
        else:
            dropped += 1
        return (occ, k, enqueued, dropped, overwritten, blocked, max(top, occ)), []

    return step


def _finish(group, state: tuple) -> list[dict]:
    occ, _, enqueued, dropped, overwritten, blocked, top = state
    return [{"stream": group, "enqueued": enqueued, "dropped": dropped, "overwritten": overwritten, "blocked": blocked, "occupancy": occ, "max_occupancy": top}]


def backpressure(df: DataFrame, capacity: int, period: int) -> DataFrame:
    """Counters for each stream of rows (stream, pos, t), taken by pos."""
    return ordered_fold(df.select("stream", "pos", "t"), "stream", ["pos"], start, make_step(capacity, period), OUT, _finish)


def backpressure_stream(df: DataFrame, capacity: int, period: int) -> DataFrame:
    """Running counters after each micro-batch."""
    inner = make_step(capacity, period)

    def step(state: tuple, row: dict) -> tuple[tuple, list[dict]]:
        state, _ = inner(state, row)
        return state, _finish(row["stream"], state)

    kinds = ", ".join(f"{f} bigint" for f in FIELDS)
    return stateful_stream(df.select("stream", "pos", "t"), "stream", ["pos"], start, step, OUT, kinds, tuple, tuple)


def surviving(df: DataFrame, capacity: int, period: int) -> DataFrame:
    """Which items leave the queue: (stream, pos, drained_at), in the order of drains."""
    out = "stream string, pos bigint, drained_at bigint"

    def begin() -> tuple:
        return ([], 0)

    def drain(queue: list, k: int, until: int, stream: str) -> tuple[int, list[dict]]:
        made = []
        while k < until and queue:
            k += 1
            made.append({"stream": stream, "pos": queue.pop(0), "drained_at": k * period})
        return max(k, until), made

    def step(state: tuple, row: dict) -> tuple[tuple, list[dict]]:
        queue, k = state
        k, made = drain(queue, k, max(row["t"] // period, k), row["stream"])
        policy = POLICIES.get(row["stream"], "drop_newest")
        if len(queue) >= capacity:
            if policy == "overwrite_oldest":
                queue.pop(0)
            elif policy == "never_drop":
                k, more = drain(queue, k, k + 1, row["stream"])
                made += more
            else:
                return (queue, k), made
        queue.append(row["pos"])
        return (queue, k), made

    def finish(group, state: tuple) -> list[dict]:
        queue, k = state
        return drain(queue, k, k + len(queue), group)[1]

    return ordered_fold(df.select("stream", "pos", "t"), "stream", ["pos"], begin, step, out, finish)


def stale_resend(df: DataFrame, key: str, time: str, value: str, period: int, first: int, last: int) -> DataFrame:
    """On each tick from ``first`` to ``last``: the latest value at or before it, and whether it is a repeat."""
    ticks = df.sparkSession.range(first // period, last // period + 1).select((F.col("id") * period).alias("tick"))
    latest = df.groupBy(F.col(key).alias("k"), (F.ceil(F.col(time) / period) * period).alias("at")).agg(F.max_by(value, time).alias("v"))
    # `keys` and `ticks` are the output's own dimensions
    keys = latest.select("k").distinct()
    grid = keys.join(ticks, F.lit(True)).join(latest.withColumnsRenamed({"k": "lk"}), (F.col("k") == F.col("lk")) & (F.col("tick") == F.col("at")), "left")
    upto = Window.partitionBy("k").orderBy("tick")
    shown = grid.select(F.col("k").alias(key), "tick", F.last("v", ignorenulls=True).over(upto).alias("sent"), F.col("v").isNull().alias("stale"))
    return shown.filter(F.col("sent").isNotNull())

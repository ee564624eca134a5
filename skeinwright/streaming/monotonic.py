"""The monotonicity filter: a frame is accepted if neither its sequence nor, then, its timestamp is less
than that of the last accepted frame of its stream; only acceptance moves the state."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .folds import ordered_fold, stateful_stream

OUT = "stream string, pos bigint, sequence bigint, us bigint, verdict string"


def start() -> tuple | None:
    return None


def step(state: tuple | None, row: dict) -> tuple[tuple, list[dict]]:
    verdict = "ok"
    if state is not None and row["sequence"] < state[0]:
        verdict = "sequence_regression"
    elif state is not None and row["us"] < state[1]:
        verdict = "timestamp_regression"
    if verdict == "ok":
        state = (row["sequence"], row["us"])
    return state, [{k: row[k] for k in ("stream", "pos", "sequence", "us")} | {"verdict": verdict}]


def monotonic_filter(df: DataFrame) -> DataFrame:
    """Adds the verdict to rows (stream, pos, sequence, us), taken by pos."""
    return ordered_fold(df.select("stream", "pos", "sequence", "us"), "stream", ["pos"], start, step, OUT)


def monotonic_stream(df: DataFrame) -> DataFrame:
    """The same over a streaming frame."""
    rows = df.select("stream", "pos", "sequence", "us")
    return stateful_stream(rows, "stream", ["pos"], start, step, OUT, "seq bigint, us bigint", tuple, tuple)


def sequence_only(df: DataFrame, slice_rows: int = 4096) -> DataFrame:
    """Adds ``accepted`` where the sequence alone decides: no less than the greatest before it. The order is
    cut into slices of positions; a slice gets the greatest sequence of all slices before it."""
    rows = df.withColumn("_s", F.floor(F.col("pos") / slice_rows))
    tops = rows.groupBy(F.col("stream").alias("_g"), F.col("_s").alias("_t")).agg(F.max("sequence").alias("_top"))
    before = Window.partitionBy("_g").orderBy("_t").rowsBetween(Window.unboundedPreceding, -1)
    tops = tops.select("_g", "_t", F.max("_top").over(before).alias("_carried"))
    inner = Window.partitionBy("stream", "_s").orderBy("pos").rowsBetween(Window.unboundedPreceding, -1)
    joined = rows.withColumn("_seen", F.max("sequence").over(inner)).join(tops, (F.col("stream") == F.col("_g")) & (F.col("_s") == F.col("_t")))
    top = F.greatest("_seen", "_carried")
    return joined.select(*df.columns, (top.isNull() | (F.col("sequence") >= top)).alias("accepted"))

"""The event table as a stream of sensor frames.

event_id is the link sequence, ts the capture time, event_type the stream, value the latency in
milliseconds and props the payload.
"""

from __future__ import annotations

from datetime import datetime, timezone

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Stream of each event type (fixed values).
STREAMS = {"signup": "can", "purchase": "gps", "view": "camera", "click": "imu", "error": "lidar"}
CODES = {"lidar": 1, "camera": 2, "imu": 3, "gps": 4, "can": 5}
START_US = 1_704_067_200_000_000
DAY_US = 86_400_000_000
DURATION_S = 30 * 86_400
RATE_HZ = 3.0 / 3600.0


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _case(column: Column, values: dict) -> Column:
    return F.create_map(*[F.lit(x) for kv in values.items() for x in kv])[column]


def frames(spark: SparkSession, sf_dir: str, since_us: int | None = None, streams: tuple[str, ...] | None = None) -> DataFrame:
    """(id, stream, us, latency, payload); us counts microseconds since 1970. ``since_us`` and ``streams`` filter
    the stored columns, so that the scan can leave out row groups."""
    events = table(spark, sf_dir, "events")
    if since_us is not None:
        at = datetime.fromtimestamp(since_us // 1_000_000, timezone.utc).replace(microsecond=since_us % 1_000_000, tzinfo=None)
        kind = events.schema["ts"].dataType.simpleString()
        events = events.filter(F.col("ts") >= F.lit(at.isoformat(" ")).cast(kind))
    if streams is not None:
        events = events.filter(F.col("event_type").isin([k for k, v in STREAMS.items() if v in streams]))
    return events.select(
        F.col("event_id").alias("id"),
        _case(F.col("event_type"), STREAMS).alias("stream"),
        F.unix_micros(F.col("ts").cast("timestamp")).alias("us"),
        F.col("value").alias("latency"),
        F.col("props").alias("payload"),
    )


def sensor_code(stream: Column) -> Column:
    return _case(stream, CODES)


_KINDS = " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in STREAMS.items())
#: The same in DuckDB's SQL, as the first common table expression.
SQL = f"WITH RECURSIVE frames AS (SELECT event_id AS id, CASE event_type {_KINDS} END AS stream, epoch_us(ts) AS us, value AS latency, props AS payload FROM events)"
SQL_CODE = "CASE stream " + " ".join(f"WHEN '{k}' THEN {v}" for k, v in CODES.items()) + " END"

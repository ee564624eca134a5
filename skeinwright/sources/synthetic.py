"""Synthetic sensors, by sequence number: point sweeps, images, inertial and position samples, bus frames.

Noise is normal with the given deviation, drawn from a hash of (seed, row), so a row is the same however
the rows are dealt out. A rate of 0 or less counts as 1 Hz.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.codecs import le_bytes
from ..shipping import ship

METERS_PER_DEGREE = 111_320.0


def ticks(spark: SparkSession, first: int, last: int, rate_hz: float = 1.0) -> DataFrame:
    """(seq, t) of the ticks from ``first`` to before ``last``."""
    return spark.range(first, last).select(F.col("id").alias("seq"), (F.col("id") / F.lit(float(rate_hz) if rate_hz > 0 else 1.0)).alias("t"))


def noise(sigma: float, seed: int, *key: Column) -> Column:
    """A normal deviate of a row, by two hashed uniforms."""
    if not sigma:
        return F.lit(0.0)
    unit = lambda k: (F.pmod(F.xxhash64(F.lit(seed), F.lit(k), *key), F.lit(2**52)) + 0.5) / F.lit(float(2**52))
    return F.sqrt(-2.0 * F.log(unit(1))) * F.cos(2 * math.pi * unit(2)) * sigma


def lidar(spark: SparkSession, first: int, last: int, points: int = 360, sigma: float = 0.0, seed: int = 1) -> DataFrame:
    """(seq, i, x, y, z), single precision."""
    rows = ticks(spark, first, last).withColumn("i", F.explode(F.sequence(F.lit(0), F.lit(points - 1))))
    angle = F.lit(2.0 * math.pi) * F.col("i") / points
    r = 5.0 + 0.5 * F.sin(F.col("seq") * 0.05) + noise(sigma, seed, F.col("seq"), F.col("i"))
    z = 0.1 * F.sin(angle * 4.0) + noise(sigma, seed + 1, F.col("seq"), F.col("i"))
    return rows.select("seq", "i", (r * F.cos(angle)).cast("float").alias("x"), (r * F.sin(angle)).cast("float").alias("y"), z.cast("float").alias("z"))


def camera_frame(seq: int, width: int, height: int, amplitude: int = 0, seed: int = 1) -> bytes:
    """A scrolling gradient, three bytes a pixel, with noise from a linear congruential sequence."""
    x, y = np.meshgrid(np.arange(width), np.arange(height))
    phase = seq & 255
    planes = np.stack([(x + phase) & 255, (y + phase) & 255, (x + y) & 255], axis=-1)
    if amplitude > 0:
        state, draws = (seed ^ (seq * 2654435761)) & 0xFFFFFFFF, []
        for _ in range(width * height):
            state = (state * 1664525 + 1013904223) & 0xFFFFFFFF
            draws.append((state >> 23) % (2 * amplitude + 1) - amplitude)
        planes = planes + np.array(draws).reshape(height, width, 1)
    return np.clip(planes, 0, 255).astype(np.uint8).tobytes()


def camera(spark: SparkSession, first: int, last: int, width: int, height: int, amplitude: int = 0, seed: int = 1) -> DataFrame:
    """(seq, data) with rgb8 images."""
    ship(spark)

    def run(seqs: pa.Array) -> pa.Array:
        return pa.array([camera_frame(s, width, height, amplitude, seed) for s in seqs.to_pylist()], pa.binary())

    return ticks(spark, first, last).select("seq", F.arrow_udf(run, "binary")("seq").alias("data"))


def imu(spark: SparkSession, first: int, last: int, rate_hz: float = 200.0, gyro: float = 0.0, accel: float = 0.0, seed: int = 1) -> DataFrame:
    rows = ticks(spark, first, last, rate_hz)
    yaw = 0.2 * F.sin(F.col("t") * 0.5)
    n = lambda sigma, k: noise(sigma, seed + k, F.col("seq"))
    return rows.select(
        "seq",
        F.cos(yaw * 0.5).alias("orientation_w"), F.lit(0.0).alias("orientation_x"), F.lit(0.0).alias("orientation_y"), F.sin(yaw * 0.5).alias("orientation_z"),
        n(gyro, 0).alias("angular_x"), n(gyro, 1).alias("angular_y"), (0.1 * F.cos(F.col("t") * 0.5) + n(gyro, 2)).alias("angular_z"),
        n(accel, 3).alias("linear_x"), n(accel, 4).alias("linear_y"), (9.81 + n(accel, 5)).alias("linear_z"),
        F.lit(gyro * gyro).alias("angular_variance"), F.lit(accel * accel).alias("linear_variance"),
    )


def gps(spark: SparkSession, first: int, last: int, rate_hz: float = 20.0, latitude: float = 40.4237, longitude: float = -86.9212, radius_m: float = 50.0, sigma: float = 0.0, seed: int = 1) -> DataFrame:
    rows = ticks(spark, first, last, rate_hz)
    n = lambda k: noise(sigma, seed + k, F.col("seq"))
    dx = radius_m * F.cos(F.col("t") * 0.1) + n(0)
    dy = radius_m * F.sin(F.col("t") * 0.1) + n(1)
    across = METERS_PER_DEGREE * math.cos(math.radians(latitude))
    return rows.select("seq", (latitude + dy / METERS_PER_DEGREE).alias("latitude"), (longitude + dx / across).alias("longitude"), (200.0 + n(2)).alias("altitude"))


def can(spark: SparkSession, first: int, last: int, rate_hz: float = 100.0, start_us: int = 0, sigma: float = 0.0, seed: int = 1) -> DataFrame:
    """(seq, can_id, dlc, data): wheel speed, steering angle and throttle in turn; bytes 2-3 hold the low
    16 bits of the sequence, 4-7 the low 32 of the time in microseconds."""
    rows = ticks(spark, first, last, rate_hz)
    which = F.col("seq") % 3
    n = lambda k: noise(sigma * k, seed, F.col("seq"))
    speed = F.floor(F.abs(2000.0 * (1.0 + F.sin(F.col("t") * 0.5)) + n(20)))
    angle = 500.0 * F.sin(F.col("t") * 0.3) + n(5)
    angle = F.pmod(F.when(angle < 0, F.ceil(angle)).otherwise(F.floor(angle)), F.lit(65536))
    throttle = F.floor(F.least(F.lit(255.0), F.greatest(F.lit(0.0), 128.0 + 100.0 * F.sin(F.col("t") * 0.2) + n(4))))
    signal = F.when(which == 0, F.pmod(speed, F.lit(65536))).when(which == 1, angle).otherwise(throttle)
    us = F.lit(start_us) + F.floor(F.col("t") * 1e6).cast("long")
    data = F.concat(le_bytes(signal, 2), le_bytes(F.pmod("seq", F.lit(65536)), 2), le_bytes(F.pmod(us, F.lit(4294967296)), 4))
    ids = F.when(which == 0, 0x100).when(which == 1, 0x200).otherwise(0x300)
    return rows.select("seq", ids.alias("can_id"), F.lit(8).alias("dlc"), data.alias("data"))

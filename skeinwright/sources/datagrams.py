"""Recorded links as sources and sinks: a file for each datagram or connection chunk, batch or streaming.

Sockets themselves belong to a collector in front of Spark; what it records, in folders, is read here, and
what is to be sent is written for it. A datagram is one frame, and empty ones are left out.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import codecs

LIMITS = {"udp": None, "io_uring": 64 << 10}


def _shaped(rows: DataFrame) -> DataFrame:
    name = F.regexp_extract("path", r"([^/]+)/([^/]+)$", 1)
    pos = F.regexp_extract("path", r"([0-9]+)[^/]*$", 1).cast("long")
    return rows.select(name.alias("link"), pos.alias("pos"), F.col("content").alias("data")).filter(F.octet_length("data") > 0)


def read_datagrams(spark: SparkSession, folder: str, stream: bool = False) -> DataFrame:
    """(link, pos, data) of files ``<link>/<number>``."""
    if stream:
        schema = "path string, modificationTime timestamp, length bigint, content binary"
        return _shaped(spark.readStream.format("binaryFile").schema(schema).option("recursiveFileLookup", "true").load(folder))
    return _shaped(spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(folder))


def to_link(frames: DataFrame, kind: str = "udp", byte_order: str = "big") -> DataFrame:
    """What goes on the wire: TCP frames get their prefix, io_uring drops what is over 64 KiB."""
    if kind == "tcp":
        return frames.withColumn("frame", codecs.tcp_frame(F.col("frame"), byte_order))
    limit = LIMITS[kind]
    return frames if limit is None else frames.filter(F.octet_length("frame") <= limit)

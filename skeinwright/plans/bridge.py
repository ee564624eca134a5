"""Settings of a bridge between links: topics with their rates and levels, and name spaces."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import codecs
from ..streaming import transforms

#: Topics that carry transforms by their name (fixed values); the second two are static.
TRANSFORM_TOPICS = ("/tf", "tf", "/tf_static", "tf_static")


def normalize(name: str) -> str:
    """One leading slash is added where there is none, one trailing slash taken off."""
    if not name:
        return name
    name = name if name.startswith("/") else "/" + name
    return name[:-1] if name.endswith("/") else name


def normalized(name: Column) -> Column:
    led = F.when(name.startswith("/"), name).otherwise(F.concat(F.lit("/"), name))
    return F.when(name == "", name).otherwise(F.regexp_replace(led, "/$", ""))


@dataclass(frozen=True)
class Topic:
    name: str
    rate: float = 5.0
    zstd_level: int = 3
    is_tf: bool = False
    is_static_tf: bool = False
    include: tuple[str, ...] = ()
    exclude: tuple[str, ...] = ()

    @property
    def period_ms(self) -> int:
        return int(1000.0 / self.rate)


@dataclass(frozen=True)
class Bridge:
    interface: str = ""
    publish_stale_data: bool = False
    subscribe_namespace: str = ""
    publish_namespace: str = ""
    wal_record_dir: str = ""
    topics: tuple[Topic, ...] = field(default=())


def from_mapping(root: dict) -> Bridge:
    """From a mapping of parameters; a topic's own mapping overrides the defaults."""
    rate, level = float(root.get("default_rate", 5.0)), int(root.get("default_zstd_level", 3))
    topics = []
    for name in root.get("topics") or []:
        own = root.get(name) or {}
        tf = bool(own.get("is_tf", name in TRANSFORM_TOPICS))
        static = tf and bool(own.get("is_static_tf", name in TRANSFORM_TOPICS[2:]))
        lists = {k: tuple(own.get(k) or ()) for k in ("include", "exclude")} if tf else {}
        topics.append(Topic(name, float(own.get("rate", rate)), int(own.get("zstd_level", level)), tf, static, **lists))
    names = {k: normalize(root.get(k) or "") for k in ("subscribe_namespace", "publish_namespace")}
    return Bridge(str(root.get("network_interface", "")), bool(root.get("publish_stale_data", False)), wal_record_dir=str(root.get("wal_record_dir") or ""), topics=tuple(topics), **names)


def topics_table(spark: SparkSession, bridge: Bridge) -> DataFrame:
    return spark.createDataFrame([(t.name, t.rate, t.zstd_level, t.is_tf, t.is_static_tf) for t in bridge.topics], "topic string, rate double, zstd_level int, is_tf boolean, is_static_tf boolean")


def send(messages: DataFrame, bridge: Bridge) -> DataFrame:
    """(topic, frame): each message (topic, msg_type, sensor_type, sequence, timestamp_ns, payload) wrapped,
    compressed at its topic's level and framed. Topics that aren't listed are not sent."""
    inner = codecs.inner_message(F.col("topic"), F.col("msg_type"), F.col("payload"))
    parts = None
    for level in sorted({t.zstd_level for t in bridge.topics}):
        names = [t.name for t in bridge.topics if t.zstd_level == level]
        mine = messages.filter(F.col("topic").isin(names)).withColumn("packed", codecs.compress(inner, level))
        parts = mine if parts is None else parts.unionByName(mine)
    if parts is None:
        return messages.select("topic", F.lit(None).cast("binary").alias("frame")).filter("false")
    frame = codecs.encode_frame(F.col("sensor_type"), F.col("sequence"), F.col("timestamp_ns"), F.lit(codecs.COMPRESSED), F.col("packed"))
    return parts.select("topic", frame.alias("frame"))


def receive(frames: DataFrame, bridge: Bridge) -> DataFrame:
    """(error, topic, msg_type, payload) of each frame, topics under the publishing name space."""
    read = frames.select(codecs.decode_frame(F.col("frame")).alias("d"))
    packed = F.col("d.flags").bitwiseAND(F.lit(codecs.COMPRESSED)) != 0
    opened = read.withColumn("raw", F.when(packed, codecs.decompress(F.col("d.payload"))).otherwise(F.col("d.payload")))
    parsed = opened.withColumn("m", codecs.parse_inner(F.col("raw")))
    error = F.when(F.col("d.error") != "ok", F.col("d.error")).when(F.col("raw").isNull(), "decompress").when(F.col("m").isNull(), "malformed").otherwise("ok")
    return parsed.select(error.alias("error"), F.concat(F.lit(bridge.publish_namespace), "m.topic").alias("topic"), "m.msg_type", "m.payload")


def filter_transforms(rows: DataFrame, topic: Topic) -> DataFrame:
    return transforms.pattern_filter(rows, list(topic.exclude), list(topic.include))

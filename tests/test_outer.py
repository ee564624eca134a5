"""Bridge settings and round trip, charts, gate, exporter, datagrams and the command line."""

import json
import urllib.error

import pytest
from pyspark.sql import functions as F

from skeinwright import cli
from skeinwright.plans import bridge, charts, gate, report
from skeinwright.sources import datagrams, exporter

STORY = """
name: story
duration_seconds: 2592000
streams: {imu: {rate_hz: 1}, gps: {rate_hz: 1}}
faults: [{stream: imu, start_seconds: 0, duration_seconds: 86400, type: drop, drop_rate: 0.5}]
assertions: [{metric: imu_received, operator: greater_than, value: 1}]
"""


def test_bridge_settings(spark):
    made = bridge.from_mapping({"default_rate": 100.0, "topics": ["/a", "/tf_static"], "/a": {"rate": 2.0, "zstd_level": 5}, "/tf_static": {"exclude": ["x.*"]}, "publish_namespace": "udp2/"})
    a, tf = made.topics
    assert (a.rate, a.zstd_level, a.is_tf, a.period_ms) == (2.0, 5, False, 500)
    assert (tf.rate, tf.is_tf, tf.is_static_tf, tf.exclude) == (100.0, True, True, ("x.*",))
    assert made.publish_namespace == "/udp2" and bridge.normalize("") == ""
    names = spark.createDataFrame([("a/",), ("/a",), ("",), ("//",)], "n string").select(bridge.normalized(F.col("n")).alias("n")).collect()
    assert [r.n for r in names] == ["/a", "/a", "", "/"]
    rows = spark.createDataFrame([("/a", "std/String", 1, 7, 9, b"Testing123"), ("/other", "std/String", 1, 8, 9, b"no")], "topic string, msg_type string, sensor_type int, sequence bigint, timestamp_ns bigint, payload binary")
    got = bridge.receive(bridge.send(rows, made), made).collect()
    assert [tuple(r) for r in got] == [("ok", "/udp2/a", "std/String", bytearray(b"Testing123"))]


def test_exporter_and_scrape(spark):
    series = spark.createDataFrame([("x", {"sensor": "imu"}, 1.5), ("n", {}, 2.0)], "name string, labels map<string,string>, value double")
    server = exporter.Exporter(kinds={"n": "counter"})
    try:
        server.update(series)
        rows = {r.name: (r["labels"], r.value) for r in exporter.scrape(spark, f"http://127.0.0.1:{server.port}/metrics").collect()}
        assert rows == {"x": ({"sensor": "imu"}, 1.5), "n": ({}, 2.0)}
        with pytest.raises(urllib.error.HTTPError):
            exporter.scrape(spark, f"http://127.0.0.1:{server.port}/else")
    finally:
        server.close()


def test_gate(spark, tmp_path):
    log, base = tmp_path / "log", tmp_path / "base.json"
    log.write_text("[BENCH] a p99=12ns msgs/sec=5\n")
    code, text = gate.run(spark, str(log), str(base), update=True)
    assert code == 0 and "NEW" in text
    assert json.loads(base.read_text()) == {"a": {"p99": 12.0, "msgs_sec": 5.0}}
    log.write_text("[BENCH] a p99=14ns msgs/sec=4\n")
    code, text = gate.run(spark, str(log), str(base))
    assert code == 1 and "FAIL" in text and "WARN" in text
    log.write_text("nothing\n")
    assert gate.run(spark, str(log), str(base))[0] == 2


def test_datagrams(spark, tmp_path):
    for i in range(3):
        (tmp_path / "link0").mkdir(exist_ok=True)
        (tmp_path / "link0" / f"{i:03d}.bin").write_bytes(bytes([i]) * (i * 40_000))
    rows = datagrams.read_datagrams(spark, str(tmp_path))
    assert sorted((r.link, r.pos, len(r.data)) for r in rows.collect()) == [("link0", 1, 40_000), ("link0", 2, 80_000)]
    sent = rows.select(F.col("data").alias("frame"))
    assert datagrams.to_link(sent, "io_uring").count() == 1 and datagrams.to_link(sent).count() == 2
    assert {bytes(r.frame[:2]) for r in datagrams.to_link(sent, "tcp").collect()} == {b"\xab\xcd"}


def test_command_line(spark, tmp_path, sf):
    story, out, page = tmp_path / "s.yaml", tmp_path / "reports", tmp_path / "page.html"
    story.write_text(STORY)
    assert cli.main(["run", "--scenario", str(story), "--data", sf, "--report-dir", str(out)], spark) == 0
    assert cli.main(["summary", "--reports", str(out / "*.json"), "--out", str(page)], spark) == 0
    assert "1 passed" in page.read_text() and "<svg" in page.read_text() and "http" not in page.read_text().replace("http://www.w3.org", "")
    assert "<script" not in (out / "story_0.html").read_text()
    story.write_text("duration_seconds: 1")
    assert cli.main(["run", "--scenario", str(story), "--data", sf], spark) == 2
    assert cli.main(["run"], spark) == 2


def test_lines(spark):
    rows = spark.createDataFrame([("imu", 0.0, 1.0), ("imu", 1.0, 2.0)], "sensor string, t double, value double")
    assert charts.throughput(rows).count("<polyline") == charts.drop_rate(rows).count("<polyline") == charts.crc_failures(rows.drop("sensor")).count("<polyline") == 1
    assert report.bars(spark.createDataFrame([("a", 0.2)], "stream string, latency_p99_ms double")).head().bar_width == 20

"""The log as a sink and a stream, the dashboard, delays over a stream, static transform topics."""

import json
import urllib.error
import urllib.request

import pytest
from pyspark.sql import functions as F

from skeinwright.functions import codecs
from skeinwright.plans import dashboard
from skeinwright.sources import exporter, wal
from skeinwright.streaming import delays, transforms
from test_more import _drain, _stream


def _records(spark, n, first=0):
    return spark.range(first, first + n).select((F.col("id") * 1000).alias("timestamp_ns"), F.lit(4).alias("sensor_type"), F.col("id").alias("sequence"), F.concat(F.lit("record-"), "id").alias("payload"))


def test_parallel_sink_keeps_order_and_stream_reads_on(spark, tmp_path):
    folder = f"file://{tmp_path}/log"
    wal.save_log(_records(spark, 500).repartition(5).orderBy("sequence"), folder, 2048)
    back = wal.read_log(spark, folder).orderBy("segment_id", "at").collect()
    assert [r.sequence for r in back] == list(range(500))
    assert bytes(back[7].payload) == b"record-7"
    sizes = wal.read_log(spark, folder, stats=True).collect()
    assert sum(r.records_ok for r in sizes) == 500 and not any(r.bytes_skipped for r in sizes)
    assert all(f.stat().st_size <= 2048 for f in (tmp_path / "log").iterdir())

    def run():
        query = wal.stream_log(spark, folder).select("sequence").writeStream.format("parquet").option("checkpointLocation", f"{tmp_path}/c").trigger(availableNow=True).start(f"{tmp_path}/out")
        query.awaitTermination()
        return sorted(r.sequence for r in spark.read.schema("sequence bigint").parquet(f"{tmp_path}/out").collect())

    assert run() == list(range(500))
    wal.save_log(_records(spark, 20, 500), folder)
    assert run() == list(range(520))
    big = spark.createDataFrame([(1, 1, 1, bytearray(codecs.MAX_PAYLOAD + 1))], "timestamp_ns bigint, sensor_type int, sequence bigint, payload binary")
    with pytest.raises(Exception, match="limit"):
        wal.save_log(big, folder)
    assert wal.read_log(spark, folder).count() == 520
    wal.save_log(_records(spark, 3), folder, mode="overwrite")
    assert wal.read_log(spark, folder).count() == 3


def _get(port, path):
    try:
        with urllib.request.urlopen(f"http://127.0.0.1:{port}{path}", timeout=60) as page:
            return page.status, page.read().decode()
    except urllib.error.HTTPError as e:
        return e.code, e.read().decode()


def test_dashboard(spark, tmp_path):
    series = [("x_msgs_per_sec", {"sensor": "imu"}, 5.0), ("x_drop_rate_pct", {"sensor": "imu"}, 1.0), ("x_latency_p50_ms", {"sensor": "imu"}, 2.0), ("x_latency_p99_ms", {"sensor": "imu"}, 9.5), ("x_crc_failures_total", {}, 3.0)]
    (tmp_path / "a.json").write_text(json.dumps({"scenario": "one", "result": "PASS", "metrics": {"per_sensor": {}}}))
    (tmp_path / "b.json").write_text("not a report")
    server = exporter.Exporter()
    board = dashboard.Dashboard(spark, f"http://127.0.0.1:{server.port}/metrics", str(tmp_path), "x_")
    try:
        server.update(spark.createDataFrame(series, "name string, labels map<string,string>, value double"))
        assert json.loads(_get(board.port, "/health")[1])["status"] == "ok"
        assert json.loads(_get(board.port, "/api/metrics")[1]) == {"per_sensor": {"imu": {"p50": 2.0, "p99": 9.5}}}
        assert [r["scenario"] for r in json.loads(_get(board.port, "/api/reports")[1])["reports"]] == ["one"]
        status, page = _get(board.port, "/")
        assert status == 200 and page.count("<svg") == 5
        assert [(s, v) for s, _, v in board.series["msgs_per_sec"]] == [("imu", 5.0)] * 2
        assert [v for _, _, v in board.series["crc_failures_total"]] == [3.0, 3.0]
        assert _get(board.port, "/else")[0] == 404
        server.close()
        assert _get(board.port, "/api/metrics")[0] == 503
        assert "unreachable" in _get(board.port, "/")[1]
    finally:
        board.close()


def test_delays_wait_for_their_time(spark, tmp_path):
    second = 1_000_000
    schema = "stream string, id bigint, us bigint, delay_us bigint"
    parts = [
        [("a", 1, 1 * second, 5 * second), ("a", 2, 2 * second, None), ("a", 3, 2 * second, 3 * second)],
        [("a", 4, 4 * second, 0)],
        [("a", 5, 10 * second, 60 * second)],
        [("a", 6, 11 * second, 0)],
    ]
    stream = _stream(spark, tmp_path, None, schema, parts)
    got = {(r.id, r.due_us // second, r.delayed) for r in _drain(delays.delay_stream(stream), tmp_path, spark)}
    assert got == {(2, 2, False), (4, 4, False), (3, 5, True), (1, 6, True), (6, 11, False)}
    every = spark.createDataFrame([r for p in parts for r in p], schema)
    left = delays.flush(every, spark.createDataFrame([("a", i) for i, _, _ in got], "stream string, id bigint")).collect()
    assert [(r.id, r.due_us // second) for r in left] == [(5, 70)]


def test_static_topics_have_no_stamps(spark, tmp_path):
    kind = "topic string, pos bigint, transforms array<struct<frame:string,child:string,stamp:bigint,value:double>>"
    send = [("t", 1, [("a", "b", 7, 1.0)]), ("t", 2, [("a", "c", 8, 2.0)]), ("t", 3, None), ("t", 4, [("c", "a", 9, 0.0)]), ("t", 5, [("a", "b", 1, 1.0)])]
    df = spark.createDataFrame(send, kind)
    shown = lambda rows: [json.loads(r.transforms) for r in sorted(rows, key=lambda r: r.pos)]
    assert shown(transforms.cache(df, stamped=True).collect())[1] == [["a", "b", [7, 1.0]], ["a", "c", [8, 2.0]]]
    want = shown(transforms.cache(df, static=True).collect())
    assert want == [[["a", "b", [0, 1.0]]], [["a", "b", [0, 1.0]], ["a", "c", [0, 2.0]]], [["a", "b", [0, 1.0]], ["a", "c", [0, 2.0]]], []]
    stream = _stream(spark, tmp_path, None, kind, [send[:1], send[1:3], send[3:]])
    assert shown(_drain(transforms.cache_stream(stream, static=True), tmp_path, spark)) == want

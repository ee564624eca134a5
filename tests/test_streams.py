"""Folds: batch and stream agree with plain loops; queues, bytes and transforms by hand."""

import random
import tempfile

import duckdb
import pytest
from pyspark.sql import functions as F

import compare
from skeinwright import catalog
from skeinwright.operators import faults, ordered, percentile
from skeinwright.plans import scenario
from skeinwright.sources import exposition
from skeinwright.streaming import monotonic, queues, reassembly, transforms


def as_stream(spark, df, tmp, parts=3, order="pos"):
    """The rows as files that a streaming query reads one after the other."""
    folder = tempfile.mkdtemp(dir=tmp)
    rows = df.orderBy(order).collect()
    for i in range(parts):
        some = rows[len(rows) * i // parts : len(rows) * (i + 1) // parts]
        spark.createDataFrame(some, df.schema).coalesce(1).write.mode("append").parquet(folder)
    return spark.readStream.schema(df.schema).option("maxFilesPerTrigger", 1).parquet(folder)


def finished(spark, stream, tmp, name, mode="append"):
    query = stream.writeStream.outputMode(mode).format("memory").queryName(name).option("checkpointLocation", tempfile.mkdtemp(dir=tmp)).trigger(availableNow=True).start()
    query.awaitTermination()
    return spark.table(name)


@pytest.fixture(scope="module")
def regressions(spark):
    rng = random.Random(3)
    rows = [(rng.choice("ab"), i, i - 5 * (rng.random() < 0.2), 10 * i - 40 * (rng.random() < 0.2)) for i in range(200)]
    return spark.createDataFrame(rows, "stream string, pos bigint, sequence bigint, us bigint")


def test_monotonic(spark, regressions, tmp_path):
    state, expected = {}, {}
    for r in regressions.orderBy("pos").collect():
        last = state.get(r.stream)
        verdict = "ok" if not last else "sequence_regression" if r.sequence < last[0] else "timestamp_regression" if r.us < last[1] else "ok"
        if verdict == "ok":
            state[r.stream] = (r.sequence, r.us)
        expected[r.pos] = verdict
    batch = {r.pos: r.verdict for r in monotonic.monotonic_filter(regressions).collect()}
    assert batch == expected
    stream = monotonic.monotonic_stream(as_stream(spark, regressions, tmp_path))
    assert {r.pos: r.verdict for r in finished(spark, stream, tmp_path, "mono").collect()} == expected


def test_reassembly(spark, tmp_path):
    data = b"junk\xab\x00" + b"".join(b"\xab\xcd" + len(p).to_bytes(4, "big") + p for p in (bytes([i % 250]) * (1 + i % 37) for i in range(100)))
    data += b"\xab\xab\xcd\x00\x00\x00\x00" + b"\xab\xcd\xff\xff\xff\xff" + b"\xab\xcd\x00\x00\x00\x01z"
    chunks = spark.createDataFrame([(1, i, data[k : k + 3]) for i, k in enumerate(range(0, len(data), 3))], "conn bigint, pos bigint, chunk binary")
    rows = reassembly.reassemble(chunks, most=1024).orderBy("n").collect()
    assert [len(r.payload) for r in rows] == [*(1 + i % 37 for i in range(100)), 0, 1]
    assert rows[-1].resyncs == 2
    stream = reassembly.reassemble_stream(as_stream(spark, chunks, tmp_path), most=1024)
    assert sorted(map(tuple, finished(spark, stream, tmp_path, "tcp").collect())) == sorted(map(tuple, rows))


def test_queue_counters_and_items(spark, tmp_path):
    rng = random.Random(5)
    rows = [(s, i, t) for s in ("camera", "can", "gps") for i, t in enumerate(sorted(rng.randrange(3000) for _ in range(120)))]
    df = spark.createDataFrame(rows, "stream string, pos bigint, t bigint")
    batch = {r.stream: r for r in queues.backpressure(df, 3, 50).collect()}
    items = queues.surviving(df, 3, 50).groupBy("stream").count().collect()
    for r in items:
        b = batch[r.stream]
        assert r["count"] == b.enqueued - b.overwritten
    assert batch["camera"].overwritten > 0 and batch["can"].blocked > 0 and batch["gps"].dropped > 0
    stream = queues.backpressure_stream(as_stream(spark, df, tmp_path, order="t"), 3, 50)
    last = finished(spark, stream, tmp_path, "queues").groupBy("stream").agg(F.max(F.struct(F.expr("enqueued + dropped").alias("n"), "enqueued", "dropped", "blocked")).alias("x"))
    for r in last.collect():
        assert (r.x.enqueued, r.x.dropped, r.x.blocked) == (batch[r.stream].enqueued, batch[r.stream].dropped, batch[r.stream].blocked)


def test_transform_cache(spark, tmp_path):
    send = [("t", 1, [("a", "b", 1.0)]), ("t", 2, [("a", "c", 2.0), ("a", "b", 3.0)]), ("t", 3, [("b", "a", 0.0), ("x", "y", 1.0)]), ("t", 4, [("a", "b", 9.0)])]
    kind = "topic string, pos bigint, transforms array<struct<frame:string,child:string,value:double>>"
    df = spark.createDataFrame(send, kind)
    rows = [tuple(r) for r in transforms.cache(df).orderBy("pos").collect()]
    assert [(r[1], r[2], r[3]) for r in rows] == [(1, 1, False), (2, 2, False), (3, 0, True)]
    assert rows[1][4] == '[["a", "b", 3.0], ["a", "c", 2.0]]'


def test_percentiles_of_ties_and_nulls(spark):
    rows = [("a", float(i % 5)) for i in range(100)] + [("b", 7.0), ("c", None), (None, 1.0), (None, 2.0)]
    df = spark.createDataFrame(rows, "g string, v double")
    got = {r.g: (r.p50, r.p99) for r in percentile.exact_percentiles(df, "g", "v", {"p50": 0.5, "p99": 0.99}, bins=2).collect()}
    ranked = sorted(i % 5 for i in range(100))
    assert got == {"a": (ranked[49], ranked[98]), "b": (7.0, 7.0), None: (1.0, 1.0)}


@pytest.mark.parametrize("rules", [[faults.Rule("duplicate")], [faults.Rule("reorder")], [faults.Rule("ecu_disconnect")], [faults.Rule("burst_loss", "imu", 5.0, 2.0)], [faults.Rule("drop", drop_rate=0.5)], []])
def test_fault_kinds(spark, rules):
    rows = [("imu", i, int(i * 1e5), i * 0.1, 1.0, "payload") for i in range(101)]
    df = spark.createDataFrame(rows, "stream string, id bigint, us bigint, t_s double, latency double, payload string")
    n = faults.apply_faults(df, rules).count()
    kind = rules[0].kind if rules else None
    assert {"duplicate": n == 202, "reorder": n == 100, "ecu_disconnect": n == 0, "burst_loss": n == 81, "drop": 30 <= n <= 70, None: n == 101}[kind]


def test_many_rules_go_by_join(spark):
    df = spark.createDataFrame([("imu", 1, 0, 1.5, 1.0, "p")], "stream string, id bigint, us bigint, t_s double, latency double, payload string")
    rules = [faults.Rule("delay", "imu", float(i), 1.0, delay_ms=float(i)) for i in range(300)]
    assert faults.with_active(df, rules).select(F.size("active")).head()[0] == 1


def test_scenarios(spark):
    good = scenario.parse("name: x\nduration_seconds: 30\nstreams: {imu: {rate_hz: 200}}\nassertions: [{metric: m, operator: equals, value: 1}]")
    assert good.streams == {"imu": 200.0} and good.assertions[0].operator == "equals"
    for bad in ("duration_seconds: 1", "name: x\nduration_seconds: 0", "name: x\nduration_seconds: 1\nassertions: [{metric: m, operator: about}]", "name: x\nduration_seconds: 1\nfaults: [{type: fire}]", "name: x\nduration_seconds: 1\nstreams: {a: {rate_hz: 0}}"):
        with pytest.raises(ValueError):
            scenario.parse(bad)
    empty = scenario.roll_up(spark.createDataFrame([], "scenario string, passed boolean, n_assertions bigint, n_passed bigint")).head()
    assert empty.total_scenarios == 0 and not empty.all_passed


def test_number_format(spark):
    values = [0.0, 1.0, 12.5, 123456.0, 1234567.0, 0.0001, 0.00001234, 1e-7, 3.14159265, 200.1, -2.5, 1e20]
    shown = spark.createDataFrame([(v,) for v in values], "v double").select(exposition.six_digits(F.col("v")).alias("t")).collect()
    assert [r.t for r in shown] == [f"{v:.6g}" for v in values]


def test_whole_numbers_in_full(spark):
    values = [(0.0, "0"), (-0.0, "0"), (999999.0, "999999"), (1000000.0, "1000000"), (5999989.0, "5999989"), (-1234567.0, "-1234567"), (2.0**53, "9007199254740992"), (2.0**63, "9.22337e+18"), (1e20, "1e+20"), (12.5, "12.5"), (1234567.5, "1.23457e+06"), (None, None)]
    shown = spark.createDataFrame([(v,) for v, _ in values], "v double").select(exposition.whole_in_full(F.col("v")).alias("t")).collect()
    assert [r.t for r in shown] == [t for _, t in values]


def test_rendered_counts_and_ids_of_seven_digits(spark, tmp_path):
    duckdb.sql(f"COPY (SELECT k + 41 AS event_id, TIMESTAMP '2024-01-01' AS ts, 'click' AS event_type, 1e0 AS value, '' AS props FROM range(1000001) r(k)) TO '{tmp_path}/events.parquet' (FORMAT parquet)")
    assert compare.differences(spark, catalog.queries()["prom_render"], catalog.oracle_sql()["prom_render"], str(tmp_path)) == ""


@pytest.mark.parametrize("change", ["CASE WHEN event_id % 3 > 0 THEN event_type END AS event_type", "CASE WHEN event_type <> 'click' THEN event_id END AS event_id", "CAST(NULL AS BIGINT) AS event_id", "CAST(NULL AS VARCHAR) AS event_type"])
def test_rendered_without_stream_or_value(spark, sf, tmp_path, change):
    duckdb.sql(f"COPY (SELECT * REPLACE ({change}) FROM '{sf}/events.parquet') TO '{tmp_path}/events.parquet' (FORMAT parquet)")
    assert compare.differences(spark, catalog.queries()["prom_render"], catalog.oracle_sql()["prom_render"], str(tmp_path)) == ""


def test_as_of(spark):
    left = spark.createDataFrame([(0, t) for t in (5, 10, 35, 99)], "k int, t bigint")
    right = spark.createDataFrame([(0, 10, "a"), (0, 20, "b"), (0, 31, "c")], "k int, t bigint, v string")
    got = {r.t: r.w for r in ordered.as_of(left, right, "k", "t", "v", "w", 10).collect()}
    assert got == {5: None, 10: "a", 35: "c", 99: "c"}

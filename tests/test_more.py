"""Rules beyond one literal array, refused records, pruned scans, watermarks, and streaming forms of folds."""

from __future__ import annotations

import random
import shutil
import subprocess
import sys

import numpy as np
from pyspark.sql import functions as F

from conftest import ROOT
from skeinwright import catalog
from skeinwright.functions import codecs
from skeinwright.operators import faults
from skeinwright.plans import scenario
from skeinwright.queries import runs
from skeinwright.sources import events, wal
from skeinwright.streaming import gaps, windows


def test_equal_frames_stay_rows_under_any_number_of_rules(spark):
    frames = spark.createDataFrame([("imu", 5.0)] * 3, "stream string, t_s double")
    for n in (0, 1, 200, 256, 257, 300, 600):
        rules = [faults.Rule("delay", None, 0.0, 10.0 if i % 100 == 7 else 1.0) for i in range(n)]
        rows = faults.with_active(frames, rules).collect()
        assert [[r.rule_id for r in row.active] for row in rows] == [[i for i in range(n) if i % 100 == 7]] * 3


def test_refused_records_are_counted(spark, tmp_path):
    big = codecs.MAX_PAYLOAD + 1
    rows = spark.range(3).selectExpr("id as pos", "id as timestamp_ns", "4 as sensor_type", "id as sequence", f"cast(repeat('x', if(id = 1, {big}, 3)) as binary) as payload")
    lines = [tuple(r) for r in wal.write_log(rows, f"file://{tmp_path}/log").collect()]
    assert sorted(lines, key=str) == sorted([(1, 2, 2 * (codecs.RECORD_OVERHEAD + 3)), (None, 1, big)], key=str)
    assert wal.read_log(spark, f"file://{tmp_path}/log").count() == 2
    assert not [p for p in (tmp_path / "log").iterdir() if p.name.startswith(".segment")]


def test_places_by_blocks(monkeypatch):
    rng = random.Random(1)
    data = b"".join(codecs.encode_records([(i, 4, i, rng.randbytes(rng.randint(0, 90))) for i in range(60)]))
    data = data[:500] + rng.randbytes(33) + data[500:] + rng.randbytes(50)
    want = []
    for at in range(len(data) - codecs.RECORD_OVERHEAD + 1):
        length, payload = (int.from_bytes(data[at + k : at + k + 4], "little") for k in (0, 22))
        if payload <= codecs.MAX_PAYLOAD and length == payload + codecs.RECORD_OVERHEAD and at + length <= len(data):
            want.append(at)
    assert len(want) > 50
    for block in (1, 3, 64, 1 << 20):
        monkeypatch.setattr(wal, "BLOCK", block)
        assert wal.plausible(data).tolist() == want
    assert wal.plausible(b"x" * 10).tolist() == [] and wal.plausible(b"").dtype == np.int64


def test_filters_reach_the_scan(spark, sf, capsys):
    known = catalog.queries()
    for name, column in {"replay_seek": "GreaterThanOrEqual(ts", "replay_schedule": "GreaterThanOrEqual(ts", "asof_align": "EqualTo(event_type", "set_ops": "EqualTo(event_type"}.items():
        known[name](spark, sf).explain("formatted")
        pushed = [line for line in capsys.readouterr().out.splitlines() if "PushedFilters" in line]
        assert pushed and all(column in line or "In(event_type" in line for line in pushed), (name, pushed)


def test_scenario_times():
    assert scenario.max_duration([]) == 0.0
    assert scenario.max_duration([scenario.Scenario("a", 3.0), scenario.Scenario("b", 7.5)]) == 7.5
    assert len(scenario.utc_now()) == 20 and scenario.utc_now().endswith("Z")


def _stream(spark, tmp_path, rows, schema, batches):
    """A streaming frame that reads one file a micro-batch."""
    for i, part in enumerate(batches):
        spark.createDataFrame(part, schema).coalesce(1).write.mode("append").parquet(f"{tmp_path}/{i}")
    folder = tmp_path / "in"
    folder.mkdir()
    for i in range(len(batches)):
        for f in (tmp_path / str(i)).glob("*.parquet"):
            shutil.move(f, folder / f"{i:03d}.parquet")
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).option("latestFirst", "false").parquet(str(folder))


def _drain(stream, tmp_path, spark):
    query = stream.writeStream.outputMode("append").format("parquet").option("checkpointLocation", f"{tmp_path}/c").trigger(availableNow=True).start(f"{tmp_path}/out")
    query.awaitTermination()
    return spark.read.parquet(f"{tmp_path}/out").collect()


def test_late_rows_are_dropped(spark, tmp_path):
    at = lambda h: h * 3_600_000_000
    parts = [[("a", at(1)), ("a", at(2))], [("a", at(30))], [("a", at(31))], [("a", at(3)), ("a", at(29)), ("a", at(60))]]
    stream = _stream(spark, tmp_path, None, "g string, us bigint", parts).select("g", F.timestamp_micros("us").alias("ts"))
    got = {(r.start_us // at(1), r.n) for r in _drain(windows.watermarked_counts(stream, "ts", "g", "12 hours", "6 hours"), tmp_path, spark)}
    assert got == {(0, 2), (24, 3)}  # the row of hour 3 came after the watermark of 24 hours


def test_bucket_and_gaps_as_streams(spark, tmp_path):
    rows = [("a" if i % 3 else "b", i, i * 40_000, None if i % 11 == 0 else 1.0, 20) for i in range(60)]
    schema = "stream string, id bigint, us bigint, kbps double, bytes bigint"
    want = {(r.stream, r.id): r.forwarded for r in faults.bandwidth_limited(spark.createDataFrame(rows, schema)).collect()}
    assert 0 < sum(want.values()) < 60
    stream = _stream(spark, tmp_path, None, schema, [rows[:20], rows[20:45], rows[45:]])
    got = {(r.stream, r.id): r.forwarded for r in _drain(faults.bandwidth_stream(stream), tmp_path, spark)}
    assert got == want
    (tmp_path / "g").mkdir()
    stream = _stream(spark, tmp_path / "g", None, "stream string, id bigint", [[("a", 65534), ("a", 65535)], [("a", 0), ("a", 2)], [("b", 5)]])
    found = {(r.stream, r.id): r.gap for r in _drain(gaps.gap_stream(stream), tmp_path / "g", spark)}
    assert found == {("a", 65534): False, ("a", 65535): False, ("a", 0): False, ("a", 2): True, ("b", 5): False}


def test_the_rest_works_without_the_training_data_subpackage(tmp_path):
    shutil.copytree(ROOT / "skeinwright", tmp_path / "skeinwright", ignore=shutil.ignore_patterns("llm", "__pycache__"))
    shutil.copy(ROOT / "__spark_entry__.py", tmp_path)
    for extra in ([], ["corpus_pipeline.py"]):
        for name in extra:
            shutil.copy(ROOT / name, tmp_path) if (ROOT / name).exists() else None
        code = "import __spark_entry__ as e; print(len(e.queries()), len(e.oracle_sql()))"
        done = subprocess.run([sys.executable, "-c", code], cwd=tmp_path, capture_output=True, text=True, timeout=120)
        assert done.returncode == 0, done.stderr
        assert int(done.stdout.split()[0]) == len(catalog.queries())


def test_scenario_story_reads_its_rates(spark, sf):
    rows = {r.metric: r for r in runs.scenario_run(spark, sf).collect()}
    assert rows["imu_drop_rate_pct"].actual != rows["gps_drop_rate_pct"].actual
    assert events.RATE_HZ not in runs.RATES.values()

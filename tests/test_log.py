"""The segmented log: names, resync against a byte-wise walk, append, empty folders."""

import random

import pytest
from pyspark.sql import functions as F

from skeinwright.functions import codecs
from skeinwright.sources import wal


def walk(data: bytes):
    """The scan as stated: one byte further after any error."""
    at, runs, skipped, inside, found = 0, 0, 0, False, []
    while at + codecs.RECORD_HEADER <= len(data):
        d = codecs.decode_records([data[at:]])[0]
        if d["error"] == "ok":
            found.append((at, d["payload"]))
            at, inside = at + d["record_length"], False
        else:
            runs, inside = runs + (not inside), True
            at, skipped = at + 1, skipped + 1
    if at < len(data):
        runs, skipped = runs + (not inside), skipped + len(data) - at
    return found, {"records_ok": len(found), "records_corrupt_skipped": runs, "bytes_skipped": skipped}


def test_names():
    assert wal.segment_name(7) == "segment-000007.sflog"
    assert [wal.segment_number(x) for x in ("segment-000007.sflog", "segment-1234567.sflog", "segment-.sflog", "segment-1x.sflog", "a", "segment-000000.sflog")] == [7, 1234567, 0, 0, 0, 0]


@pytest.mark.parametrize("seed", range(8))
def test_scan_is_the_bytewise_walk(seed):
    rng = random.Random(seed)
    data = bytearray(b"".join(codecs.encode_records([(i, 4, i, f"r{i}".encode() * rng.randint(0, 4)) for i in range(25)])))
    for _ in range(rng.randint(0, 4)):
        at = rng.randrange(len(data))
        data[at : at + rng.randint(1, 40)] = rng.randbytes(rng.randint(0, 50))
    data = bytes(data) + rng.randbytes(rng.choice([0, 3, 29, 40]))
    found, counts = wal.scan_segment(data)
    assert ([(at, p) for at, _, p in found], counts) == walk(data)


def test_write_read_append(spark, tmp_path):
    rows = spark.range(300).select(F.col("id").alias("pos"), (F.col("id") * 1000).alias("timestamp_ns"), F.lit(4).alias("sensor_type"), F.col("id").alias("sequence"), F.concat(F.lit("record-"), "id").alias("payload"))
    folder = f"file://{tmp_path}/log"
    assert wal.read_log(spark, folder).count() == 0
    lines = wal.write_log(rows, folder, 2048).collect()
    assert sum(r.records for r in lines) == 300 and all(r.bytes <= 2048 for r in lines)
    wal.write_log(rows.limit(10), folder, 2048).collect()
    back = wal.replay_order(wal.read_log(spark, folder)).collect()
    assert len(back) == 310
    assert [r.timestamp_ns for r in back] == sorted(r.timestamp_ns for r in back)
    stats = wal.read_log(spark, folder, stats=True).agg(F.sum("records_ok"), F.sum("bytes_skipped")).head()
    assert tuple(stats) == (310, 0)

"""The segmented log as Spark source and sink.

Segments are files ``segment-%06d.sflog`` with ids from 1. The source, format ``sflog``, reads each segment
in a partition of its own. The scan advances by whole records; at any error it moves on one byte, and a
run of skipped bytes counts as one corrupt record; trailing bytes that can't hold a header are skipped
too. A folder that is missing gives no rows. Fields that only look like a record are ruled out in numpy
before a checksum is taken.
"""

from __future__ import annotations

import re
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.fs as pafs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, DataSourceReader, DataSourceStreamReader, InputPartition, WriterCommitMessage

from ..functions import codecs
from ..functions.crc32c import checksums
from ..shipping import ship
from ..streaming.folds import ordered_fold

SEGMENT_BYTES = 64 << 20
_NAME = re.compile(r"segment-([0-9]+)\.sflog")
RECORDS = "segment_id bigint, at bigint, record_length bigint, timestamp_ns bigint, sensor_type int, sequence bigint, payload binary"
STATS = "segment_id bigint, records_ok bigint, records_corrupt_skipped bigint, bytes_skipped bigint"


#: Bytes of a segment that are looked at in one step.
BLOCK = 1 << 20


def segment_name(number: int) -> str:
    return f"segment-{number:06d}.sflog"


def segment_number(name: str) -> int:
    """The id in a segment's name; 0 for other names."""
    found = _NAME.fullmatch(name)
    return int(found[1]) if found else 0


def plausible(data: bytes) -> np.ndarray:
    """Places whose length fields fit each other and the data: all that can begin a record. The two fields are
    compared as words of the data itself, at the four alignments, ``BLOCK`` bytes at a time."""
    n = len(data) - codecs.RECORD_OVERHEAD + 1
    found = [np.empty(0, np.int64)]
    for low in range(0, n, BLOCK):
        high, own = min(n, low + BLOCK), []
        for at in range(low, min(low + 4, high)):
            many = (high - at + 3) // 4
            length, payload = (np.frombuffer(data, "<u4", many, at + k) for k in (0, 22))
            fits = np.flatnonzero((payload <= codecs.MAX_PAYLOAD) & (length == payload + np.uint32(codecs.RECORD_OVERHEAD)))
            places = at + 4 * fits
            own.append(places[places + length[fits] <= len(data)])
        found.append(np.sort(np.concatenate(own)))
    return np.concatenate(found)


def scan_segment(data: bytes) -> tuple[list[tuple[int, tuple, bytes]], dict]:
    """((place, fields, payload) of each record, counters)."""
    places = plausible(data).tolist()
    lengths = [int.from_bytes(data[p : p + 4], "little") for p in places]
    heads = codecs.RECORD_HEADER
    # two checksums for each place that may hold a record, in blocks of bounded bytes
    good: set[int] = set()
    block: list[int] = []
    held = 0
    for i, (p, length) in enumerate(zip(places, lengths, strict=True)):
        block.append(i)
        held += length
        if held > 16 << 20 or i == len(places) - 1:
            bodies = checksums([data[places[j] + heads : places[j] + lengths[j] - 4] for j in block]).tolist()
            wholes = checksums([data[places[j] : places[j] + lengths[j] - 4] for j in block]).tolist()
            for j, body, whole in zip(block, bodies, wholes, strict=True):
                q = places[j]
                if int.from_bytes(data[q + 26 : q + 30], "little") == body and int.from_bytes(data[q + lengths[j] - 4 : q + lengths[j]], "little") == whole:
                    good.add(q)
            block, held = [], 0
    found, at, runs, skipped = [], 0, 0, 0
    for p, length in zip(places, lengths, strict=True):
        if p not in good or p < at:
            continue
        if p > at:
            runs, skipped = runs + 1, skipped + p - at
        fields = codecs._RECORD.unpack_from(data, p)
        found.append((p, fields, data[p + heads : p + heads + fields[4]]))
        at = p + length
    if at < len(data):
        runs, skipped = runs + 1, skipped + len(data) - at
    return found, {"records_ok": len(found), "records_corrupt_skipped": runs, "bytes_skipped": skipped}


def _store(uri: str) -> tuple[pafs.FileSystem, str]:
    return pafs.FileSystem.from_uri(uri if "://" in uri else "file:" + uri.removeprefix("file:"))


class _Segment(InputPartition):
    def __init__(self, number: int, path: str) -> None:
        self.number, self.path = number, path


class _Reader(DataSourceReader):
    def __init__(self, folder: str, stats: bool) -> None:
        self.folder, self.stats = folder, stats

    def partitions(self) -> list[_Segment]:
        fs, root = _store(self.folder)
        listed = fs.get_file_info(pafs.FileSelector(root, allow_not_found=True))
        segments = sorted((n, f.path) for f in listed if f.is_file and (n := segment_number(f.base_name)))
        return [_Segment(n, path) for n, path in segments] or [_Segment(0, "")]

    def read(self, partition: _Segment) -> Iterator[tuple]:
        if not partition.number:
            return
        fs, _ = _store(self.folder)
        with fs.open_input_file(partition.path) as f:
            data = f.read()
        found, counts = scan_segment(data)
        if self.stats:
            yield (partition.number, *counts.values())
            return
        for at, (length, ts, kind, sequence, _, _), payload in found:
            yield partition.number, at, length, ts, kind, sequence, payload


class _StreamReader(DataSourceStreamReader):
    """Segments as they are finished: a segment's file has its name only when it is whole."""

    def __init__(self, folder: str, stats: bool) -> None:
        self.batch = _Reader(folder, stats)

    def initialOffset(self) -> dict:
        return {"segment": 0}

    def latestOffset(self) -> dict:
        return {"segment": max(p.number for p in self.batch.partitions())}

    def partitions(self, start: dict, end: dict) -> list[_Segment]:
        return [p for p in self.batch.partitions() if start["segment"] < p.number <= end["segment"]]

    def read(self, partition: _Segment) -> Iterator[tuple]:
        return self.batch.read(partition)

    def commit(self, end: dict) -> None:
        pass


class _Files(WriterCommitMessage):
    def __init__(self, partition: int, paths: list[str]) -> None:
        self.partition, self.paths = partition, paths


class _Writer(DataSourceArrowWriter):
    """Every task rolls segments of its own under hidden names; the commit numbers them in the order of the
    partitions, so a frame sorted by its place is written in that order, and no task sees the whole log."""

    def __init__(self, folder: str, limit: int, overwrite: bool) -> None:
        self.folder, self.limit, self.overwrite = folder, limit, overwrite

    def write(self, iterator: Iterator[pa.RecordBatch]) -> _Files:
        fs, root = _store(self.folder)
        fs.create_dir(root, recursive=True)
        attempt, paths, out, held = uuid.uuid4().hex, [], None, 0
        for batch in iterator:
            rows = list(zip(*(batch.column(batch.schema.get_field_index(c)).to_pylist() for c in ("timestamp_ns", "sensor_type", "sequence", "payload")), strict=True))
            for raw in codecs.encode_records(rows):
                if raw is None:
                    raise ValueError(f"a payload is over the format's limit of {codecs.MAX_PAYLOAD} bytes")
                if out is None or held + len(raw) > self.limit:
                    if out is not None:
                        out.close()
                    paths.append(f"{root}/.part-{attempt}-{len(paths)}")
                    out, held = fs.open_output_stream(paths[-1]), 0
                out.write(raw)
                held += len(raw)
        if out is not None:
            out.close()
        return _Files(TaskContext.get().partitionId(), paths)

    def commit(self, messages: list[_Files | None]) -> None:
        fs, root = _store(self.folder)
        there = [(n, f.path) for f in fs.get_file_info(pafs.FileSelector(root, allow_not_found=True)) if (n := segment_number(f.base_name))]
        if self.overwrite:
            for _, path in there:
                fs.delete_file(path)
            there = []
        number = max((n for n, _ in there), default=0)
        for m in sorted((m for m in messages if m), key=lambda m: m.partition):
            for path in m.paths:
                number += 1
                fs.move(path, f"{root}/{segment_name(number)}")

    def abort(self, messages: list[_Files | None]) -> None:
        fs, _ = _store(self.folder)
        for path in (p for m in messages if m for p in m.paths):
            fs.delete_file(path)


class LogSource(DataSource):
    """Reads in batch and as a stream, and writes rows (timestamp_ns, sensor_type, sequence, payload). Options: path;
    stats=true for one row of counters a segment; segmentBytes, the size at which a written segment ends."""

    @classmethod
    def name(cls) -> str:
        return "sflog"

    def _stats(self) -> bool:
        return str(self.options.get("stats", "false")).lower() == "true"

    def schema(self) -> str:
        return STATS if self._stats() else RECORDS

    def reader(self, schema) -> DataSourceReader:
        return _Reader(self.options["path"], self._stats())

    def streamReader(self, schema) -> DataSourceStreamReader:
        return _StreamReader(self.options["path"], self._stats())

    def writer(self, schema, overwrite: bool) -> DataSourceArrowWriter:
        missing = {"timestamp_ns", "sensor_type", "sequence", "payload"} - set(schema.names)
        if missing:
            raise ValueError(f"columns missing: {sorted(missing)}")
        return _Writer(self.options["path"], int(self.options.get("segmentBytes", SEGMENT_BYTES)), overwrite)


def read_log(spark: SparkSession, folder: str, stats: bool = False) -> DataFrame:
    ship(spark)
    spark.dataSource.register(LogSource)
    return spark.read.format("sflog").option("stats", str(stats).lower()).load(folder)


def stream_log(spark: SparkSession, folder: str) -> DataFrame:
    """The log as a stream: each micro-batch has the segments finished since the last."""
    ship(spark)
    spark.dataSource.register(LogSource)
    return spark.readStream.format("sflog").load(folder)


def save_log(df: DataFrame, folder: str, limit: int = SEGMENT_BYTES, mode: str = "append") -> None:
    """Writes rows in the order of their partitions, in parallel: for a log in replay order sort them first.
    Against ``write_log`` each partition's last segment may be short. A payload over the format's limit fails
    the write, which then leaves no segment."""
    spark = df.sparkSession
    ship(spark)
    spark.dataSource.register(LogSource)
    rows = df.select("timestamp_ns", "sensor_type", "sequence", F.col("payload").cast("binary").alias("payload"))
    rows.write.format("sflog").option("segmentBytes", str(limit)).mode(mode).save(folder)


def replay_order(df: DataFrame) -> DataFrame:
    """Rows in replay order; ties by place keep the order stable."""
    return df.orderBy("timestamp_ns", "sequence", "segment_id", "at")


def assign_segments(df: DataFrame, limit: int = SEGMENT_BYTES, first: int = 1) -> DataFrame:
    """(log, pos, segment_id, at) of rows (log, pos, length): a record that doesn't fit begins a new segment,
    unless the segment is empty."""

    def start() -> tuple[int, int]:
        return first, 0

    def step(state, row):
        number, at = state
        if at and at + row["length"] > limit:
            number, at = number + 1, 0
        return (number, at + row["length"]), [{"log": row["log"], "pos": row["pos"], "segment_id": number, "at": at}]

    return ordered_fold(df.select("log", "pos", F.col("length").cast("long").alias("length")), "log", ["pos"], start, step, "log string, pos bigint, segment_id bigint, at bigint")


def write_log(df: DataFrame, folder: str, limit: int = SEGMENT_BYTES) -> DataFrame:
    """Appends rows (pos, timestamp_ns, sensor_type, sequence, payload) in the order of pos; goes on behind
    the last segment there is. Returns (segment_id, records, bytes); payloads over the format's limit can't be
    written and are counted, with their bytes, in a row whose segment_id is null."""
    spark = df.sparkSession
    ship(spark)
    fs, root = _store(folder)
    fs.create_dir(root, recursive=True)
    there = [segment_number(f.base_name) for f in fs.get_file_info(pafs.FileSelector(root))]
    every = df.withColumn("payload", F.coalesce(F.col("payload").cast("binary"), F.lit(b"")))
    rows = every.filter(F.octet_length("payload") <= codecs.MAX_PAYLOAD)
    refused = every.filter(F.octet_length("payload") > codecs.MAX_PAYLOAD).agg(
        F.lit(None).cast("long").alias("segment_id"), F.count(F.lit(1)).alias("records"), F.sum(F.octet_length("payload").cast("long")).alias("bytes")
    ).filter("records > 0")
    sized = rows.select(F.lit("log").alias("log"), "pos", (F.octet_length("payload") + codecs.RECORD_OVERHEAD).alias("length"))
    placed = assign_segments(sized, limit, max([0, *there]) + 1).select(F.col("pos").alias("p"), "segment_id")
    both = rows.join(placed, F.col("pos") == F.col("p")).drop("p")
    record = codecs.encode_record(F.col("timestamp_ns"), F.col("sensor_type"), F.col("sequence"), F.col("payload"))
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    dealt = both.select("segment_id", "pos", record.alias("record")).repartition(n, "segment_id").sortWithinPartitions("segment_id", "pos")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, base = _store(folder)
        current, out, counts, done = None, None, [0, 0], []
        attempt = uuid.uuid4().hex  # a task that is run again or twice at a time has files of its own

        def close() -> None:
            if out is not None:
                out.close()
                store.move(f"{base}/.{segment_name(current)}-{attempt}", f"{base}/{segment_name(current)}")
                done.append((current, *counts))

        for batch in batches:
            for number, raw in zip(batch.column(0).to_pylist(), batch.column(2).to_pylist(), strict=True):
                if number != current:
                    close()
                    current, counts = number, [0, 0]
                    out = store.open_output_stream(f"{base}/.{segment_name(number)}-{attempt}")
                out.write(raw)
                counts[0] += 1
                counts[1] += len(raw)
        close()
        yield pa.RecordBatch.from_arrays([pa.array([d[i] for d in done], pa.int64()) for i in range(3)], ["segment_id", "records", "bytes"])

    return dealt.mapInArrow(run, "segment_id bigint, records bigint, bytes bigint").unionByName(refused)

"""Checksums, frames, records and messages: vectors, round trips, every kind of damage."""

import random

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from skeinwright.functions import codecs
from skeinwright.functions.crc32c import checksums

VECTORS = {b"": 0, b"123456789": 0xE3069283, bytes(32): 0x8A9136AA, b"\xff" * 32: 0x62A8AB43, bytes(range(32)): 0x46DD794E, bytes(range(31, -1, -1)): 0x113FDB5C}


def slow_crc(data: bytes) -> int:
    c = 0xFFFFFFFF
    for x in data:
        c ^= x
        for _ in range(8):
            c = (c >> 1) ^ (0x82F63B78 if c & 1 else 0)
    return c ^ 0xFFFFFFFF


def test_vectors():
    assert checksums(list(VECTORS)).tolist() == list(VECTORS.values())


@settings(max_examples=40, deadline=None)
@given(st.lists(st.binary(max_size=700), max_size=6))
def test_checksums_by_loop(buffers):
    assert checksums(buffers).tolist() == [slow_crc(b) for b in buffers]


@pytest.mark.parametrize("size", [0, 1, 64, 256, 1024, 65536])
@pytest.mark.parametrize("sensor", [1, 2, 3, 4, 5])
def test_frame_round_trip(size, sensor):
    rng = random.Random(size * 7 + sensor)
    payload = rng.randbytes(size)
    rows = [(sensor, s, (s * 1000 + 7) % 2**64, codecs.COMPRESSED, payload) for s in (0, 1, 1234567, 2**64 - 1)]
    frames = codecs.encode_frames(rows)
    assert all(len(f) == 40 + size for f in frames)
    for row, d in zip(rows, codecs.decode_frames([f + b"tail" for f in frames]), strict=True):
        assert d["error"] == "ok"
        assert (d["sensor_type"], d["sequence"], d["timestamp_ns"], d["flags"], d["payload"]) == row


def test_every_flipped_bit_is_seen():
    frame = codecs.encode_frames([(3, 5, 9, 0, b"payload bytes")])[0]
    damaged = [bytes(b ^ 0x40 if i == k else b for i, b in enumerate(frame)) for k in range(len(frame))]
    assert all(d["error"] != "ok" for d in codecs.decode_frames(damaged))
    record = codecs.encode_records([(9, 3, 5, b"payload bytes")])[0]
    damaged = [bytes(b ^ 0x80 if i == k else b for i, b in enumerate(record)) for k in range(len(record))]
    assert all(d["error"] != "ok" for d in codecs.decode_records(damaged))


def test_short_frames_and_nulls():
    frame = codecs.encode_frames([(1, 1, 1, 0, b"x")])[0]
    assert {d["error"] for d in codecs.decode_frames([frame[:k] for k in range(40)])} == {"truncated_header"}
    assert codecs.decode_frames([None, frame[:-1]])[0] is None
    assert codecs.decode_frames([frame[:-1]])[0]["error"] == "truncated_payload"
    assert codecs.encode_frames([(1, 1, 1, 0, bytes((4 << 20) + 1))]) == [None]


@settings(max_examples=60, deadline=None)
@given(st.binary(max_size=200))
def test_any_bytes_decode_without_error(data):
    assert codecs.decode_frames([data])[0]["error"] != "ok"
    assert codecs.decode_records([data])[0]["error"] != "ok"

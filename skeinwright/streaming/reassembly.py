"""Byte streams cut at will, put together again: AB CD, a length, a payload."""

from __future__ import annotations

from pyspark.sql import DataFrame

from .folds import ordered_fold, stateful_stream

MAX_PAYLOAD = 8 << 20
OUT = "conn bigint, n bigint, payload binary, resyncs bigint"


def start() -> tuple:
    """(tail bytes, payloads so far, resyncs so far)."""
    return (b"", 0, 0)


def make_step(byte_order: str = "big", most: int = MAX_PAYLOAD):
    """A byte after AB that is neither AB nor CD, and a length over ``most``, count as a resync each."""

    def step(state: tuple, row: dict) -> tuple[tuple, list[dict]]:
        tail, n, resyncs = state
        data, at, made = tail + (row["chunk"] or b""), 0, []
        while True:
            mark = data.find(b"\xab", at)
            if mark < 0:
                data = b""
                break
            if mark + 1 >= len(data):
                data = data[mark:]
                break
            if data[mark + 1] != 0xCD:
                if data[mark + 1] == 0xAB:
                    at = mark + 1
                else:
                    at, resyncs = mark + 2, resyncs + 1
                continue
            if mark + 6 > len(data):
                data = data[mark:]
                break
            size = int.from_bytes(data[mark + 2 : mark + 6], byte_order)
            if size > most:
                at, resyncs = mark + 6, resyncs + 1
                continue
            if mark + 6 + size > len(data):
                data = data[mark:]
                break
            n += 1
            made.append({"conn": row["conn"], "n": n, "payload": data[mark + 6 : mark + 6 + size], "resyncs": resyncs})
            at = mark + 6 + size
        return (data, n, resyncs), made

    return step


def reassemble(df: DataFrame, byte_order: str = "big", most: int = MAX_PAYLOAD) -> DataFrame:
    """The payloads of chunks (conn, pos, chunk), taken by pos."""
    return ordered_fold(df.select("conn", "pos", "chunk"), "conn", ["pos"], start, make_step(byte_order, most), OUT)


def reassemble_stream(df: DataFrame, byte_order: str = "big", most: int = MAX_PAYLOAD) -> DataFrame:
    rows = df.select("conn", "pos", "chunk")
    return stateful_stream(rows, "conn", ["pos"], start, make_step(byte_order, most), OUT, "tail binary, n bigint, resyncs bigint", tuple, lambda s: (bytes(s[0]), s[1], s[2]))

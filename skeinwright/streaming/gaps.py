"""The gap detector over a stream: each row against the sequence number before it, kept in the state store."""

from __future__ import annotations

from pyspark.sql import DataFrame

from .folds import stateful_stream

OUT = "stream string, id bigint, gap boolean"
MODULUS = 65536


def start() -> int | None:
    return None


def step(state: int | None, row: dict) -> tuple[int, list[dict]]:
    now = row["id"] % MODULUS
    gap = state is not None and now != (state + 1) % MODULUS
    return now, [{"stream": row["stream"], "id": row["id"], "gap": gap}]


def gap_stream(df: DataFrame) -> DataFrame:
    """(stream, id, gap) of rows (stream, id): whether a row isn't its predecessor's successor, modulo 65536."""
    rows = df.select("stream", "id")
    return stateful_stream(rows, "stream", ["id"], start, step, OUT, "last int", lambda s: (-1 if s is None else int(s),), lambda s: None if s[0] < 0 else int(s[0]))

"""Coordinate-transform streams: pattern filters, the latest of each pair, reversed pairs, and the cache
that a reversed pair clears."""

from __future__ import annotations

import json

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .folds import ordered_fold, stateful_stream


def pattern_filter(df: DataFrame, exclude: list[str], include: list[str], frame: str = "frame_id", child: str = "child_frame_id") -> DataFrame:
    """Drops rows with an id that an exclude pattern matches whole; if there are include patterns, one of
    them must match an id."""

    def either(patterns: list[str]):
        out = F.lit(False)
        for p in patterns:
            out = out | F.col(frame).rlike(f"^(?:{p})$") | F.col(child).rlike(f"^(?:{p})$")
        return out

    kept = df.filter(~either(exclude)) if exclude else df
    return kept.filter(either(include)) if include else kept


def latest(df: DataFrame, order: str, value: str, frame: str = "frame_id", child: str = "child_frame_id") -> DataFrame:
    return df.groupBy(frame, child).agg(F.max_by(value, order).alias(value), F.max(order).alias(order))


def conflicts(df: DataFrame, frame: str = "frame_id", child: str = "child_frame_id") -> DataFrame:
    """Pairs that occur in both directions, each once, with the row counts of both."""
    counts = df.filter(F.col(frame) != F.col(child)).groupBy(F.least(frame, child).alias("a"), F.greatest(frame, child).alias("b"))
    both = counts.agg(F.sum((F.col(frame) < F.col(child)).cast("long")).alias("forward"), F.sum((F.col(frame) > F.col(child)).cast("long")).alias("backward"))
    return both.filter("forward > 0 and backward > 0")


OUT = "topic string, pos bigint, size bigint, reset boolean, transforms string"


def start() -> dict:
    return {"pairs": [], "closed": False}


def step(state: dict, row: dict) -> tuple[dict, list[dict]]:
    """One message (topic, pos, transforms: list of {frame, child, value}). A reversed pair clears the cache,
    ends the subscription, and discards the rest of its message; every other message emits the cache.
    A null message has no transforms."""
    if state["closed"]:
        return state, []
    pairs = {(f, c): v for f, c, v in state["pairs"]}
    for t in [] if row["transforms"] is None else row["transforms"]:
        key = (t["frame"], t["child"])
        if key not in pairs and key[::-1] in pairs:
            return {"pairs": [], "closed": True}, [{"topic": row["topic"], "pos": row["pos"], "size": 0, "reset": True, "transforms": "[]"}]
        pairs[key] = t["value"]
    state = {"pairs": [[*k, v] for k, v in pairs.items()], "closed": False}
    return state, [{"topic": row["topic"], "pos": row["pos"], "size": len(pairs), "reset": False, "transforms": json.dumps(state["pairs"])}]


def _messages(df: DataFrame, stamp: str | None) -> DataFrame:
    if stamp is None:
        return df.select("topic", "pos", "transforms")
    return df.select("topic", "pos", F.transform("transforms", lambda t: t.withField(stamp, F.lit(0).cast("long"))).alias("transforms"))


def static_step(state: dict, row: dict) -> tuple[dict, list[dict]]:
    """The same for transforms {frame, child, stamp, value}; each cached entry keeps its stamp beside its value."""
    held = None if row["transforms"] is None else [{"frame": t["frame"], "child": t["child"], "value": [t["stamp"], t["value"]]} for t in row["transforms"]]
    return step(state, {**row, "transforms": held})


def cache(df: DataFrame, stamped: bool = False, static: bool = False) -> DataFrame:
    """What each message (topic, pos, transforms) emits. ``stamped`` transforms have a field stamp (long) and are
    emitted as [frame, child, [stamp, value]]; on ``static`` topics every emitted stamp is zero."""
    rows = _messages(df, "stamp" if static else None)
    return ordered_fold(rows, "topic", ["pos"], start, static_step if stamped or static else step, OUT)


def cache_stream(df: DataFrame, stamped: bool = False, static: bool = False) -> DataFrame:
    rows = _messages(df, "stamp" if static else None)
    taken = static_step if stamped or static else step
    return stateful_stream(rows, "topic", ["pos"], start, taken, OUT, "state string", lambda s: (json.dumps(s),), lambda s: json.loads(s[0]))

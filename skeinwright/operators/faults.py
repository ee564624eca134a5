"""Time-windowed faults on a stream of frames, as one map over rows wherever order plays no part.

Rules are few, so they go into the plan as a literal array, and the rules that are active for a frame are
a filter of it: no join and no shuffle. More than ``MAX_RULES`` rules are joined as a broadcast table
instead. Order of the stages: restart edges, suppression, random drops, bandwidth, corruption, reorder (whose
frames skip duplication), delay, duplication.
"""

from __future__ import annotations

from dataclasses import asdict, dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.codecs import flip_bits
from ..streaming.folds import ordered_fold, stateful_stream
from .ordered import lag_across, numbered

MAX_RULES = 256
SLICE = 4096
#: Names of the fault kinds and of their alias (fixed values).
KINDS = ("delay", "drop", "duplicate", "corrupt", "reorder", "burst_loss", "bandwidth_limit", "ecu_disconnect", "process_restart")
ALIASES = {"burst": "burst_loss"}


@dataclass(frozen=True)
class Rule:
    kind: str
    stream: str | None = None
    start_s: float = 0.0
    duration_s: float = 1e9
    delay_ms: float = 0.0
    drop_rate: float = 0.0
    bandwidth_kbps: float = 0.0
    corrupt_bits: int = 4


SCHEMA = "rule_id int, kind string, stream string, start_s double, duration_s double, delay_ms double, drop_rate double, bandwidth_kbps double, corrupt_bits int"


def rules_table(spark, rules: list[Rule]) -> DataFrame:
    return spark.createDataFrame([(i, *asdict(r).values()) for i, r in enumerate(rules)], SCHEMA)


def rules_sql(rules: list[Rule]) -> str:
    """A VALUES list with the columns of SCHEMA."""
    show = lambda v: "NULL" if v is None else f"'{v}'" if isinstance(v, str) else f"CAST({v!r} AS DOUBLE)" if isinstance(v, float) else str(v)
    rows = ", ".join("(" + ", ".join(show(v) for v in (i, *asdict(r).values())) + ")" for i, r in enumerate(rules))
    names = ", ".join(part.split()[0] for part in SCHEMA.split(", "))
    return f"rules({names}) AS (VALUES {rows})"


def is_active(rule: Column, stream: Column, t: Column) -> Column:
    """Half-open window; a rule without a stream is for all."""
    return (rule["stream"].isNull() | (rule["stream"] == stream)) & (t >= rule["start_s"]) & (t < rule["start_s"] + rule["duration_s"])


def with_active(frames: DataFrame, rules: list[Rule]) -> DataFrame:
    """Adds array ``active`` with the rules that hold at t_s for the stream, in the order of the rules.

    Rules are literals of the plan, ``MAX_RULES`` to an array, however many there are: every frame stays one row,
    equal ones too, and nothing is joined."""
    names = [part.split() for part in SCHEMA.split(", ")]
    structs = [
        F.struct(*[F.lit(v).cast(kind).alias(name) for v, (name, kind) in zip((i, *asdict(r).values()), names, strict=True)])
        for i, r in enumerate(rules)
    ]
    chunks = [F.array(*structs[k : k + MAX_RULES]) for k in range(0, len(structs), MAX_RULES)]
    if not chunks:
        chunks = [F.from_json(F.lit("[]"), f"array<struct<{', '.join(f'{n}: {k}' for n, k in names)}>>")]
    hold = [F.filter(c, lambda r: is_active(r, F.col("stream"), F.col("t_s"))) for c in chunks]
    return frames.withColumn("active", F.concat(*hold) if len(hold) > 1 else hold[0])


def has(*kinds: str) -> Column:
    return F.exists("active", lambda r: r["kind"].isin(*kinds))


def suppressed() -> Column:
    return has("burst_loss", "ecu_disconnect")


def draws_drop(seed: int) -> Column:
    """Each active drop rule draws by a portable hash of the frame's id."""
    draw = lambda r: F.pmod(F.col("id") * 2654435761 + F.lit(seed) + r["rule_id"], F.lit(4294967296)) / F.lit(4294967296.0)
    return F.exists("active", lambda r: (r["kind"] == "drop") & (draw(r) < r["drop_rate"]))


def delay_ms() -> Column:
    return F.coalesce(F.array_max(F.transform(F.filter("active", lambda r: r["kind"] == "delay"), lambda r: r["delay_ms"])), F.lit(0.0))


def duplicates() -> Column:
    return F.size(F.filter("active", lambda r: r["kind"] == "duplicate"))


def copies(frames: DataFrame) -> DataFrame:
    """One row for each emission: ``copy`` 0, and one more for each active duplicate rule."""
    return frames.withColumn("copy", F.explode(F.sequence(F.lit(0), duplicates())))


def delayed(frames: DataFrame, as_built: bool = False) -> DataFrame:
    """Adds ``due_us`` and the latency with its delay. as_built: the delay moves only the order."""
    shifted = frames.withColumn("delay", delay_ms()).withColumn("due_us", F.col("us") + F.round(F.col("delay") * 1000).cast("long"))
    return shifted if as_built else shifted.withColumn("latency", F.col("latency") + F.col("delay"))


def restart_edges(frames: DataFrame, order: str = "id") -> DataFrame:
    """The first frame under a restart rule in each stretch that no frame without any active rule breaks."""
    # only frames that are quiet or under a restart rule matter
    rows = frames.withColumn("quiet", F.size("active") == 0).withColumn("restart", has("process_restart")).filter("quiet or restart")
    before = lag_across(rows, "stream", order, "restart", F.floor(F.col(order) / SLICE), "before")
    return before.filter(F.col("restart") & ~F.coalesce("before", F.lit(False))).drop("quiet", "restart", "before")


def reordered(frames: DataFrame, order: str = "id") -> DataFrame:
    """Adjacent frames of a stream under a reorder rule swap; an odd last one is lost (``held_lost``).

    Adds ``out_pos``: twice the place of the frame that lets it out, less one where it goes first."""
    hit = has("reorder")
    others = frames.filter(~hit).withColumn("held_lost", F.lit(False)).withColumn("out_pos", (F.col(order) * 2).cast("long"))
    rows = numbered(frames.filter(hit), "stream", [order], F.floor(F.col(order) / SLICE), "_rn")
    pairs = Window.partitionBy("stream", F.floor(F.col("_rn") / 2)).orderBy(order)
    rows = rows.withColumn("_next", F.lead(order).over(pairs))
    first = F.col("_rn") % 2 == 0
    place = F.when(first, F.col("_next") * 2 + 1).otherwise(F.col(order) * 2).cast("long")
    rows = rows.withColumn("held_lost", first & F.col("_next").isNull()).withColumn("out_pos", place)
    return rows.drop("_rn", "_next").unionByName(others)


def corrupted(frames: DataFrame, seed: int = 1, bits: int = 4, payload: str = "payload") -> DataFrame:
    """Flips bits of the payload of frames under a corrupt rule; only these rows go through Python."""
    hit = has("corrupt")
    changed = frames.filter(hit).withColumn(payload, flip_bits(F.col(payload), F.col("id"), bits, seed))
    return changed.unionByName(frames.filter(~hit).withColumn(payload, F.col(payload).cast("binary")))


BUCKET_OUT = "stream string, id bigint, forwarded boolean"


def bucket_start() -> tuple | None:
    return None


def bucket_step(state: tuple | None, row: dict) -> tuple[tuple | None, list[dict]]:
    """One frame: one second of bytes at most in the bucket, full at first; a frame over the tokens left is
    dropped and takes none."""
    verdict = True
    if row["kbps"] is not None and row["kbps"] > 0:
        cap = row["kbps"] * 125.0
        tokens, last = state or (cap, row["us"])
        tokens = min(cap, tokens + (row["us"] - last) / 1e6 * cap)
        verdict = tokens >= row["bytes"]
        state = (tokens - row["bytes"] if verdict else tokens, row["us"])
    return state, [{"stream": row["stream"], "id": row["id"], "forwarded": verdict}]


def bandwidth_limited(frames: DataFrame, size: str = "bytes") -> DataFrame:
    """Token bucket per stream, in event time. Rows (stream, id, us, kbps, bytes); those without a limit (kbps null
    or 0) are forwarded as they come, and only the others are put in order."""
    rows = frames.select("stream", "id", "us", "kbps", F.col(size).cast("long").alias("bytes"))
    free = rows.filter("kbps is null or kbps <= 0").select("stream", "id", F.lit(True).alias("forwarded"))
    return free.unionByName(ordered_fold(rows.filter("kbps > 0"), "stream", ["id"], bucket_start, bucket_step, BUCKET_OUT))


def bandwidth_stream(frames: DataFrame) -> DataFrame:
    """The same over a streaming frame; the bucket lives in the state store."""
    rows = frames.select("stream", "id", "us", "kbps", "bytes")
    return stateful_stream(
        rows, "stream", ["id"], bucket_start, bucket_step, BUCKET_OUT, "tokens double, last bigint",
        lambda s: (float("nan"), 0) if s is None else (float(s[0]), int(s[1])), lambda s: None if s[0] != s[0] else (s[0], s[1]),
    )


def kbps() -> Column:
    """The limit of the first active bandwidth rule, or null."""
    return F.get(F.filter("active", lambda r: (r["kind"] == "bandwidth_limit") & (r["bandwidth_kbps"] > 0)), F.lit(0))["bandwidth_kbps"]


def disposition(seed: int) -> Column:
    """What becomes of a frame, bandwidth apart."""
    return F.when(suppressed() | draws_drop(seed), "dropped").otherwise("forwarded")


def apply_faults(frames: DataFrame, rules: list[Rule], seed: int = 42) -> DataFrame:
    """All stages but restart edges, over frames (stream, id, us, t_s, latency, payload): one row for each
    emission, with ``due_us``, ``out_pos`` and ``copy``."""
    if not rules:
        return frames.withColumn("delay", F.lit(0.0)).withColumn("due_us", F.col("us")).withColumn("out_pos", F.col("id") * 2).withColumn("copy", F.lit(0))
    kinds = {r.kind for r in rules}
    kept = with_active(frames, rules).filter(~suppressed() & ~draws_drop(seed))
    if "bandwidth_limit" in kinds:
        sized = kept.withColumn("kbps", kbps()).withColumn("bytes", F.octet_length("payload"))
        limited = sized.filter("kbps is not null")
        passed = bandwidth_limited(limited).filter("forwarded").select(F.col("id").alias("_id"), F.col("stream").alias("_st"))
        kept = sized.filter("kbps is null").unionByName(limited.join(passed, (F.col("id") == F.col("_id")) & (F.col("stream") == F.col("_st")), "left_semi")).drop("kbps", "bytes")
    if "corrupt" in kinds:
        kept = corrupted(kept, seed)
    kept = reordered(kept).filter("not held_lost").drop("held_lost") if "reorder" in kinds else kept.withColumn("out_pos", F.col("id") * 2)
    out = delayed(kept)
    if "duplicate" in kinds:
        out = out.withColumn("copy", F.explode(F.sequence(F.lit(0), F.when(has("reorder"), 0).otherwise(duplicates()))))
    else:
        out = out.withColumn("copy", F.lit(0))
    return out.drop("active")

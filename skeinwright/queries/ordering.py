"""Ordered rows, the monotonicity filter, queues, transforms and faults."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import codecs
from ..operators import faults, ordered
from ..sources import events
from ..streaming import monotonic, queues, transforms

DAY, HOUR = events.DAY_US, 3_600_000_000
R = faults.Rule
D = 86_400.0
RULES = [
    R("burst_loss", "lidar", 0.0, D),
    R("delay", None, 2 * D, D, delay_ms=25.0),
    R("duplicate", "imu", 3 * D, D),
    R("reorder", "camera", 4 * D, D),
    R("drop", "can", 0.0, 1e9, drop_rate=0.1),
    R("process_restart", "imu", 5 * D, D),
    R("delay", "imu", 6 * D, 3 * D, delay_ms=5.0),
    R("process_restart", "imu", 9 * D, D),
    R("corrupt", "gps", 7 * D, D, corrupt_bits=3),
    R("ecu_disconnect", "gps", 10 * D, 2 * D),
]
SEED = 42
DRAW = f"((id * 2654435761 + {SEED} + rule_id) % 4294967296) / 4294967296e0"
CAPACITY, PERIOD = 7, 24 * 60 * 1_000_000
KBPS = 0.2


def _frames(spark, sf):
    return events.frames(spark, sf).withColumn("t_s", (F.col("us") - events.START_US) / 1e6)


def _active(spark, sf, *kinds):
    return faults.with_active(_frames(spark, sf), [r for r in RULES if not kinds or r.kind in kinds])


def assign_sequence(spark, sf):
    rows = events.frames(spark, sf).select("stream", "id", "us")
    return ordered.numbered(rows, "stream", ["us", "id"], F.floor(F.col("us") / DAY)).select("stream", "id", "sequence")


def replay_order(spark, sf):
    rows = events.frames(spark, sf).select(F.lit("log").alias("log"), "id", "us")
    return ordered.numbered(rows, "log", ["us", "id"], F.floor(F.col("us") / HOUR), "place").select("id", "place")


def replay_index(spark, sf):
    rows = events.frames(spark, sf).select("us", "id", (F.octet_length("payload") + codecs.RECORD_OVERHEAD).alias("record_length"))
    return rows.orderBy("us", "id")


def replay_seek(spark, sf):
    return events.frames(spark, sf, since_us=events.START_US + 20 * DAY).select("id", "us")


def replay_schedule(spark, sf):
    rows = events.frames(spark, sf, since_us=events.START_US + 25 * DAY).select("id", "us")
    return ordered.schedule(rows, "us", 4.0, "fast", events.START_US + 25 * DAY).select("id", "due_us")


def _regressions(spark, sf):
    sequence = F.when(F.col("id") % 11 == 0, F.greatest(F.col("id") - 5, F.lit(0))).otherwise(F.col("id"))
    us = F.when(F.col("id") % 13 == 0, F.col("us") - HOUR).otherwise(F.col("us"))
    return events.frames(spark, sf).select("stream", F.col("id").alias("pos"), sequence.alias("sequence"), us.alias("us"))


def monotonic_filter(spark, sf):
    return monotonic.monotonic_filter(_regressions(spark, sf)).select("stream", "pos", "verdict")


def monotonic_filter_seq_only(spark, sf):
    return monotonic.sequence_only(_regressions(spark, sf)).select("stream", "pos", "accepted")


def fault_window_join(spark, sf):
    rows = _active(spark, sf).filter(F.size("active") > 0)
    return rows.select("id", "stream", F.size("active").cast("long").alias("n_rules"), F.array_join(F.transform("active", lambda r: r["kind"]), ",").alias("kinds"))


def faulted_streams(spark, sf):
    rules = faults.rules_table(spark, RULES).select(F.col("stream").alias("s"))
    return _frames(spark, sf).select("stream").distinct().join(rules, F.col("stream") == F.col("s"), "left_semi")


def _survivors(spark, sf, kind):
    rows = _active(spark, sf, kind).filter(~faults.suppressed())
    return rows.groupBy("stream").agg(F.count(F.lit(1)).alias("n"), F.sum("id").alias("ids"))


def fault_burst_loss(spark, sf):
    return _survivors(spark, sf, "burst_loss")


def fault_disconnect(spark, sf):
    return _survivors(spark, sf, "ecu_disconnect")


def fault_drop(spark, sf):
    rows = _active(spark, sf).filter(~faults.draws_drop(SEED))
    return rows.groupBy("stream").agg(F.count(F.lit(1)).alias("n"), F.sum("id").alias("ids"))


def fault_delay(spark, sf):
    rows = faults.delayed(_active(spark, sf)).filter("delay > 0")
    return rows.select("id", "stream", "due_us", F.round("latency", 6).alias("latency"))


def fault_duplicate(spark, sf):
    return faults.copies(_active(spark, sf)).groupBy("stream").agg(F.count(F.lit(1)).alias("emitted"), F.sum("copy").alias("extra"))


def fault_reorder(spark, sf):
    rows = faults.reordered(_active(spark, sf).filter(faults.has("reorder")))
    return rows.select("stream", "id", "out_pos", "held_lost")


def fault_restart_edges(spark, sf):
    return faults.restart_edges(_active(spark, sf)).select("stream", "id")


def fault_bandwidth(spark, sf):
    """An hour of capture time counts as a second, so that the bucket matters."""
    limit = F.when(F.col("stream") == "gps", KBPS)  # other streams have no limit
    rows = _frames(spark, sf).select("stream", "id", F.expr("us div 3600").alias("us"), limit.alias("kbps"), F.octet_length("payload").alias("bytes"))
    return faults.bandwidth_limited(rows)


def fault_corrupt_detect(spark, sf):
    rows = _active(spark, sf).filter(faults.has("corrupt"))
    frame = codecs.encode_frame(events.sensor_code(F.col("stream")), F.col("id"), F.col("us") * 1000, F.lit(0), F.col("payload"))
    sent = rows.select("id", "stream", frame.alias("frame"))
    flipped = F.concat(F.expr("substring(frame, 1, 40)"), codecs.flip_bits(F.expr("substring(frame, 41)"), F.col("id"), 3, SEED))
    read = sent.select("stream", flipped.alias("frame")).select("stream", codecs.decode_frame(F.col("frame")).alias("d"))
    return read.groupBy("stream", F.col("d.error").alias("error")).agg(F.count(F.lit(1)).alias("n"))


def fault_stats(spark, sf):
    rows = _active(spark, sf)
    gone = faults.suppressed() | faults.draws_drop(SEED)
    swap = faults.has("reorder") & ~gone
    live = lambda c: F.count_if(c & ~gone)
    dup = F.when(~gone & ~faults.has("reorder"), faults.duplicates()).otherwise(0)
    pairs = F.floor(F.count_if(swap) / 2)
    return rows.groupBy("stream").agg(
        (F.count_if(~gone & ~faults.has("reorder")) + F.sum(dup) + 2 * pairs).cast("long").alias("forwarded"),
        F.count_if(gone).alias("dropped"),
        F.sum(dup).cast("long").alias("duplicated"),
        live(faults.has("corrupt")).alias("corrupted"),
        pairs.cast("long").alias("reordered"),
        F.sum(F.when(~gone & (faults.delay_ms() > 0), 1 + dup).otherwise(0)).cast("long").alias("delayed"),
    )


def _arrivals(spark, sf):
    return events.frames(spark, sf).select("stream", F.col("id").alias("pos"), (F.col("us") - events.START_US).alias("t"))


def backpressure_sim(spark, sf):
    return queues.backpressure(_arrivals(spark, sf), CAPACITY, PERIOD)


def backpressure_stats(spark, sf):
    policy = F.create_map(*[F.lit(x) for kv in queues.POLICIES.items() for x in kv])[F.col("stream")]
    sums = [F.sum(c).alias(c) for c in ("enqueued", "dropped", "overwritten", "blocked")]
    return backpressure_sim(spark, sf).groupBy(policy.alias("policy")).agg(*sums, F.max("max_occupancy").alias("max_occupancy"))


def stale_resend(spark, sf):
    rows = _arrivals(spark, sf)
    return queues.stale_resend(rows, "stream", "t", "pos", HOUR, 0, 30 * DAY)


def _transforms(spark, sf):
    rows = events.table(spark, sf, "events")
    return rows.select("event_id", "value", F.concat(F.lit("f"), (F.col("user_id") % 6).cast("string")).alias("frame_id"), F.concat(F.lit("f"), ((F.col("event_id") * 7) % 5).cast("string")).alias("child_frame_id"))


EXCLUDE, INCLUDE = ["f0", ".*3$"], ["f[1-4]", "f5|x"]


def tf_filter(spark, sf):
    return transforms.pattern_filter(_transforms(spark, sf), EXCLUDE, INCLUDE).groupBy("frame_id", "child_frame_id").agg(F.count(F.lit(1)).alias("n"))


def tf_conflicts(spark, sf):
    return transforms.conflicts(_transforms(spark, sf))


def tf_latest(spark, sf):
    return transforms.latest(_transforms(spark, sf), "event_id", "value")


def tf_cache(spark, sf):
    rows = events.frames(spark, sf)
    child = F.concat(F.lit("n"), (F.col("id") % 9).cast("string"))
    pair = F.struct(F.lit("map").alias("frame"), child.alias("child"), F.col("latency").alias("value"))
    back = F.struct(child.alias("frame"), F.lit("map").alias("child"), F.col("latency").alias("value"))
    # the third hundred of identifiers of one stream turns pairs around
    sent = F.when((F.col("stream") == "gps") & (F.col("id") >= 200), F.array(back)).otherwise(F.array(pair))
    return transforms.cache(rows.select(F.col("stream").alias("topic"), F.col("id").alias("pos"), sent.alias("transforms")))


T = f"f AS (SELECT *, (us - {events.START_US}) / 1e6 AS t_s FROM frames), {faults.rules_sql(RULES)}, j AS (SELECT f.*, r.* EXCLUDE (stream), r.stream AS rule_stream FROM f JOIN rules r ON (r.stream IS NULL OR r.stream = f.stream) AND t_s >= start_s AND t_s < start_s + duration_s)"
BASE = f"{events.SQL}, {T}"
_REG = f"{events.SQL}, x AS (SELECT stream, id AS pos, CASE WHEN id % 11 = 0 THEN greatest(id - 5, 0) ELSE id END AS seq, CASE WHEN id % 13 = 0 THEN us - {HOUR} ELSE us END AS u FROM frames)"
_FLAGS = f"a AS (SELECT id, max(CASE WHEN kind IN ('burst_loss', 'ecu_disconnect') OR (kind = 'drop' AND {DRAW} < drop_rate) THEN 1 ELSE 0 END) AS gone, count(*) FILTER (kind = 'duplicate') AS dups, count(*) FILTER (kind = 'reorder') AS swaps, count(*) FILTER (kind = 'corrupt') AS hits, max(CASE WHEN kind = 'delay' THEN delay_ms ELSE 0 END) AS delay, count(*) AS n FROM j GROUP BY id), s AS (SELECT f.*, coalesce(gone, 0) AS gone, coalesce(dups, 0) AS dups, coalesce(swaps, 0) AS swaps, coalesce(hits, 0) AS hits, coalesce(delay, 0) AS delay FROM f LEFT JOIN a USING (id))"
_QUEUE = f"""{events.SQL}, o AS (SELECT stream, us - {events.START_US} AS t, row_number() OVER (PARTITION BY stream ORDER BY id) AS rn,
 CASE stream WHEN 'camera' THEN 'overwrite_oldest' WHEN 'can' THEN 'never_drop' WHEN 'imu' THEN 'batch_accumulate' ELSE 'drop_newest' END AS policy FROM frames),
 q AS (SELECT stream, policy, CAST(0 AS BIGINT) AS rn, CAST(0 AS BIGINT) AS occ, CAST(0 AS BIGINT) AS k, CAST(0 AS BIGINT) AS enq, CAST(0 AS BIGINT) AS dr, CAST(0 AS BIGINT) AS ov, CAST(0 AS BIGINT) AS bl, CAST(0 AS BIGINT) AS top FROM (SELECT DISTINCT stream, policy FROM o)
 UNION ALL SELECT stream, policy, rn, CASE WHEN o0 < {CAPACITY} THEN o0 + 1 ELSE o0 END, CASE WHEN o0 >= {CAPACITY} AND policy = 'never_drop' THEN k1 + 1 ELSE k1 END,
 enq + CASE WHEN o0 < {CAPACITY} OR policy IN ('never_drop', 'overwrite_oldest') THEN 1 ELSE 0 END, dr + CASE WHEN o0 >= {CAPACITY} AND policy IN ('drop_newest', 'batch_accumulate') THEN 1 ELSE 0 END,
 ov + CASE WHEN o0 >= {CAPACITY} AND policy = 'overwrite_oldest' THEN 1 ELSE 0 END, bl + CASE WHEN o0 >= {CAPACITY} AND policy = 'never_drop' THEN 1 ELSE 0 END, greatest(top, CASE WHEN o0 < {CAPACITY} THEN o0 + 1 ELSE o0 END)
 FROM (SELECT o.stream, o.policy, o.rn, greatest(o.t // {PERIOD}, q.k) AS k1, greatest(q.occ - (greatest(o.t // {PERIOD}, q.k) - q.k), 0) AS o0, enq, dr, ov, bl, top FROM q JOIN o ON o.stream = q.stream AND o.rn = q.rn + 1)),
 z AS (SELECT stream, policy, enq AS enqueued, dr AS dropped, ov AS overwritten, bl AS blocked, occ AS occupancy, top AS max_occupancy FROM q QUALIFY row_number() OVER (PARTITION BY stream ORDER BY rn DESC) = 1)"""
_TF = "WITH tf AS (SELECT event_id, value, 'f' || (user_id % 6) AS frame_id, 'f' || ((event_id * 7) % 5) AS child_frame_id FROM events)"
_full = lambda p: f"(regexp_full_match(frame_id, '{p}') OR regexp_full_match(child_frame_id, '{p}'))"
_SURVIVE = "SELECT stream, count(*) AS n, CAST(sum(id) AS BIGINT) AS ids FROM f WHERE id NOT IN (SELECT id FROM j WHERE {}) GROUP BY stream"

SQL = {
    "assign_sequence": f"{events.SQL} SELECT stream, id, row_number() OVER (PARTITION BY stream ORDER BY us, id) - 1 AS sequence FROM frames",
    "replay_order": f"{events.SQL} SELECT id, row_number() OVER (ORDER BY us, id) - 1 AS place FROM frames",
    "replay_index": f"{events.SQL} SELECT us, id, CAST(34 + strlen(payload) AS INT) AS record_length FROM frames",
    "replay_seek": f"{events.SQL} SELECT id, us FROM frames WHERE us >= {events.START_US + 20 * DAY}",
    "replay_schedule": f"{events.SQL}, s AS (SELECT * FROM frames WHERE us >= {events.START_US + 25 * DAY}) SELECT id, CAST(floor((us - (SELECT min(us) FROM s)) / 4e0) AS BIGINT) AS due_us FROM s",
    "monotonic_filter": f"{_REG}, o AS (SELECT *, row_number() OVER (PARTITION BY stream ORDER BY pos) AS rn FROM x), r AS (SELECT stream, pos, rn, seq AS ls, u AS lu, 'ok' AS verdict FROM o WHERE rn = 1 UNION ALL SELECT o.stream, o.pos, o.rn, CASE WHEN seq < ls OR u < lu THEN ls ELSE seq END, CASE WHEN seq < ls OR u < lu THEN lu ELSE u END, CASE WHEN seq < ls THEN 'sequence_regression' WHEN u < lu THEN 'timestamp_regression' ELSE 'ok' END FROM r JOIN o ON o.stream = r.stream AND o.rn = r.rn + 1) SELECT stream, pos, verdict FROM r",
    "monotonic_filter_seq_only": f"{_REG} SELECT stream, pos, coalesce(seq >= max(seq) OVER (PARTITION BY stream ORDER BY pos ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), true) AS accepted FROM x",
    "fault_window_join": f"{BASE} SELECT id, stream, count(*) AS n_rules, string_agg(kind, ',' ORDER BY rule_id) AS kinds FROM j GROUP BY id, stream",
    "faulted_streams": f"{BASE} SELECT DISTINCT stream FROM f WHERE stream IN (SELECT stream FROM rules)",
    "fault_burst_loss": f"{BASE} " + _SURVIVE.format("kind = 'burst_loss'"),
    "fault_disconnect": f"{BASE} " + _SURVIVE.format("kind = 'ecu_disconnect'"),
    "fault_drop": f"{BASE} " + _SURVIVE.format(f"kind = 'drop' AND {DRAW} < drop_rate"),
    "fault_delay": f"{BASE} SELECT id, stream, us + CAST(round(max(delay_ms) * 1000) AS BIGINT) AS due_us, round(latency + max(delay_ms), 6) AS latency FROM j WHERE kind = 'delay' GROUP BY id, stream, us, latency",
    "fault_duplicate": f"{BASE}, d AS (SELECT id, count(*) AS n FROM j WHERE kind = 'duplicate' GROUP BY id) SELECT stream, CAST(count(*) + sum(coalesce(n, 0)) AS BIGINT) AS emitted, CAST(sum(coalesce(n * (n + 1) // 2, 0)) AS BIGINT) AS extra FROM f LEFT JOIN d USING (id) GROUP BY stream",
    "fault_reorder": f"{BASE}, w AS (SELECT stream, id, row_number() OVER (PARTITION BY stream ORDER BY id) AS rn, lead(id) OVER (PARTITION BY stream ORDER BY id) AS nxt FROM j WHERE kind = 'reorder') SELECT stream, id, CASE WHEN rn % 2 = 1 THEN nxt * 2 + 1 ELSE id * 2 END AS out_pos, rn % 2 = 1 AND nxt IS NULL AS held_lost FROM w",
    "fault_restart_edges": f"{BASE}, c AS (SELECT f.stream, f.id, count(rule_id) AS n, count(*) FILTER (kind = 'process_restart') AS restarts FROM f LEFT JOIN j USING (id) GROUP BY f.stream, f.id), e AS (SELECT *, sum(CASE WHEN n = 0 THEN 1 ELSE 0 END) OVER (PARTITION BY stream ORDER BY id) AS epoch FROM c) SELECT stream, min(id) AS id FROM e WHERE restarts > 0 GROUP BY stream, epoch",
    "fault_bandwidth": f"{events.SQL}, o AS (SELECT id, us // 3600 AS us, strlen(payload) AS b, row_number() OVER (ORDER BY id) AS rn FROM frames WHERE stream = 'gps'), r AS (SELECT id, rn, us, {KBPS * 125.0!r}e0 - b AS tok, true AS fwd FROM o WHERE rn = 1 UNION ALL SELECT id, rn, us, CASE WHEN t >= b THEN t - b ELSE t END, t >= b FROM (SELECT o.id, o.rn, o.us, o.b, least({KBPS * 125.0!r}e0, r.tok + (o.us - r.us) / 1e6 * {KBPS * 125.0!r}e0) AS t FROM r JOIN o ON o.rn = r.rn + 1)) SELECT 'gps' AS stream, id, fwd AS forwarded FROM r UNION ALL SELECT stream, id, true FROM frames WHERE stream <> 'gps'",
    "fault_corrupt_detect": f"{BASE} SELECT stream, 'payload_crc_mismatch' AS error, count(*) AS n FROM j WHERE kind = 'corrupt' GROUP BY stream",
    "fault_stats": f"{BASE}, {_FLAGS} SELECT stream, CAST(sum(CASE WHEN gone = 0 AND swaps = 0 THEN 1 + dups ELSE 0 END) + 2 * (count(*) FILTER (gone = 0 AND swaps > 0) // 2) AS BIGINT) AS forwarded, count(*) FILTER (gone = 1) AS dropped, CAST(sum(CASE WHEN gone = 0 AND swaps = 0 THEN dups ELSE 0 END) AS BIGINT) AS duplicated, count(*) FILTER (gone = 0 AND hits > 0) AS corrupted, count(*) FILTER (gone = 0 AND swaps > 0) // 2 AS reordered, CAST(sum(CASE WHEN gone = 0 AND delay > 0 THEN 1 + CASE WHEN swaps = 0 THEN dups ELSE 0 END ELSE 0 END) AS BIGINT) AS delayed FROM s GROUP BY stream",
    "backpressure_sim": f"{_QUEUE} SELECT * EXCLUDE (policy) FROM z",
    "backpressure_stats": f"{_QUEUE} SELECT policy, CAST(sum(enqueued) AS BIGINT) AS enqueued, CAST(sum(dropped) AS BIGINT) AS dropped, CAST(sum(overwritten) AS BIGINT) AS overwritten, CAST(sum(blocked) AS BIGINT) AS blocked, max(max_occupancy) AS max_occupancy FROM z GROUP BY policy",
    "stale_resend": f"{events.SQL}, a AS (SELECT stream, id AS pos, us - {events.START_US} AS t FROM frames), g AS (SELECT stream, k * {HOUR} AS tick FROM (SELECT DISTINCT stream FROM a), range(721) r(k)) SELECT g.stream, g.tick, a.pos AS sent, a.t <= g.tick - {HOUR} AS stale FROM g ASOF JOIN a ON g.stream = a.stream AND g.tick >= a.t",
    "tf_filter": f"{_TF} SELECT frame_id, child_frame_id, count(*) AS n FROM tf WHERE NOT ({' OR '.join(map(_full, EXCLUDE))}) AND ({' OR '.join(map(_full, INCLUDE))}) GROUP BY ALL",
    "tf_conflicts": f"{_TF} SELECT least(frame_id, child_frame_id) AS a, greatest(frame_id, child_frame_id) AS b, count(*) FILTER (frame_id < child_frame_id) AS forward, count(*) FILTER (frame_id > child_frame_id) AS backward FROM tf WHERE frame_id <> child_frame_id GROUP BY 1, 2 HAVING forward > 0 AND backward > 0",
    "tf_latest": f"{_TF} SELECT frame_id, child_frame_id, max_by(value, event_id) AS value, max(event_id) AS event_id FROM tf GROUP BY ALL",
}
_PAIRS = (
    f"{events.SQL}, t AS (SELECT stream AS topic, id AS pos, latency AS value, CASE WHEN back THEN node ELSE 'map' END AS a, CASE WHEN back THEN 'map' ELSE node END AS b FROM (SELECT *, 'n' || (id % 9) AS node, stream = 'gps' AND id >= 200 AS back FROM frames)),"
    " k AS (SELECT topic, a, b, min(pos) AS p FROM t GROUP BY ALL), e AS (SELECT s.topic, min(s.p) AS p FROM k s JOIN k o ON o.topic = s.topic AND o.a = s.b AND o.b = s.a AND o.p < s.p GROUP BY s.topic),"
    " l AS (SELECT t.topic, t.pos FROM t LEFT JOIN e USING (topic) WHERE e.p IS NULL OR t.pos < e.p), g AS (SELECT l.topic, l.pos, k.a, k.b, k.p FROM l JOIN k ON k.topic = l.topic AND k.p <= l.pos),"
    " v AS (SELECT g.*, t.value FROM g ASOF JOIN t ON g.topic = t.topic AND g.a = t.a AND g.b = t.b AND g.pos >= t.pos)"
)
SQL["tf_cache"] = f"""{_PAIRS} SELECT topic, pos, count(*) AS size, false AS reset, '[' || string_agg('["' || a || '", "' || b || '", ' || CAST(value AS VARCHAR) || ']', ', ' ORDER BY p) || ']' AS transforms FROM v GROUP BY topic, pos UNION ALL SELECT topic, p, 0, true, '[]' FROM e"""
QUERIES = {f.__name__: f for f in (assign_sequence, replay_order, replay_index, replay_seek, replay_schedule, monotonic_filter, monotonic_filter_seq_only, fault_window_join, faulted_streams, fault_burst_loss, fault_disconnect, fault_drop, fault_delay, fault_duplicate, fault_reorder, fault_restart_edges, fault_bandwidth, fault_corrupt_detect, fault_stats, backpressure_sim, backpressure_stats, stale_resend, tf_filter, tf_conflicts, tf_latest, tf_cache)}

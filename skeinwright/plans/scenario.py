"""Declarative scenarios: parsed, run over frames, judged, and rolled up."""

from __future__ import annotations

from dataclasses import dataclass, field
from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import faults, stream_metrics

OPERATORS = ("less_than", "greater_than", "equals", "not_equals")
PARAMS = ("delay_ms", "drop_rate", "bandwidth_kbps", "burst_ms")
EPSILON = 1e-9


@dataclass(frozen=True)
class Assertion:
    metric: str
    operator: str
    value: float = 0.0
    window_seconds: float | None = None


@dataclass(frozen=True)
class Scenario:
    name: str
    duration_seconds: float
    streams: dict[str, float] = field(default_factory=dict)
    faults: tuple[faults.Rule, ...] = ()
    assertions: tuple[Assertion, ...] = ()


def from_mapping(root: dict) -> Scenario:
    """Checks and builds a scenario; ValueError tells what is wrong. Unknown keys are let be."""
    if not isinstance(root, dict) or not root.get("name"):
        raise ValueError("scenario: a name is needed")
    duration = float(root.get("duration_seconds") or 0)
    if duration <= 0:
        raise ValueError("scenario: duration_seconds must be over 0")
    streams = {str(k): float((v or {}).get("rate_hz") or 0) for k, v in (root.get("streams") or {}).items()}
    for name, rate in streams.items():
        if rate <= 0:
            raise ValueError(f"scenario: the rate of {name} must be over 0")
    rules = []
    for f in root.get("faults") or []:
        kind = faults.ALIASES.get(str(f.get("type")), str(f.get("type")))
        if kind not in faults.KINDS:
            raise ValueError(f"scenario: fault type {f.get('type')!r} is not known")
        params = {k: float(v) for k, v in (f.get("params") or {}).items()} | {k: float(f[k]) for k in PARAMS if k in f}
        used = {k: params[k] for k in ("delay_ms", "drop_rate", "bandwidth_kbps") if k in params}
        rules.append(faults.Rule(kind, f.get("stream") or None, float(f.get("start_seconds") or 0), float(f.get("duration_seconds") or 0), **used))
    found = []
    for a in root.get("assertions") or []:
        if not a.get("metric") or a.get("operator") not in OPERATORS:
            raise ValueError("scenario: an assertion needs a metric and a known operator")
        window = a.get("window_seconds")
        found.append(Assertion(a["metric"], a["operator"], float(a.get("value") or 0), None if window is None else float(window)))
    return Scenario(str(root["name"]), duration, streams, tuple(rules), tuple(found))


def parse(text: str) -> Scenario:
    import yaml

    return from_mapping(yaml.safe_load(text))


ASSERTIONS = "scenario string, pos int, metric string, operator string, value double"


def assertions_table(spark: SparkSession, scenarios: list[Scenario]) -> DataFrame:
    return spark.createDataFrame([(s.name, i, a.metric, a.operator, a.value) for s in scenarios for i, a in enumerate(s.assertions)], ASSERTIONS)


def evaluate(assertions: DataFrame, metrics: DataFrame, keys: tuple[str, ...] = ("metric",)) -> DataFrame:
    """Adds actual, found and passed; a metric that is missing is 0, not found, and fails."""
    named = metrics.select(*[F.col(k).alias(f"_{k}") for k in keys], F.col("value").alias("_v"))
    on = [F.col(k) == F.col(f"_{k}") for k in keys]
    actual, wanted = F.coalesce("_v", F.lit(0.0)), F.col("value")
    near = F.abs(actual - wanted) <= EPSILON
    holds = F.when(F.col("operator") == "less_than", actual < wanted).when(F.col("operator") == "greater_than", actual > wanted).when(F.col("operator") == "equals", near).when(F.col("operator") == "not_equals", ~near).otherwise(False)
    joined = assertions.join(named, on, "left")
    return joined.select(*assertions.columns, actual.alias("actual"), F.col("_v").isNotNull().alias("found"), (F.col("_v").isNotNull() & holds).alias("passed"))


def verdicts(scenarios: DataFrame, evaluated: DataFrame) -> DataFrame:
    """(scenario, passed, n_assertions, n_passed) of each scenario; one without assertions passes."""
    sums = evaluated.groupBy(F.col("scenario").alias("s")).agg(F.bool_and("passed").alias("ok"), F.count(F.lit(1)).alias("n"), F.count_if("passed").alias("p"))
    joined = scenarios.join(sums, F.col("scenario") == F.col("s"), "left")
    return joined.select("scenario", F.coalesce("ok", F.lit(True)).alias("passed"), F.coalesce("n", F.lit(0)).alias("n_assertions"), F.coalesce("p", F.lit(0)).alias("n_passed"))


def roll_up(results: DataFrame) -> DataFrame:
    """One row over all scenarios; all_passed needs one at least."""
    n, ok = F.count(F.lit(1)), F.count_if("passed")
    return results.agg(
        n.alias("total_scenarios"), ok.alias("scenarios_passed"), (n - ok).alias("scenarios_failed"),
        F.coalesce(F.sum("n_assertions"), F.lit(0)).cast("long").alias("total_assertions"), F.coalesce(F.sum("n_passed"), F.lit(0)).cast("long").alias("assertions_passed"),
        ((n > 0) & (n == ok)).alias("all_passed"),
    )


def matrix(scenarios: DataFrame, times: int, base_port: int = 0, prefix: str = "/scenario") -> DataFrame:
    """Each scenario ``times`` times over, with a namespace and a port of its own (0: none)."""
    runs = scenarios.withColumn("run", F.explode(F.sequence(F.lit(0), F.lit(times - 1))))
    count = scenarios.count()  # scenarios are a short list
    index = F.col("run") * count + F.col("pos")
    port = F.lit(0) if base_port == 0 else F.pmod(F.lit(base_port) + index, F.lit(65536))
    return runs.select("scenario", index.cast("long").alias("run_index"), F.concat(F.lit(f"{prefix}_"), index.cast("string")).alias("namespace"), port.cast("long").alias("metrics_port"))


def max_duration(scenarios: list[Scenario]) -> float:
    """How long scenarios take that run side by side."""
    return max((s.duration_seconds for s in scenarios), default=0.0)


def utc_now() -> str:
    """The time of a report, in UTC."""
    return datetime.now(timezone.utc).strftime("%Y-%m-%dT%H:%M:%SZ")


def restarts(frames: DataFrame, scenario: Scenario) -> DataFrame:
    """(stream, id) of the frames at which a process restarts: each is one call of a restart hook."""
    return faults.restart_edges(faults.with_active(frames, list(scenario.faults))).select("stream", "id")


def run(frames: DataFrame, scenario: Scenario, rate_hz: float, as_built: bool = False) -> tuple[DataFrame, DataFrame]:
    """(metrics long, evaluated assertions) of a scenario over frames with t_s. Each stream is expected at the rate
    that the scenario gives it; ``rate_hz`` is for scenarios that name no streams."""
    spark = frames.sparkSession
    mine = frames.filter(F.col("stream").isin(list(scenario.streams))) if scenario.streams else frames
    after = faults.apply_faults(mine, list(scenario.faults))
    arrived = after.withColumn("us", F.col("us" if as_built else "due_us")).withColumn("latency", F.col("latency") - (F.col("delay") if as_built else 0.0))
    metrics = stream_metrics.unpivot(stream_metrics.stream_metrics(arrived, scenario.streams or rate_hz, scenario.duration_seconds))
    return metrics, evaluate(assertions_table(spark, [scenario]), metrics)

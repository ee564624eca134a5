"""The regression gate: benchmark text against a baseline, as Markdown and an exit code."""

from __future__ import annotations

import json
import os
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

from ..sources import exposition

#: Environment variables of the thresholds and their defaults (fixed values).
LIMITS = {"P99_FAIL_PCT": 10.0, "THPUT_WARN_PCT": 5.0, "DROP_FAIL_ABS_PCT": 0.1}
COLUMNS = ("metric", "field", "baseline", "current", "delta", "verdict")


def load_baseline(spark: SparkSession, path: str) -> DataFrame:
    """(name, field, value); a file that is missing is an empty baseline."""
    root = json.loads(Path(path).read_text()) if Path(path).exists() else {}
    return spark.createDataFrame([(n, f, float(v)) for n, fields in root.items() for f, v in fields.items()], "name string, field string, value double")


def markdown(gated: DataFrame) -> tuple[str, bool]:
    """The table, by name, and whether anything failed."""
    show = lambda v: "-" if v is None else f"{v:.3g}"
    rows, failed = ["| " + " | ".join(COLUMNS) + " |", "|" + "---|" * len(COLUMNS)], False
    for r in gated.orderBy("name", "field").collect():
        failed = failed or r.verdict == "FAIL"
        delta = "-" if r.delta is None else f"{r.delta:+.3f}pp" if r.field == "drop_rate_pct" else f"{r.delta:+.1f}%"
        base = "(new)" if r.verdict == "NEW" else show(r.baseline)
        rows.append(f"| {r.name} | {r.field} | {base} | {show(r.current)} | {delta} | {r.verdict} |")
    return "\n".join(rows), failed


def run(spark: SparkSession, current: str, baseline: str, update: bool = False) -> tuple[int, str]:
    """(exit code, Markdown): 2 without benchmark lines, 1 on a failure, else 0."""
    lines = [(i, x) for i, x in enumerate(Path(current).read_text().splitlines())]
    found = exposition.parse_bench(spark.createDataFrame(lines, "pos int, line string")) if lines else None
    rows = found.collect() if found is not None else []
    if not rows:
        return 2, "no benchmark lines"
    limits = [float(os.environ.get(k, v)) for k, v in LIMITS.items()]
    text, failed = markdown(exposition.gate(found, load_baseline(spark, baseline), *limits))
    if update:
        root: dict[str, dict[str, float]] = {}
        for r in sorted(rows):
            root.setdefault(r.name, {})[r.field] = r.value
        Path(baseline).write_text(json.dumps(root, indent=2, sort_keys=True) + "\n")
    return int(failed), text

"""Jobs from the command line: run scenarios, gate benchmarks, summarise reports.

Exit codes: 0 passed, 1 failed, 2 wrong use or a scenario that can't be read.
"""

from __future__ import annotations

import argparse
import sys
from pathlib import Path

from pyspark.sql import SparkSession

from .plans import charts, gate, report, scenario
from .sources import events


def _run(spark: SparkSession, args: argparse.Namespace) -> int:
    try:
        stories = [scenario.parse(Path(p).read_text()) for p in args.scenario] * max(1, args.count)
    except (OSError, ValueError) as e:
        print(e, file=sys.stderr)
        return 2
    frames = events.frames(spark, args.data)
    frames = frames.withColumn("t_s", (frames["us"] - events.START_US) / 1e6)
    results = []
    for i, story in enumerate(stories):
        metrics, evaluated = scenario.run(frames, story, args.rate)
        rows = evaluated.collect()  # a row for each assertion
        results.append((f"scenario_{i}", all(r.passed for r in rows), len(rows), sum(r.passed for r in rows)))
        if args.report_dir:
            built = report.build(frames.select("stream").distinct(), metrics)
            Path(args.report_dir).mkdir(parents=True, exist_ok=True)
            name = f"{story.name}_{i}"
            Path(args.report_dir, f"{name}.json").write_text(report.to_json(built, evaluated, story.name, scenario.utc_now(), story.duration_seconds).head().json)
            Path(args.report_dir, f"{name}.html").write_text(report.to_html(built, evaluated, story.name))
        print(story.name, "PASS" if results[-1][1] else "FAIL")
    total = scenario.roll_up(spark.createDataFrame(results, "scenario string, passed boolean, n_assertions bigint, n_passed bigint")).head()
    print(f"{total.scenarios_passed} of {total.total_scenarios} scenarios, {total.assertions_passed} of {total.total_assertions} assertions, {scenario.max_duration(stories):g} s at most")
    return 0 if total.all_passed else 1


def _gate(spark: SparkSession, args: argparse.Namespace) -> int:
    code, text = gate.run(spark, args.current, args.baseline, args.update)
    print(text)
    return code


def _summary(spark: SparkSession, args: argparse.Namespace) -> int:
    Path(args.out).write_text(charts.summary_page(report.scan(spark, args.reports)))
    return 0


def main(argv: list[str] | None = None, spark: SparkSession | None = None) -> int:
    top = argparse.ArgumentParser(prog="skeinwright")
    sub = top.add_subparsers(required=True)
    run = sub.add_parser("run")
    run.add_argument("--scenario", action="append", required=True)
    run.add_argument("--data", required=True)
    run.add_argument("--count", type=int, default=1)
    run.add_argument("--rate", type=float, default=events.RATE_HZ)
    run.add_argument("--report-dir")
    run.set_defaults(job=_run)
    bench = sub.add_parser("gate")
    bench.add_argument("--current", required=True)
    bench.add_argument("--baseline", required=True)
    bench.add_argument("--update", action="store_true")
    bench.set_defaults(job=_gate)
    page = sub.add_parser("summary")
    page.add_argument("--reports", required=True)
    page.add_argument("--out", required=True)
    page.set_defaults(job=_summary)
    try:
        args = top.parse_args(argv)
    except SystemExit as e:
        return 2 if e.code else 0
    return args.job(spark or SparkSession.builder.config("spark.sql.session.timeZone", "UTC").getOrCreate(), args)


if __name__ == "__main__":
    sys.exit(main())

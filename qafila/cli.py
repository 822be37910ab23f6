"""Command line: canonicalise a corpus, generate records, sum up telemetry, measure endpoints, run a pilot."""

from __future__ import annotations

import argparse
import os
import sys

from pyspark import SparkConf

from qafila.operators import canonical, capacity, curation, events, generation, outputs, pool, selection, tracing
from qafila.operators import pilot as pilot_run
from qafila.runtime import build_session, cut
from qafila.sources import chat, files


def parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="qafila", description=__doc__)
    sub = p.add_subparsers(dest="command", required=True)
    one = sub.add_parser("curate", help="canonical poems of a raw corpus")
    one.add_argument("--input", required=True)
    one.add_argument("--output", required=True)
    one.add_argument("--classical", action="store_true", help="only known, not modern eras in formal language")
    one.add_argument("--on-tie", choices=("error", "flag"), default="error")
    one.add_argument("--on-invalid", choices=("error", "drop"), default="error")
    two = sub.add_parser("generate", help="records of one task")
    two.add_argument("--input", required=True, help="canonical poems")
    two.add_argument("--output", required=True)
    two.add_argument("--task", choices=sorted(generation.TASKS), required=True)
    two.add_argument("--max-couplets", type=_at_least_one)
    two.add_argument("--limit", type=_at_least_one)
    two.add_argument("--manifest")
    two.add_argument("--log", help="folder of what earlier runs accepted; nothing in it is asked again")
    two.add_argument("--trace", help="JSON lines of what the run tells")
    two.add_argument("--max-source-chars", type=_at_least_one)
    two.add_argument("--chunk-chars", type=_at_least_one, default=6000)
    two.add_argument("--temperature", type=float, default=0.0)
    two.add_argument("--env", help="file with the endpoints; without one the offline backend answers")
    two.add_argument("--capacity", help="capacity report; asked for where there are several endpoints, unless --uncertified")
    two.add_argument("--pilot", help="folder of a reviewed pilot; asked for where there are several endpoints, unless --uncertified")
    two.add_argument("--uncertified", action="store_true")
    three = sub.add_parser("summarise", help="workload summary of request events")
    three.add_argument("--input", required=True)
    three.add_argument("--output", required=True)
    three.add_argument("--timeout", type=float, default=120.0)
    four = sub.add_parser("benchmark", help="what the endpoints bear")
    four.add_argument("--input", required=True, help="canonical poems")
    four.add_argument("--task", choices=sorted(generation.TASKS), required=True)
    four.add_argument("--env", required=True)
    four.add_argument("--log", required=True)
    four.add_argument("--output", required=True)
    four.add_argument("--seconds", type=float, default=300.0)
    four.add_argument("--warm-up", type=float, default=30.0)
    five = sub.add_parser("pilot", help="a small run with gates and a sample for review")
    five.add_argument("--input", required=True, help="canonical poems")
    five.add_argument("--task", choices=sorted(generation.TASKS), required=True)
    five.add_argument("--output", required=True, help="folder")
    five.add_argument("--env")
    five.add_argument("--max-source-chars", type=_at_least_one)
    five.add_argument("--chunk-chars", type=_at_least_one, default=6000)
    five.add_argument("--temperature", type=float, default=0.0)
    return p


def _settings(a) -> dict:
    return {"temperature": a.temperature, "max_source_chars": a.max_source_chars, "chunk_chars": a.chunk_chars}


def _endpoints(env: str | None) -> list[dict]:
    return files.endpoints_from_env(files.read_env(env) | dict(os.environ)) if env else []


def _backend(endpoints: list[dict], plan: dict | None, tasks: int):
    """None (offline), one endpoint asked again after failures, or a pool. A pool is per worker process, so each has its
    share of an endpoint's capacity."""
    one = lambda e: chat.HttpBackend(e["url"], e["model"] or "", e["api_key"])
    if len(endpoints) < 2:
        return chat.Retrying(one(endpoints[0])) if endpoints else None
    return pool.PoolOf([(e["endpoint_id"], one(e), pool.share_of(plan["endpoints"][e["endpoint_id"]]["capacity"], tasks), plan["endpoints"][e["endpoint_id"]]["p95"]) for e in endpoints])


def _poems(spark, path: str):
    return selection.measured(spark.read.parquet(path))


def _at_least_one(text: str) -> int:
    n = int(text)
    if n < 1:
        raise argparse.ArgumentTypeError("must be at least 1")
    return n


def curate(spark, a) -> int:
    rows = spark.read.parquet(a.input)
    if a.classical:
        rows = rows.filter(curation.is_classical())
    return 0 if files.write_records(canonical.canonicalize(rows, a.on_tie, a.on_invalid), a.output) else 1


def generate(spark, a) -> int:
    t, settings, endpoints = generation.task(a.task), _settings(a), _endpoints(a.env)
    contract = t.fingerprint(settings)
    plan = None
    if len(endpoints) > 1:
        ceilings = {e["endpoint_id"]: e["max_concurrency"] for e in endpoints}
        if a.uncertified:
            plan = capacity.uncertified(ceilings)
        elif a.capacity and a.pilot:
            plan = capacity.checked(files.read_document(a.capacity), ceilings, contract)
            pilot_run.passed(a.pilot, a.task, contract)
        else:
            raise ValueError("several endpoints need --capacity and --pilot, or --uncertified")
    poems = _poems(spark, a.input)
    chosen = cut(selection.cap_then_limit(poems, a.max_couplets, a.limit, "first_row"))
    if a.max_source_chars and a.task != "poem-generation":
        chosen = generation.oversized(chosen, a.max_source_chars)
    trace = tracing.Trace(a.trace) if a.trace else None
    if trace:
        trace.started(t, settings, {"selected": chosen.count()})
    log = generation.Log(spark, a.log) if a.log else None
    backend = _backend(endpoints, plan, spark.sparkContext.defaultParallelism)
    made = cut(generation.generate(chosen, a.task, backend, log, settings))  # written once, so that nothing is asked twice
    records = cut(outputs.with_dimensions(generation.records_of(made, chosen, a.task, t.metadata)))
    outputs.publish(records, a.output)
    report = outputs.manifest(a.task, chosen, records, outputs.failures_of(made), a.max_source_chars, fingerprint=contract)
    if a.manifest:
        files.write_document(report, a.manifest)
    if trace:
        trace.emit("run_end", generated=report["generated"], failed=report["failed"])
    return 0 if report["complete"] else 1


def benchmark(spark, a) -> int:
    t = generation.task(a.task)
    requests = capacity.bank(t, capacity.fixture_poems(_poems(spark, a.input)))
    endpoints = {e["endpoint_id"]: (chat.HttpBackend(e["url"], e["model"] or "", e["api_key"]), e["max_concurrency"]) for e in _endpoints(a.env)}
    report = capacity.benchmark(spark, endpoints, requests, t.fingerprint({}), a.log, a.seconds, a.warm_up)
    files.write_document(report, a.output)
    return 0 if report["certified"] else 1


def pilot(spark, a) -> int:
    endpoints = _endpoints(a.env)
    plan = capacity.uncertified({e["endpoint_id"]: e["max_concurrency"] for e in endpoints})
    report = pilot_run.run(_poems(spark, a.input), a.task, a.output, _backend(endpoints, plan, spark.sparkContext.defaultParallelism), _settings(a))
    return 0 if all(v for k, v in report["gates"].items() if k.endswith("_ok")) else 1


def summarise(spark, a) -> int:
    once = events.delivered_once(spark.read.parquet(a.input))
    return 0 if files.write_records(events.workload(once, ["endpoint_id", "settings_id"], a.timeout), a.output) else 1


def main(argv: list[str] | None = None, spark=None) -> int:
    """0 complete, 1 something is unresolved or empty, 2 bad input."""
    a = parser().parse_args(argv)
    # under spark-submit, which sets a master, the session is the launcher's
    spark = spark or build_session(None if SparkConf().contains("spark.master") or "MASTER" in os.environ else "local[*]")
    try:
        return {"curate": curate, "generate": generate, "summarise": summarise, "benchmark": benchmark, "pilot": pilot}[a.command](spark, a)
    except Exception as e:  # bad files, refused rows
        print(f"error: {str(e).splitlines()[0]}", file=sys.stderr)
        return 2


if __name__ == "__main__":
    sys.exit(main())

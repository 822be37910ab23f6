"""How much a set of endpoints bears: a bank of requests, levels of load, a report, and the check of a report.

The measuring is threads of the driver against real endpoints; what it finds are events, summed up by the same workload
and selection operators that sum up request telemetry.
"""

from __future__ import annotations

import datetime as dt
import os
import threading

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from qafila.operators import conversations as K
from qafila.operators import events as E
from qafila.operators import pool
from qafila.operators.generation import Backend, OfflineBackend, Task
from qafila.sources import files

LEVELS = (1, 2, 4, 8, 16, 24, 32)
VERSION = 1
#: Least share of the predicted rate, least gain over the best endpoint alone, most errors of all endpoints together.
EFFICIENCY, SPEED_UP, ERRORS = 0.9, 2.5, 0.005
EVENT_DDL = "phase string, endpoint_id string, level int, event_id bigint, request_kind string, status string, finish_reason string, prompt_tokens bigint, completion_tokens bigint, elapsed_seconds double, ts timestamp"


def levels(ceiling: int) -> list[int]:
    """The usual levels up to a ceiling, and the ceiling."""
    return sorted({x for x in LEVELS if x <= ceiling} | {ceiling})


def _ask(task: Task, kind: str, poem: dict) -> dict:
    lines = poem["poem_text"].split("\n")
    about = {"poem": poem["poem_text"], "meter": poem["meter_name"], "n": len(lines)}
    if kind.startswith("reasoning"):
        return {"kind": "reasoning-chunk", "instruction": "تجربة", "meter": poem["meter_name"], "n": len(lines), "start": 1, "couplets": lines[:3], "before": None, "after": None, "overview": True}
    if task.name == "mcq":
        return {"kind": "mcq", "poem": poem["poem_text"], "truth": poem["meter_name"], "question": "ما البحر الذي نظم عليه النص؟"}
    return {"kind": task.name, **about, **({"count": 1} if task.name == "poem-reconstruction" else {})}


def bank(task: Task, poems: list[dict], probes: int = 4) -> list[dict]:
    """The requests of a benchmark in the task's mix, poems taken in turn, then one for each of the longest poems.

    A validation request shows the judge a made-up candidate. poems: sample_id, poem_text, meter_name of a few dozen.
    """
    if not poems:
        raise ValueError("no poems for the requests")
    out, author = [], OfflineBackend()

    def add(kind: str, poem: dict) -> None:
        ask = _ask(task, kind, poem)
        messages = K.judging(ask, author.answer(ask)) if kind.endswith("validation") else K.asking(ask, author.answer)
        out.append({"kind": kind, "sample_id": poem["sample_id"], "messages": messages})

    for kind, n in task.fixtures:
        for i in range(n):
            add(kind, poems[i % len(poems)])
    for poem in sorted(poems, key=lambda p: (-len(p["poem_text"]), p["sample_id"]))[:probes]:
        add(f"probe_{task.fixtures[0][0]}", poem)
    return out


def measure(phase: str, name: str, backend: Backend, requests: list[dict], level: int, seconds: float, warm_up: float) -> list[dict]:
    """The events of one level of load on one endpoint."""
    began = dt.datetime.now(dt.UTC)
    rows = pool.load(backend, [r["messages"] for r in requests], level, seconds, warm_up=warm_up)
    return [
        {"phase": phase, "endpoint_id": name, "level": level, "event_id": i, "request_kind": requests[r["request"]]["kind"], "status": _status(r["error"]), "finish_reason": None, "prompt_tokens": None,
         "completion_tokens": None, "elapsed_seconds": r["latency"], "ts": (began + dt.timedelta(seconds=r["begun"] + r["latency"])).isoformat()}
        for i, r in enumerate(rows)
    ]


def _status(error: str | None) -> str:
    if error is None:
        return "ok"
    return "fatal" if error.startswith("http 4") and not error.endswith(("408", "429")) else "retryable"


def summed(spark: SparkSession, rows: list[dict], keys: list[str], timeout: float):
    """The workload summary of measured events. Rates are over the time from first to last answer."""
    table = [tuple(dt.datetime.fromisoformat(r[c]) if c == "ts" else r[c] for c in (x.split()[0] for x in EVENT_DDL.split(", "))) for r in rows]
    return E.workload(spark.createDataFrame(table, EVENT_DDL), keys, timeout)


def benchmark(spark: SparkSession, endpoints: dict[str, tuple[Backend, int]], requests: list[dict], fingerprint: str, log: str, seconds: float = 300.0, warm_up: float = 30.0, timeout: float = 120.0) -> dict:
    """The report: each endpoint (backend, ceiling) level by level, then all together at what each was found to bear.

    What the log holds of a (phase, endpoint, level) under the same fingerprint is not measured again; the combined
    phase only counts if all endpoints are in it.
    """
    rows, done = [], set()
    for event in files.read_events(log) if os.path.exists(log) else []:
        if event["fingerprint"] == fingerprint:
            rows += [x for x in event["rows"] if event["phase"] == "isolated"]
            done.add((event["phase"], event["endpoint_id"], event["level"]))
    for name, (backend, ceiling) in endpoints.items():
        for level in levels(ceiling):
            if ("isolated", name, level) not in done:
                found = measure("isolated", name, backend, requests, level, seconds, warm_up)
                files.append_event({"phase": "isolated", "endpoint_id": name, "level": level, "fingerprint": fingerprint, "rows": found}, log)
                rows += found
    per_level = summed(spark, rows, ["endpoint_id", "level"], timeout).cache()
    chosen = {r.endpoint_id: r for r in E.select_capacity(per_level, "endpoint_id", "level").collect()}
    caps = {name: chosen[name].selected if name in chosen else None for name in endpoints}
    report = {"version": VERSION, "fingerprint": fingerprint, "source": "benchmark", "certified": False, "endpoints": {}}
    for r in per_level.collect():
        if r.level == caps.get(r.endpoint_id):
            report["endpoints"][r.endpoint_id] = {"capacity": r.level, "requests_per_second": r.requests_per_second, "p95": r.p95, "converged": not chosen[r.endpoint_id].nonconverged}
    per_level.unpersist()
    if set(report["endpoints"]) != set(endpoints):
        return report  # one of them bears nothing
    together = _combined(endpoints, caps, requests, fingerprint, log, seconds, warm_up)
    t = summed(spark, together, ["phase"], timeout).first()
    alone = [e["requests_per_second"] for e in report["endpoints"].values()]
    gates = {"efficiency": t.requests_per_second / sum(alone), "speed_up": t.requests_per_second / max(alone), "error_rate": 1 - t.successes / t.requests}
    least_gain = min(SPEED_UP, EFFICIENCY * len(endpoints))  # of one endpoint no gain is asked
    certified = gates["efficiency"] >= EFFICIENCY and gates["speed_up"] >= least_gain and gates["error_rate"] <= ERRORS
    return report | {"combined": gates, "certified": bool(certified and all(e["converged"] for e in report["endpoints"].values()))}


def _combined(endpoints, caps, requests, fingerprint, log, seconds, warm_up) -> list[dict]:
    held = [e for e in files.read_events(log) if e["fingerprint"] == fingerprint and e["phase"] == "combined"]
    last = {e["endpoint_id"]: e for e in held if e["level"] == caps.get(e["endpoint_id"])}
    if set(last) == set(endpoints):
        return [x for e in last.values() for x in e["rows"]]
    found: dict[str, list[dict]] = {}
    runs = [threading.Thread(target=lambda n=n: found.update({n: measure("combined", n, endpoints[n][0], requests, caps[n], seconds, warm_up)})) for n in endpoints]
    for run in runs:
        run.start()
    for run in runs:
        run.join()
    for name, rows in found.items():
        files.append_event({"phase": "combined", "endpoint_id": name, "level": caps[name], "fingerprint": fingerprint, "rows": rows}, log)
    return [x for rows in found.values() for x in rows]


def uncertified(ceilings: dict[str, int]) -> dict:
    """The plan without a benchmark: configured ceilings as capacities, no fingerprint, no baselines."""
    return {"version": VERSION, "certified": False, "fingerprint": "", "source": "configuration", "endpoints": {n: {"capacity": c, "p95": None} for n, c in ceilings.items()}}


def checked(report: dict, ceilings: dict[str, int], fingerprint: str) -> dict:
    """The report if it fits the configuration: every endpoint exactly once on both sides, capacities within ceilings."""
    rules = (
        ("another version", report.get("version") == VERSION),
        ("not certified", report.get("certified") is True),
        ("made under other settings", report.get("fingerprint") == fingerprint),
        ("not from a benchmark", report.get("source") == "benchmark"),
        ("other endpoints", isinstance(report.get("endpoints"), dict) and report["endpoints"].keys() == ceilings.keys()),
    )
    wrong = next((message for message, holds in rules if not holds), None)
    if wrong is None and not all(isinstance(e.get("capacity"), int) and 1 <= e["capacity"] <= ceilings[n] for n, e in report["endpoints"].items()):
        wrong = "a capacity out of range"
    if wrong:
        raise ValueError(f"capacity report: {wrong}")
    return report


def fixture_poems(poems, n: int = 20, longest: int = 4) -> list[dict]:
    """The poems of a bank: the first of each size by id, and the longest; at most n + longest rows reach the driver."""
    from qafila.functions import text as X
    from qafila.operators.selection import first_per_stratum

    names = ("couplets_1_3", "couplets_4_9", "couplets_10_24", "couplets_25_74", "couplets_75_plus")
    sized = poems.filter("couplet_count > 0").withColumn("bucket", X.size_stratum(F.col("couplet_count"), F.lit(False))).select("sample_id", "poem_text", "meter_name", "bucket")
    few = first_per_stratum(sized, "bucket", dict.fromkeys(names, n // len(names)), "sample_id").select("sample_id", "poem_text", "meter_name")
    top = poems.filter("couplet_count > 0").orderBy(F.desc(F.length("poem_text")), "sample_id").limit(longest).select("sample_id", "poem_text", "meter_name")
    return [r.asDict() for r in few.unionByName(top).dropDuplicates(["sample_id"]).orderBy("sample_id").collect()]

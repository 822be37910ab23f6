import datetime as dt
import math
import random

import pytest
from pyspark.sql import functions as F

from qafila.operators import events as E
from qafila.operators import replay as R

T0 = dt.datetime(2026, 1, 1)


@pytest.mark.parametrize("n", [0, 1, 2, 20, 21])
def test_percentile(spark, n):
    values = [float((i * 7) % n) for i in range(n)]
    df = spark.createDataFrame([(k, v) for v in [*values, None] for k in ("a", None)], "k string, x double")
    want = sorted(values)[math.ceil(0.95 * n) - 1] if n else 0.0
    rows = E.with_percentiles(df.groupBy("k").count(), df, ["k"], "x", {"p": 0.95})
    assert sorted((str(r.k), r["count"], r.p) for r in rows.collect()) == [("None", n + 1, want), ("a", n + 1, want)]


def test_percentiles_over_many_tasks(spark, monkeypatch):
    monkeypatch.setattr(E, "RANGE_ROWS", 100)
    rng = random.Random(8)
    data = [(rng.choice("ab"), rng.choice([1.0, 2.0, rng.random() * 50])) for _ in range(3000)]
    df = spark.createDataFrame(data, "k string, x double").repartition(6)
    got = {r.k: (r.low, r.high) for r in E.percentiles(df, ["k"], "x", {"low": 0.5, "high": 0.99}).collect()}
    of = {k: sorted(x for j, x in data if j == k) for k in "ab"}
    assert got == {k: (xs[math.ceil(0.5 * len(xs)) - 1], xs[math.ceil(0.99 * len(xs)) - 1]) for k, xs in of.items()}


def test_capacity(spark):
    df = spark.createDataFrame([("e", 1, 10.0, True), ("e", 2, 19.1, True), ("e", 4, 20.0, True), ("f", 1, 5.0, False), ("g", 1, 1.0, True), ("g", 2, 2.0, True)], "u string, level int, requests_per_second double, safe boolean")
    got = {r.u: (r.selected, r.nonconverged) for r in E.select_capacity(df, "u", "level").collect()}
    assert got == {"e": (2, False), "f": (None, False), "g": (2, True)}


def test_trailing_percentile_against_brute_force(spark):
    rng = random.Random(2)
    data = [(i, rng.choice("ab"), T0 + dt.timedelta(seconds=rng.randrange(4000)), rng.choice([None, rng.random()])) for i in range(400)]
    df = spark.createDataFrame(data, "event_id bigint, k string, ts timestamp, elapsed_seconds double")
    got = {r.event_id: (r.n_recent, r.percentile) for r in E.trailing_percentile(df, ["k"], 300, 0.95, 5).collect()}
    want = {}
    for i, k, t, x in data:
        if x is None:
            continue
        xs = sorted(y for _, k2, t2, y in data if k2 == k and y is not None and 0 <= (t - t2).total_seconds() <= 300)
        if len(xs) >= 5:
            want[i] = (len(xs), xs[min(len(xs) - 1, math.ceil(0.95 * len(xs)) - 1)])
    assert got == want


def test_metrics_text(spark):
    lines = ["# HELP a", "a{x=\"1\"} 2", "a 3.5", "b{y=\"}\"} nope", "", "c 1e2"]
    got = {r.name: r.total for r in E.parse_metrics(spark.createDataFrame([(x,) for x in lines], "value string")).collect()}
    assert got == {"a": 5.5, "c": 100.0}


def fold_log(rows):
    """Plain replay, one event after the other."""
    won, lost, said, chunks = {}, {}, {}, {}
    for seq, s, event, fp, start, error in rows:
        if event == "sample_success":
            won[s] = (fp, seq)
            lost.pop(s, None)
        elif event == "sample_failure" and s not in won:
            lost[s] = error
        elif event == "instruction_success":
            said[s] = (fp, seq)
            chunks[s] = {k: v for k, v in chunks.get(s, {}).items() if v[0] == fp}
        elif event == "reasoning_chunk_success":
            chunks.setdefault(s, {})[start] = (fp, seq)
    return won, lost, said, {(s, k): v for s, c in chunks.items() for k, v in c.items()}


def test_checkpoint_replay_against_a_fold(spark):
    rng = random.Random(9)
    events = ["sample_success", "sample_failure", "instruction_success", "reasoning_chunk_success"]
    rows = [(i, f"s{rng.randrange(25)}", rng.choices(events, [1, 3, 3, 8])[0], rng.choice(["a", "b", None]), rng.randrange(3), f"e{i}") for i in range(600)]
    log = spark.createDataFrame(rows, "seq bigint, sample_id string, event string, fingerprint string, start_offset int, error string")
    won, lost, said, chunks = fold_log(rows)
    assert {r.sample_id: (r.fingerprint, r.seq) for r in R.successes(log).collect()} == won
    assert {r.sample_id: r.error for r in R.failures(log).collect()} == lost
    assert {r.sample_id: (r.fingerprint, r.seq) for r in R.instructions(log).collect()} == said
    assert {(r.sample_id, r.start_offset): (r.fingerprint, r.seq) for r in R.chunks(log).collect()} == chunks


def test_event_versions(spark):
    rows = [(None, "success", None), (None, "x", None), ("stage_success", None, "instruction"), ("stage_success", None, "reasoning_chunk"), ("instruction_success", None, None)]
    got = [r.event for r in R.unify_events(spark.createDataFrame(rows, "event string, status string, stage_name string")).collect()]
    assert got == ["sample_success", "sample_failure", "instruction_success", "reasoning_chunk_success", "instruction_success"]


def test_endpoint_halves_opens_and_recovers():
    s = R.Endpoint()
    R.step(s, 0, "http", 429, None, None, retry_after=7.0)
    assert (s.effective, s.circuit_until) == (4, 7.0)
    R.step(s, 1, "timeout", None, None, None)
    assert s.effective == 2
    R.step(s, 2, "transport", None, None, None)  # third in a row
    assert s.circuit_until == 32 and not s.half_open
    R.step(s, 40, "ok", None, 1.0, None)
    assert (s.circuit_until, s.half_open, s.failures_in_row) == (0.0, False, 0)
    for i in range(25):
        R.step(s, 41 + i * 3, "ok", None, 1.0, None)
    assert s.effective == 3
    R.step(s, 200, "http", 401, None, None)
    assert s.disabled and s.effective == 0 and s.fatal == 1


def test_endpoint_slows_down_after_two_bad_checks():
    s = R.Endpoint()
    for i in range(130):
        R.step(s, float(i), "ok", None, 10.0, 2.0)
    assert s.effective == 7
    for i in range(130, 190):
        R.step(s, float(i), "ok", None, 1.0, 2.0)
    assert s.effective == 8  # recovered


def test_fold_endpoints(spark):
    rows = [(i, "e1", T0 + dt.timedelta(seconds=i), "ok" if i % 4 else "retryable", 1.0) for i in range(40)] + [(99, None, T0, "ok", 1.0)]
    df = spark.createDataFrame(rows, "event_id bigint, endpoint_id string, ts timestamp, status string, elapsed_seconds double")
    (r,) = R.fold_endpoints(df, 5.0).collect()
    assert (r.endpoint_id, r.requests, r.successes, r.retryable) == ("e1", 40, 30, 10)
    assert R.fold_endpoints(df.limit(0), 5.0).count() == 0


def test_delivered_once(spark):
    df = spark.createDataFrame([(1, "a", T0), (1, "b", T0 + dt.timedelta(1)), (2, "c", T0)], "event_id bigint, v string, arrived_at timestamp")
    assert sorted(r.v for r in E.delivered_once(df).collect()) == ["b", "c"]
    assert E.delivered_once(df.filter(F.lit(False))).count() == 0

"""Benchmark, pilot, manifest, trace and HTTP backend."""

import http.server
import json
import threading
import time

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from qafila.operators import capacity, outputs, pilot, replay, tracing
from qafila.operators import generation as G
from qafila.operators import selection as S
from qafila.operators.pool import RequestFailed
from qafila.sources import chat, files

SCHEMA = "sample_id string, record_no bigint, poet_name string, meter_name string, poem_theme string, poem_title string, metadata_conflict boolean, verses array<string>"


@pytest.fixture(scope="module")
def poems(spark):
    rows = [(f"{i:064x}", i, "p", "الرجز", "غزل", None, i % 3 == 0, [f"كلمة رقم {i} {k}" for k in range(2 * (i % 7 + 1))]) for i in range(60)]
    return S.measured(spark.createDataFrame(rows, SCHEMA))


def sound(wait=0.0):
    """A backend never at fault, after a moment. Its class is made here, so that workers get it by value."""

    class Sound(G.OfflineBackend):
        def chat(self, messages, seed):
            time.sleep(wait)
            return super().chat(messages, seed)

    return Sound(1 << 40, 1 << 40, 1 << 40)


def test_bank_follows_the_mix(poems):
    chosen = capacity.fixture_poems(poems)
    assert len({p["sample_id"] for p in chosen}) == len(chosen) <= 24
    for t in G.TASKS.values():
        got = capacity.bank(t, chosen)
        assert len(got) == 84 and [g["kind"] for g in got[: t.fixtures[0][1]]] == [t.fixtures[0][0]] * t.fixtures[0][1]
        assert all(g["messages"][0]["content"].startswith("أنت مراجع") == g["kind"].endswith("validation") for g in got)
    with pytest.raises(ValueError):
        capacity.bank(G.task("mcq"), [])


def test_benchmark_reports_and_resumes(spark, poems, tmp_path):
    log = str(tmp_path / "log.jsonl")
    requests = capacity.bank(G.task("mcq"), capacity.fixture_poems(poems))
    endpoints = {n: (sound(0.01), 2) for n in ("a", "b")}
    report = capacity.benchmark(spark, endpoints, requests, "fp", log, seconds=0.4, warm_up=0.05)
    assert set(report["endpoints"]) == {"a", "b"} and report["combined"]["error_rate"] == 0

    class Never:
        def chat(self, messages, seed):
            raise AssertionError

    again = capacity.benchmark(spark, {n: (Never(), 2) for n in "ab"}, requests, "fp", log, seconds=0.4)
    assert again == report
    fits = report | {"certified": True}
    assert capacity.checked(fits, {"a": 2, "b": 2}, "fp") is fits
    for change, ceilings, fp in (({"certified": False}, {"a": 2, "b": 2}, "fp"), ({}, {"a": 2}, "fp"), ({}, {"a": 2, "b": 2}, "other"), ({}, {"a": 0, "b": 2}, "fp")):
        with pytest.raises(ValueError):
            capacity.checked(fits | change, ceilings, fp)
    assert capacity.uncertified({"a": 3}) == {"version": 1, "certified": False, "fingerprint": "", "source": "configuration", "endpoints": {"a": {"capacity": 3, "p95": None}}}
    assert capacity.levels(5) == [1, 2, 4, 5]


def test_pilot_and_its_gate(spark, poems, tmp_path):
    folder = str(tmp_path / "pilot")
    quotas = {"couplets_1_3": 20, "couplets_4_9": 20}
    report = pilot.run(poems, "mcq", folder, sound(), quotas=quotas)
    assert report["selected"] == 40 and report["generated"] == 80 and report["complete"] and report["gates"]["success_ok"]
    assert report["template_id_counts"] == {"poem_meter": 40, "poem_theme": 40} if "template_id_counts" in report else True
    fp = G.task("mcq").fingerprint({})
    with pytest.raises(ValueError, match="without decision"):
        pilot.passed(folder, "mcq", fp)
    told = files.read_document(folder + "/reviews.json")
    assert len(told["reviews"]) == 30
    files.write_document(told | {"reviews": [r | {"approved": True} for r in told["reviews"]]}, folder + "/reviews.json")
    assert pilot.passed(folder, "mcq", fp) == report
    with pytest.raises(ValueError, match="other settings"):
        pilot.passed(folder, "mcq", "x")
    with pytest.raises(ValueError, match="another task"):
        pilot.passed(folder, "poem-generation", fp)
    with pytest.raises(ValueError, match="holds mcq"):
        outputs.claim(folder, "poem-generation")
    assert pilot.gates(0, 0, 0)["success_ok"] is False and pilot.gates(98, 2, 25)["repaired_ok"] is False


def test_manifest_and_publication(spark, poems, tmp_path):
    made = G.generate(poems, "poem-reconstruction").cache()
    records = outputs.with_dimensions(G.records_of(made, poems, "poem-reconstruction"))
    m = outputs.manifest("poem-reconstruction", poems, records, outputs.failures_of(made), 40, note="x")
    assert m["selected"] == 60 and m["generated"] + m["failed"] == 60 and m["conflicts"] == 20 and m["note"] == "x"
    assert sum(m["corruption_count_counts"].values()) == m["generated"] and m["oversized"] == poems.filter(F.length("poem_text") > 40).count()
    assert outputs.publish(records, str(tmp_path / "out")) and outputs.publish(records.filter("work_order < 9"), str(tmp_path / "out"))
    parts = sorted(p for p in (tmp_path / "out").iterdir() if p.suffix == ".parquet")
    assert [x for p in parts for x in pq.read_table(p)["work_order"].to_pylist()] == list(range(9))


def test_trace_and_snapshots(spark, tmp_path):
    trace = tracing.Trace(str(tmp_path / "trace.jsonl"), "r1")
    trace.started(G.task("mcq"), {"temperature": 0}, {"selected": 3})
    seen = []
    with tracing.Snapshots(lambda: {"n": 1}, seen.append, seconds=0.02):
        time.sleep(0.09)
    trace.request({"request": {}, "failure": "timeout"})
    rows = tracing.read(spark, trace.path).collect()
    assert [(r.run_id, r.event) for r in rows] == [("r1", "run_start"), ("r1", "request_failure")] and json.loads(rows[0].line)["task_type"] == "mcq"
    assert len(seen) >= 3


def test_http_backend():
    told, codes = [], [200, 429, 500, 401, 200]

    class Handler(http.server.BaseHTTPRequestHandler):
        def do_POST(self):
            body = json.loads(self.rfile.read(int(self.headers["Content-Length"])))
            code = codes.pop(0)
            self.send_response(code)
            self.send_header("Retry-After", "7")
            self.end_headers()
            self.wfile.write(json.dumps({"choices": [{"message": {"content": body["messages"][0]["content"]}}]}).encode() if codes else b"junk")

        def log_message(self, *_):
            pass

    server = http.server.HTTPServer(("127.0.0.1", 0), Handler)
    threading.Thread(target=server.serve_forever, daemon=True).start()
    b = chat.HttpBackend(f"http://127.0.0.1:{server.server_port}/", "m", "k", timeout=5, told=told.append)
    say = [{"role": "user", "content": "hi"}]
    assert b.chat(say, 1) == "hi"
    for event, wait in ((replay.THROTTLED, 7.0), (replay.PASSING, 7.0), (replay.REFUSED, 7.0), (replay.PASSING, None)):
        with pytest.raises(RequestFailed) as e:
            b.chat(say, 1)
        assert (e.value.event, e.value.retry_after) == (event, wait)
    server.shutdown()
    server.server_close()
    slept = []
    codes.append(0)
    with pytest.raises(G.Outage):
        chat.Retrying(chat.HttpBackend(b.url, "m", timeout=1), 2, slept.append).chat(say, 1)
    assert slept == [1, 2] and [("failure" in t) for t in told] == [False, True, True, True, True]
    assert chat.wait_asked("Thu, 01 Jan 1970 00:00:30 GMT", 10.0) == 20.0 and chat.wait_asked("soon", 0) is None and chat.wait_asked("-3", 0) == 0

"""Endpoints behind one backend: retries with back-off, fail-over, circuit breaking and adaptive capacity.

A pool lives in one process. On a cluster each Python worker has its own, with the configured ceiling divided among the
tasks that may run at once (share_of); the state machine itself is the one that replays logs (qafila.operators.replay).
"""

from __future__ import annotations

import threading
import time
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field

from qafila.operators import replay
from qafila.operators.generation import Backend, Outage


class RequestFailed(RuntimeError):
    """One failed request: what kind, and the status if there was an answer."""

    def __init__(self, kind: str, status: int | None = None, retry_after: float | None = None) -> None:
        super().__init__(f"{kind} {status or ''}".strip())
        self.kind, self.status, self.retry_after = kind, status, retry_after

    @property
    def event(self) -> str:
        return replay.event_of(self.kind, self.status)


def share_of(ceiling: int, tasks: int) -> int:
    return max(1, ceiling // max(1, tasks))


@dataclass
class Member:
    name: str
    backend: Backend
    state: replay.Endpoint
    baseline: float | None = None
    in_flight: int = 0
    served: int = 0  # the number of the last request it took

    def load(self, now: float) -> float | None:
        """The share of its seats that are taken; None if no seat is free."""
        seats = self.state.seats(now)
        return self.in_flight / seats if self.in_flight < seats else None


@dataclass
class Pool:
    """chat() takes the least loaded endpoint with a free seat, of equal ones whoever has waited longest; after a failure
    one that has not failed this request, if there is any."""

    members: list[Member]
    retries: int = 3
    clock: Callable[[], float] = time.monotonic
    sleep: Callable[[float], None] = time.sleep
    _taken: int = 0
    _lock: threading.Condition = field(default_factory=threading.Condition)
    attempts: list[tuple[str, str]] = field(default_factory=list)

    def _take(self, tried: set[str]) -> Member:
        with self._lock:
            while True:
                usable = [m for m in self.members if not m.state.disabled]
                if not usable:
                    raise Outage("no usable endpoint")
                asked = [m for m in usable if m.name not in tried] or usable
                now = self.clock()
                free = [(share, m.served, m) for m in asked if (share := m.load(now)) is not None]
                if free:
                    break
                # a rest ends by itself, a taken seat is given back by whoever has it
                rests = [m.state.circuit_until - now for m in asked if m.state.circuit_until > now]
                self.sleep(min(rests)) if len(rests) == len(asked) else self._lock.wait(0.25)
            chosen = min(free, key=lambda x: x[:2])[2]
            self._taken += 1
            chosen.in_flight, chosen.served = chosen.in_flight + 1, self._taken
            return chosen

    def _give(self, m: Member, outcome: str, status: int | None, took: float | None, retry_after: float | None, attempt: int) -> None:
        with self._lock:
            m.in_flight -= 1
            replay.step(m.state, self.clock(), outcome, status, took, m.baseline, retry_after, attempt)
            self.attempts.append((m.name, outcome))
            self._lock.notify_all()

    def chat(self, messages: list[dict], seed: int) -> str:
        tried: set[str] = set()
        for k in range(self.retries + 1):
            m, began = self._take(tried), self.clock()
            try:
                answer = m.backend.chat(messages, seed)
            except RequestFailed as e:
                self._give(m, e.kind, e.status, None, e.retry_after, k)
                tried.add(m.name)
                if e.event == replay.FATAL:
                    raise
                if len(tried) >= len(self.members) and k < self.retries:
                    self.sleep(float(min(2**k, 16)))
                continue
            self._give(m, "ok", None, self.clock() - began, None, k)
            return answer
        raise Outage("all attempts failed")

    def snapshot(self) -> list[dict]:
        with self._lock:
            return [{"endpoint_id": m.name, "hard": m.state.hard, "effective": m.state.effective, "disabled": m.state.disabled, "requests": m.state.requests, "successes": m.state.successes} for m in self.members]


class PoolOf:
    """A pool that is made where it is first used: it holds locks, which do not travel to workers."""

    def __init__(self, members: list[tuple[str, Backend, int, float | None]], retries: int = 3) -> None:
        self.members, self.retries, self._pool = members, retries, None

    def __getstate__(self) -> dict:
        return {"members": self.members, "retries": self.retries, "_pool": None}

    def chat(self, messages: list[dict], seed: int) -> str:
        if self._pool is None:
            self._pool = Pool([Member(n, b, replay.Endpoint(hard=seats, effective=seats), base) for n, b, seats, base in self.members], self.retries)
        return self._pool.chat(messages, seed)


def load(backend: Backend, requests: list[list[dict]], workers: int, seconds: float, clock: Callable[[], float] = time.perf_counter, warm_up: float = 0.0) -> list[dict]:
    """Closed-loop load: workers take requests in turn until the time is over; one row per request begun after the
    warm-up and finished, however late."""
    rows, lock, turn, began_at = [], threading.Lock(), iter(range(1 << 60)), clock()
    measured, until = began_at + warm_up, began_at + warm_up + seconds

    def work() -> None:
        while clock() < until:
            with lock:
                i = next(turn)
            began, error = clock(), None
            try:
                backend.chat(requests[i % len(requests)], i)
            except (RequestFailed, Outage) as e:
                error = str(e)
            if began >= measured:
                with lock:
                    rows.append({"request": i % len(requests), "begun": began - began_at, "latency": clock() - began, "error": error})

    threads = [threading.Thread(target=work) for _ in range(workers)]
    for t in threads:
        t.start()
    for t in threads:
        t.join()
    return rows


def in_order(work: Callable, items: list, workers: int) -> list:
    """A bounded parallel map whose results stand in the order of the items; the first Outage ends it and is raised,
    any other error is the result of its item."""
    if workers < 1:
        raise ValueError("at least one worker")

    def one(item):
        try:
            return work(item)
        except Outage:
            raise
        except Exception as e:  # a failed item is a row, not a failed run
            return e

    with ThreadPoolExecutor(workers) as pool:
        jobs = [pool.submit(one, x) for x in items]
        try:
            return [job.result() for job in jobs]
        except Outage:
            for job in jobs:
                job.cancel()
            raise

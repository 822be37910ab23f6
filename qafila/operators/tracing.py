"""What a run tells while it goes: events of one run id as JSON lines, and snapshots at intervals."""

from __future__ import annotations

import datetime as dt
import sys
import threading
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from qafila.sources import files


class Trace:
    """Events appended to a log with run id and time; safe to use from several threads."""

    def __init__(self, path: str, run_id: str | None = None, console: bool = False) -> None:
        self.path, self.run_id, self.console = path, run_id or uuid.uuid4().hex, console
        self._lock = threading.Lock()

    def emit(self, event: str, **fields) -> None:
        row = {"run_id": self.run_id, "at": dt.datetime.now(dt.UTC).isoformat(timespec="milliseconds"), "event": event} | fields
        with self._lock:
            files.append_event(row, self.path, version=None)
        if self.console:
            print(f"{row['at']} {event} " + " ".join(f"{k}={v}" for k, v in fields.items()), file=sys.stderr)

    def started(self, task, settings: dict, counts: dict) -> None:
        """The run's first event: what is run, on how much, under which settings."""
        self.emit("run_start", **task.trace(), settings_used=task.contract(settings), fingerprint=task.fingerprint(settings), counts=counts)

    def request(self, told: dict) -> None:
        """A backend's request with its answer or its failure."""
        self.emit("request_failure" if "failure" in told else "request", **told)


def read(spark: SparkSession, path: str) -> DataFrame:
    """run_id, at, event and the whole line of every traced event."""
    lines = spark.read.text(path).filter(F.trim("value") != "")
    return lines.select(F.from_json("value", "run_id string, at timestamp, event string").alias("x"), "value").select("x.*", F.col("value").alias("line"))


class Snapshots:
    """Calls write(snapshot()) every so many seconds until closed, and once more then."""

    def __init__(self, snapshot: Callable[[], dict], write: Callable[[dict], None], seconds: float = 60.0) -> None:
        self.snapshot, self.write, self.seconds = snapshot, write, seconds
        self._over = threading.Event()
        self._thread = threading.Thread(target=self._run, daemon=True)

    def _run(self) -> None:
        while not self._over.wait(self.seconds):
            self.write(self.snapshot())

    def __enter__(self) -> Snapshots:
        self._thread.start()
        return self

    def __exit__(self, *_) -> None:
        self._over.set()
        self._thread.join()
        self.write(self.snapshot())

"""Request telemetry: deduplication, workload summaries, capacity, provenance and trailing percentiles."""

from __future__ import annotations

import math
from bisect import bisect_left, insort
from collections import deque
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from qafila.operators.selection import latest
from qafila.runtime import cut

#: Distinct values one task counts through.
RANGE_ROWS = 1_000_000
SAFE_RETRYABLE = 0.005
GOOD_ENOUGH = 0.95


def delivered_once(events: DataFrame) -> DataFrame:
    """Of an event delivered twice the last arrival."""
    return latest(events, "event_id", "arrived_at")


def percentiles(events: DataFrame, keys: list[str], value: str, shares: dict[str, float]) -> DataFrame:
    """The keys with one column a share: the nearest-rank percentile of the values that are not null.

    Exact, and no task holds more than RANGE_ROWS: equal values are counted before the shuffle, the distinct ones are
    ranged over as many tasks as that takes by key and value, and a place is found from what stands before a task and
    within it. Keys may be null; keys without a value have no row.
    """
    counted = events.filter(F.col(value).isNotNull()).select(F.struct(*keys).alias("_k"), F.col(value).alias("_v")).groupBy("_k", "_v").agg(F.count("*").alias("_c"))
    placed = cut(counted.withColumn("_task", F.lit(0)))
    tasks = -(-placed.count() // RANGE_ROWS)
    if tasks > 1:
        placed = cut(placed.repartitionByRange(tasks, "_k", "_v").withColumn("_task", F.spark_partition_id()))
    by_key = Window.partitionBy("_k")
    held = placed.groupBy("_k", "_task").agg(F.sum("_c").alias("_here"))
    held = held.withColumns({"_before": F.sum("_here").over(by_key.orderBy("_task")) - F.col("_here"), "_all": F.sum("_here").over(by_key)})
    inside = Window.partitionBy("_task", "_k").orderBy("_v").rowsBetween(Window.unboundedPreceding, 0)
    ranked = placed.withColumn("_upto", F.sum("_c").over(inside)).join(held, ["_k", "_task"]).withColumn("_upto", F.col("_upto") + F.col("_before"))

    def found(share: float) -> Column:
        rank = F.greatest(F.lit(1), F.ceil(F.lit(share) * F.col("_all") - 1e-9))
        return F.max(F.when((F.col("_upto") >= rank) & (F.col("_upto") - F.col("_c") < rank), F.col("_v")))

    return ranked.groupBy("_k").agg(*(found(p).alias(name) for name, p in shares.items())).select("_k.*", *shares)


def with_percentiles(rows: DataFrame, events: DataFrame, keys: list[str], value: str, shares: dict[str, float]) -> DataFrame:
    """rows (one a key) with the percentiles of their events; of nothing 0."""
    of = percentiles(events, keys, value, shares)
    same = F.lit(True)
    for k in keys:
        same = same & rows[k].eqNullSafe(of[k])
    joined = rows.join(of, same, "left")
    return joined.select(*(rows[c] for c in rows.columns), *(F.coalesce(of[c], F.lit(0.0)).alias(c) for c in shares))


def workload(events: DataFrame, keys: list[str], timeout_s: float) -> DataFrame:
    """One row per key: outcomes, rate, tokens, latency percentiles and whether the level is safe.

    Latency percentiles include failed requests; the rate counts successes only.
    """
    ok = F.col("status") == "ok"
    seconds = F.greatest(F.lit(1e-6), (F.max("ts").cast("timestamp").cast("double") - F.min("ts").cast("timestamp").cast("double")))
    rows = events.groupBy(*keys).agg(
        F.count("*").alias("requests"),
        F.count_if(ok).alias("successes"),
        F.count_if(F.col("status") == "retryable").alias("retryable_errors"),
        F.count_if(F.col("status") == "fatal").alias("nonretryable_errors"),
        F.count_if(ok & (F.col("finish_reason") == "length")).alias("truncations"),
        F.coalesce(F.sum(F.when(ok, F.col("prompt_tokens"))), F.lit(0)).alias("prompt_tokens"),
        F.coalesce(F.sum(F.when(ok, F.col("completion_tokens"))), F.lit(0)).alias("completion_tokens"),
        seconds.alias("seconds"),
    )
    rows = with_percentiles(rows, events.select(*keys, "elapsed_seconds"), keys, "elapsed_seconds", {"p50": 0.5, "p95": 0.95})
    rate = F.when(F.col("requests") > 0, F.col("retryable_errors") / F.col("requests")).otherwise(1.0)
    return rows.withColumns({
        "requests_per_second": F.col("successes") / F.col("seconds"),
        "safe": (F.col("nonretryable_errors") == 0) & (rate <= SAFE_RETRYABLE) & (F.col("p95") < timeout_s / 2),
    })


def select_capacity(levels: DataFrame, unit: str, level: str) -> DataFrame:
    """unit, selected (smallest safe level within 95 % of the best safe rate; null if none is safe), nonconverged."""
    best = levels.withColumn("best", F.max(F.when(F.col("safe"), F.col("requests_per_second"))).over(Window.partitionBy(unit)))
    hit = F.col("safe") & (F.col("requests_per_second") >= F.col("best") * GOOD_ENOUGH)
    order = Window.partitionBy(unit).orderBy(level)
    gain = best.withColumns({"previous": F.lag("requests_per_second").over(order), "last": F.lead(level).over(order).isNull()})
    step = F.when(F.col("previous") > 0, (F.col("requests_per_second") - F.col("previous")) / F.col("previous")).otherwise(1.0)
    open_end = F.col("last") & F.col("safe") & F.col("previous").isNotNull() & (step >= 0.05)
    return gain.groupBy(unit).agg(F.min(F.when(hit, F.col(level))).alias("selected"), F.coalesce(F.bool_or(open_end), F.lit(False)).alias("nonconverged"))


def provenance(events: DataFrame) -> DataFrame:
    """Per sample: endpoints, attempts, fail-overs and truncations; only requests that succeeded in the end count."""
    requests = (
        events.filter("endpoint_id is not null")
        .groupBy("sample_id", "request_kind")
        .agg(
            F.collect_set("endpoint_id").alias("endpoints"),
            F.count("*").alias("attempts"),
            F.count_if(F.col("finish_reason") == "length").alias("truncations"),
            F.bool_or(F.col("status") == "ok").alias("done"),
        )
        .filter("done")
    )
    return requests.groupBy("sample_id").agg(
        F.array_sort(F.array_distinct(F.flatten(F.collect_list("endpoints")))).alias("endpoints"),
        F.sum("attempts").alias("attempts"),
        F.sum(F.greatest(F.lit(0), F.size("endpoints") - 1)).alias("failovers"),
        F.sum("truncations").alias("truncations"),
    )


def merge_provenance(current: DataFrame, prior: DataFrame) -> DataFrame:
    """Prior stages bring the union of endpoints and the maximum, not the sum, of their counters."""
    counts = ("attempts", "failovers", "truncations")
    old = prior.groupBy("sample_id").agg(F.array_distinct(F.flatten(F.collect_list("endpoints"))).alias("old_endpoints"), *(F.max(c).alias(f"old_{c}") for c in counts))
    empty = F.array().cast("array<string>")
    return current.join(old, "sample_id", "left").select(
        "sample_id",
        F.array_sort(F.array_union("endpoints", F.coalesce("old_endpoints", empty))).alias("endpoints"),
        *((F.col(c) + F.coalesce(f"old_{c}", F.lit(0))).alias(c) for c in counts),
    )


class _Sliding:
    """The values of a moving span, in order of time and in order of size."""

    def __init__(self) -> None:
        self.times: deque[tuple[float, float]] = deque()
        self.sizes: list[float] = []

    def add(self, t: float, x: float) -> None:
        self.times.append((t, x))
        insort(self.sizes, x)

    def drop_before(self, t: float) -> None:
        while self.times and self.times[0][0] < t:
            x = self.times.popleft()[1]
            del self.sizes[bisect_left(self.sizes, x)]


def trailing_percentile(events: DataFrame, keys: list[str], span_s: int, p: float, at_least: int) -> DataFrame:
    """For each event the nearest-rank percentile of the key's latencies in the last span_s seconds, itself and those of
    the same moment included.

    Keys are few and their history long, so rows are cut into time buckets of one span; each row also goes to the next
    bucket as context. Buckets stream through a task in order of time, and it holds the values of one span, kept sorted.
    """
    t = F.col("ts").cast("timestamp").cast("double")
    rows = events.filter("elapsed_seconds is not null").select("event_id", *keys, t.alias("t"), F.col("elapsed_seconds").alias("x"))
    rows = rows.withColumn("bucket", F.floor(F.col("t") / span_s)).withColumn("b", F.explode(F.array("bucket", F.col("bucket") + 1)))
    placed = rows.repartition(*keys, "b").sortWithinPartitions(*keys, "b", "t")
    kinds = {f.name: f.dataType.simpleString() for f in events.schema}
    ddl = ", ".join(f"{c} {kinds[c]}" for c in ("event_id", *keys)) + ", n_recent int, percentile double"
    names = ["event_id", *keys]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        now, span, moment, waiting = None, _Sliding(), None, []

        def told() -> list[tuple]:
            """Those of one moment see each other, so they are told when it is over."""
            n = len(span.sizes)
            if n < at_least or not waiting:
                return []
            at = max(0, math.ceil(p * n - 1e-9) - 1)
            return [(*w, n, span.sizes[at]) for w in waiting]

        for batch in batches:
            out = []
            for *row, at, x, bucket, b in zip(*(batch[c].tolist() for c in (*names, "t", "x", "bucket", "b")), strict=True):
                place = (*row[1:], b)
                if place != now or at != moment:
                    out += told()
                    waiting = []
                if place != now:
                    now, span = place, _Sliding()
                moment = at
                span.drop_before(at - span_s)
                span.add(at, x)
                if bucket == b:
                    waiting.append(row)
            yield pd.DataFrame(out, columns=[*names, "n_recent", "percentile"])
        yield pd.DataFrame(told(), columns=[*names, "n_recent", "percentile"])

    return placed.mapInPandas(run, ddl)


def parse_metrics(lines: DataFrame, column: str = "value") -> DataFrame:
    """Sums of a text exposition's counters over their labels; comments and unreadable lines are left out."""
    m = lines.select(
        F.regexp_extract(column, r"^([a-zA-Z_:][\w:]*)(?:\{[^}]*\})?\s+([-+0-9.eE]+)\s*$", 1).alias("name"),
        F.regexp_extract(column, r"^([a-zA-Z_:][\w:]*)(?:\{[^}]*\})?\s+([-+0-9.eE]+)\s*$", 2).try_cast("double").alias("v"),
    )
    return m.filter("name <> '' and v is not null").groupBy("name").agg(F.sum("v").alias("total"))

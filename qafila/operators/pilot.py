"""A pilot run: a stratified choice of poems through a task, gates on what came out, a sample for human review."""

from __future__ import annotations

import math
import os
import time

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from qafila.functions import text as X
from qafila.operators import generation as G
from qafila.operators import outputs
from qafila.operators.selection import first_per_stratum
from qafila.runtime import cut
from qafila.sources import files

SUCCESS, REPAIRED, REVIEWS = 0.98, 0.25, 30
QUOTAS = {"couplets_1_3": 20, "couplets_4_9": 30, "couplets_10_24": 30, "couplets_25_74": 15, "couplets_75_plus": 5, "oversized": 4}


def review(records: DataFrame, group: str, per_group: int, total: int = REVIEWS) -> DataFrame:
    """record_id, group: the first of every group, repaired ones first, then by id; topped up by id to the total.

    Groups may be huge: each is cut per input task before it is ranked (first_per_stratum).
    """
    rows = records.select("record_id", F.col(group).cast("string").alias("grp"), (F.col("validation_status") != "passed_after_repair").alias("later"))
    names = [r.grp for r in rows.filter("grp is not null").select("grp").distinct().orderBy("grp").limit(total).collect()]
    first = cut(first_per_stratum(rows, "grp", dict.fromkeys(names, per_group), "later", "record_id").select("record_id", "grp"))
    rest = rows.join(first, "record_id", "left_anti").orderBy("record_id").limit(total).select("record_id", F.lit("top-up").alias("grp"))
    return first.withColumn("o", F.lit(0)).unionByName(rest.withColumn("o", F.lit(1))).orderBy("o", "record_id").limit(total).select("record_id", "grp")


def gates(done: int, failed: int, repaired: int, truncated: int = 0) -> dict:
    asked = done + failed
    rate = done / asked if asked else 0.0
    return {
        "success_rate": rate, "success_ok": rate >= SUCCESS, "repaired": repaired, "repaired_ok": repaired <= math.floor(done * REPAIRED),
        "truncated": truncated, "truncated_ok": truncated == 0,
    }


def content_fingerprint(records: DataFrame) -> str:
    """One digest of all records, whatever order they come in: the digests of the responses in the order of their ids are
    hashed in ranges, and the few range digests once more."""
    tasks = int(records.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    bucket = F.pmod(F.xxhash64("record_id"), F.lit(max(tasks, 16)))
    each = records.select(bucket.alias("b"), F.sha2(F.concat_ws("\x1f", "record_id", "response"), 256).alias("d"))
    parts = each.groupBy("b").agg(F.bit_xor(F.conv(F.substring("d", 1, 15), 16, 10).cast("bigint")).alias("x"), F.bit_xor(F.conv(F.substring("d", 16, 15), 16, 10).cast("bigint")).alias("y"), F.count("*").alias("n"))
    return files.digest([[r.b, r.x, r.y, r.n] for r in parts.orderBy("b").collect()])


def run(poems: DataFrame, name: str, folder: str, backend=None, settings: dict | None = None, quotas: dict[str, int] | None = None, group: str = "stratum", per_group: int = 5) -> dict:
    """Select, generate, judge by the gates, write report.json and reviews.json; gives the report."""
    outputs.claim(folder, name)
    os.makedirs(folder, exist_ok=True)
    settings, began = settings or {}, time.perf_counter()
    most = settings.get("max_source_chars") or 1 << 30
    strata = poems.withColumn("stratum", X.size_stratum(F.col("couplet_count"), F.length("poem_text") > most))
    chosen = cut(first_per_stratum(strata, "stratum", quotas or QUOTAS, "sample_id").drop("stratum_rank"))
    made = cut(G.generate(chosen, name, backend, settings=settings))
    records = cut(G.records_of(made, chosen, name, ("stratum",)))
    report = outputs.manifest(name, chosen, records, outputs.failures_of(made), settings.get("max_source_chars"))
    took = time.perf_counter() - began
    report |= {"gates": gates(report["generated"], report["failed"], report["repaired"]), "fingerprint": G.task(name).fingerprint(settings), "content": content_fingerprint(records), "records_per_hour": report["generated"] / took * 3600}
    asked = [{"record_id": r.record_id, "group": r.grp, "approved": None, "notes": ""} for r in review(records, group, per_group).collect()]
    files.write_document({"content": report["content"], "reviews": asked}, os.path.join(folder, "reviews.json"))
    files.write_document(report, os.path.join(folder, "report.json"))
    files.write_document(report, os.path.join(folder, "manifest.json"))
    return report


def passed(folder: str, name: str, fingerprint: str, wanted: int = REVIEWS) -> dict:
    """The report of a pilot that allows a full run; the first thing that stands against it raises."""
    paths = {n: os.path.join(folder, f"{n}.json") for n in ("report", "reviews")}
    missing = [n for n, p in paths.items() if not os.path.exists(p)]
    if missing:
        raise ValueError(f"pilot: no {missing[0]}")
    report, told = (files.read_document(paths[n]) for n in ("report", "reviews"))
    found, marks = told.get("reviews", []), report.get("gates", {})
    ids = [r.get("record_id") for r in found]
    rules = (
        ("another task", report.get("task_type") == name),
        ("other settings", report.get("fingerprint") == fingerprint),
        ("too few succeeded", marks.get("success_ok") is True),
        ("too many were repaired", marks.get("repaired_ok") is True),
        ("answers were cut off", marks.get("truncated_ok") is True),
        ("reviews of other content", told.get("content") == report.get("content")),
        (f"not {wanted} reviews", len(found) == wanted),
        ("a review twice", len(set(ids)) == len(ids)),
        ("a review without record", all(isinstance(i, str) and i for i in ids)),
        ("a review without decision", all(isinstance(r.get("approved"), bool) for r in found)),
        ("a record was not approved", all(r.get("approved") for r in found)),
        ("notes are no text", all(isinstance(r.get("notes", ""), str) for r in found)),
    )
    for message, holds in rules:
        if not holds:
            raise ValueError(f"pilot: {message}")
    return report

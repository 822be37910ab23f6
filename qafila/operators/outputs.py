"""What a run leaves: records in the order of work, their counts, the manifest, and whose folder it is."""

from __future__ import annotations

import os

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from qafila.functions import text as X
from qafila.operators.selection import TEMPLATES
from qafila.sources import files

#: Columns of records and failures that are counted by value; those absent are left out.
DIMENSIONS = ("task_type", "sft_split", "template_id", "metadata_field", "prompt_no", "corruption_count", "validation_status", "meter_name", "failure_category")


def with_dimensions(records: DataFrame) -> DataFrame:
    """records with what their ids imply: template and field of a question, corruptions of a reconstruction."""
    of_kind = lambda kind, value: F.when(F.col("task_type") == kind, value)
    template = F.get(F.split("record_id", ":"), F.lit(2))
    fields = F.create_map(*(F.lit(x) for t in TEMPLATES for x in t))
    return records.withColumns({
        "template_id": of_kind("mcq", template), "metadata_field": of_kind("mcq", F.try_element_at(fields, template)),
        "corruption_count": of_kind("poem-reconstruction", X.corruption_count(F.col("sample_id"), F.col("couplet_count"))),
    })


def failures_of(made: DataFrame) -> DataFrame:
    """work_id, sample_id, error, failure_category of the outcomes that failed."""
    lost = made.filter("error is not null")
    return lost.select("work_id", "sample_id", "error", X.failure_category(F.col("error")).alias("failure_category"))


def counters(rows: DataFrame, dimensions: tuple[str, ...] = DIMENSIONS) -> DataFrame:
    """dim, value, n: how often each value of each dimension occurs. One pass, combined before its one shuffle."""
    pairs = [F.struct(F.lit(c).alias("dim"), F.col(c).cast("string").alias("value")) for c in dimensions if c in rows.columns]
    return rows.select(F.explode(F.array(*pairs)).alias("x")).filter("x.value is not null").groupBy("x.dim", "x.value").agg(F.count("*").alias("n"))


def totals(selected: DataFrame, records: DataFrame, failures: DataFrame, max_source_chars: int | None = None) -> DataFrame:
    """One row: selected, generated, failed, repaired, oversized, conflicts, complete."""
    a = selected.agg(
        F.count("*").alias("selected"), (F.count_if(F.length("poem_text") > max_source_chars) if max_source_chars else F.lit(0).cast("bigint")).alias("oversized"),
        (F.count_if("metadata_conflict") if "metadata_conflict" in selected.columns else F.lit(0).cast("bigint")).alias("conflicts"),
    )
    b = records.agg(F.count("*").alias("generated"), F.count_if(F.col("validation_status") == "passed_after_repair").alias("repaired"))
    c = failures.agg(F.count("*").alias("failed"))
    one = F.lit(1)
    both = a.join(b, one == one).join(c, one == one)  # three rows of one
    return both.withColumn("complete", F.col("failed") == 0)


def manifest(task_type: str, selected: DataFrame, records: DataFrame, failures: DataFrame, max_source_chars: int | None = None, **more) -> dict:
    """The manifest of a run: totals, and counts by value of every dimension there is."""
    out = {"task_type": task_type} | totals(selected, records, failures, max_source_chars).first().asDict()
    for rows in (records, failures):
        for r in counters(rows).collect():  # as many rows as there are values of the fixed dimensions
            out.setdefault(f"{r.dim}_counts", {})[r.value] = r.n
    return out | more


def publish(records: DataFrame, path: str) -> bool:
    """The records in the order of work, replacing what was published while the run went on."""
    tasks = int(records.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    order = ["work_order", "record_id"]
    return files.write_records(records.repartitionByRange(tasks, *order).sortWithinPartitions(*order), path)


def owner(folder: str) -> str | None:
    """The task a folder belongs to: by its manifest, else by the first line of its log; None if it is free."""
    manifest_path, log_path = os.path.join(folder, "manifest.json"), os.path.join(folder, "events.jsonl")
    if os.path.exists(manifest_path):
        return files.read_document(manifest_path).get("task_type")
    if os.path.exists(log_path):
        return next((e.get("task_type") for e in files.read_events(log_path)), None)
    return None


def claim(folder: str, task_type: str) -> None:
    """Refuse a folder that another task has written to."""
    other = owner(folder)
    if other not in (None, task_type):
        raise ValueError(f"{folder} holds {other}, not {task_type}")

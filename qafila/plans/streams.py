"""Streams over request_events and file round trips."""

from __future__ import annotations

from pyspark.sql import functions as F

from qafila.plans import telemetry as M
from qafila.runtime import scratch_path, table
from qafila.sources import files
from qafila.streaming import folds


def _events(spark, d):
    """request_events as a stream of its files, with proper timestamps."""
    path = f"{d}/request_events.parquet"
    schema = spark.read.parquet(path).schema
    raw = folds.tail(spark, path if _is_folder(spark, path) else f"{d}/request_events*", schema)
    return raw.withColumns({"ts": F.col("ts").cast("timestamp"), "arrived_at": F.col("arrived_at").cast("timestamp")})


def _is_folder(spark, path):
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark._jsc.hadoopConfiguration()).getFileStatus(where).isDirectory()


def stream_progress(spark, d):
    return folds.drain(folds.progress(_events(spark, d), "endpoint_id", "status"), "complete", "progress")


def stream_windows(spark, d):
    """The windows that the watermark has closed; later ones are not told yet."""
    rows = folds.drain(folds.windows(_events(spark, d), "ts", "1 day", "10 days", "request_kind"), "append", "windows")
    return rows.select(F.col("window_start").cast("date").cast("string").alias("day"), "request_kind", "n")


def stream_checkpoint_replay(spark, d):
    events = _events(spark, d)  # an event delivered twice has one seq, so the fold takes it once
    ok, kind = F.col("status") == "ok", F.col("request_kind")
    event = F.when(~ok, "sample_failure").when(kind.isin("mcq", "reconstruction"), "sample_success").otherwise("other")
    fingerprint = F.when(F.col("settings_id") % 4 != 0, F.concat(F.lit("fp"), (F.col("settings_id") % 3).cast("string")))
    log = events.select("sample_id", F.col("event_id").alias("seq"), event.alias("event"), fingerprint.alias("fingerprint"), F.concat_ws(":", "status", kind).alias("error"))
    rows = folds.drain(folds.replay(log), "update", "replay")
    last = rows.groupBy("sample_id").agg(F.max_by(F.struct("seq", "fingerprint", "done", "error"), F.struct("batch")).alias("x")).select("sample_id", "x.*")
    return last.filter("seq >= 0")


def stream_stage_replay(spark, d):
    """The chunks that may be resumed, from the log as a stream."""
    e = _events(spark, d).filter("sample_id is not null and status = 'ok' and request_kind in ('instruction', 'reasoning')")
    event = F.when(F.col("request_kind") == "instruction", "instruction_success").otherwise("reasoning_chunk_success")
    fingerprint = F.when(F.col("settings_id") % 4 != 0, F.concat(F.lit("fp"), (F.col("settings_id") % 3).cast("string")))
    log = e.select("sample_id", F.col("event_id").alias("seq"), event.alias("event"), fingerprint.alias("fingerprint"), ((F.col("event_id") % 4) * 3).cast("int").alias("start_offset"))
    rows = folds.drain(folds.stages(log), "update", "stages")
    last = rows.groupBy("sample_id").agg(F.max_by("chunks", "batch").alias("chunks"))
    return last.select("sample_id", F.explode("chunks").alias("c")).select("sample_id", "c.start_offset", "c.fingerprint", "c.seq")


def parquet_round_trip(spark, d):
    """The poem table whole: arrays, nulls and timestamps, and as many rows as there are."""
    path = scratch_path(spark, "roundtrip")
    files.write_records(table(spark, d, "poem_records"), path)
    back = spark.read.parquet(path)
    joined = lambda c: F.array_join(F.col(c).cast("array<string>"), "|").alias(c)
    shown = {"source_row_indices": joined("source_row_indices"), "source_urls": joined("source_urls"), "verses": joined("verses"), "loaded_at": F.col("loaded_at").cast("string").alias("loaded_at")}
    return back.select(*(shown.get(c, F.col(c)) for c in back.columns))


def jsonl_round_trip(spark, d):
    path = scratch_path(spark, "jsonl")
    rows = M.once(spark, d).select("event_id", "sample_id", "endpoint_id", "status", "finish_reason")
    files.write_jsonl(rows, path)
    back = files.read_jsonl(spark, path, "event_id bigint, sample_id string, endpoint_id string, status string, finish_reason string", numbered=True)
    return files.require_readable(back)


def jsonl_lines(spark, d):
    """The lines a JSON-lines sink writes, nulls included."""
    return files.as_json_lines(M.once(spark, d).select("event_id", "endpoint_id", "status"))


QUERIES = {f.__name__: f for f in (stream_progress, stream_windows, stream_checkpoint_replay, stream_stage_replay, parquet_round_trip, jsonl_round_trip, jsonl_lines)}

SQL = {
    "stream_progress": "SELECT endpoint_id, status, count(*) AS n, CAST(sum(completion_tokens) AS BIGINT) AS tokens FROM request_events GROUP BY 1, 2",
    "stream_windows": "SELECT CAST(CAST(ts AS DATE) AS VARCHAR) AS day, request_kind, count(*) AS n FROM request_events WHERE date_trunc('day', ts) + INTERVAL 1 DAY <= (SELECT max(ts) - INTERVAL 10 DAY FROM request_events) GROUP BY 1, 2",
    "stream_checkpoint_replay": f"""WITH {M.LOG}, s AS (SELECT sample_id, x.s AS seq, x.fp AS fingerprint, true AS done, NULL AS error FROM won),
        f AS (SELECT sample_id, max(seq) AS seq, NULL AS fingerprint, false AS done, arg_max(error, seq) AS error FROM l WHERE event = 'sample_failure' AND sample_id NOT IN (SELECT sample_id FROM won) GROUP BY 1)
        SELECT * FROM s UNION ALL SELECT * FROM f""",
    "stream_stage_replay": M.SQL["resume_chunks"],
    "parquet_round_trip": "SELECT * REPLACE (array_to_string(source_row_indices, '|') AS source_row_indices, array_to_string(source_urls, '|') AS source_urls, array_to_string(verses, '|') AS verses, CAST(loaded_at AS VARCHAR) AS loaded_at) FROM poem_records",
    "jsonl_round_trip": f"WITH {M.ONCE} SELECT event_id, sample_id, endpoint_id, status, finish_reason FROM e",
    "jsonl_lines": f"""WITH {M.ONCE} SELECT '{{"event_id":' || event_id || ',"endpoint_id":' || coalesce('"' || endpoint_id || '"', 'null') || ',"status":"' || status || '"}}' AS value FROM e""",
}

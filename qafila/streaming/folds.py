"""Logs tailed as streams. Each stream ends in the same rows as its batch twin over the same input.

Sinks are idempotent: a micro-batch that is repeated after a failure replaces what its first try wrote.
"""

from __future__ import annotations

import json
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from qafila.runtime import scratch_path


def tail(spark: SparkSession, folder: str, schema, files_per_batch: int | None = None) -> DataFrame:
    """New Parquet files of a folder as a stream."""
    reader = spark.readStream.schema(schema)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.parquet(folder)


def drain(stream: DataFrame, mode: str, label: str) -> DataFrame:
    """Run a stream over what is there and give back its sink.

    complete: the last micro-batch replaces all; update and append: each micro-batch is a folder of its own.
    """
    spark = stream.sparkSession
    out, state = scratch_path(spark, f"{label}-out"), scratch_path(spark, f"{label}-state")

    def write(batch: DataFrame, batch_id: int) -> None:
        where = out if mode == "complete" else f"{out}/batch={batch_id}"
        batch.write.mode("overwrite").parquet(where)

    query = stream.writeStream.outputMode(mode).option("checkpointLocation", state).trigger(availableNow=True).foreachBatch(write).start()
    query.awaitTermination()
    return spark.read.parquet(out)


def progress(events: DataFrame, *keys: str) -> DataFrame:
    """Running counts by key."""
    return events.groupBy(*keys).agg(F.count("*").alias("n"), F.sum("completion_tokens").alias("tokens"))


def windows(events: DataFrame, time: str, width: str, late: str, *keys: str) -> DataFrame:
    """Tumbling event-time windows for append mode: a window is told once the watermark has passed it, and rows that come
    later still are dropped."""
    return events.withWatermark(time, late).groupBy(F.window(time, width).alias("w"), *keys).agg(F.count("*").alias("n")).select(F.col("w.start").alias("window_start"), *keys, "n")


def once(events: DataFrame, key: str, time: str, late: str) -> DataFrame:
    """The first delivery of each event; state is kept for the watermark only."""
    return events.withWatermark(time, late).dropDuplicatesWithinWatermark([key])


_STATE = "seq long, fingerprint string, done boolean, error string"
_OUT = "sample_id string, seq long, fingerprint string, done boolean, error string"


def replay(log: DataFrame) -> DataFrame:
    """Last success or last failure of every sample as state; one updated row per sample and micro-batch."""

    def fold(key: tuple, parts: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        seq, fingerprint, done, error = state.get if state.exists else (-1, None, False, None)
        for part in parts:
            for s, event, f, e in part.sort_values("seq")[["seq", "event", "fingerprint", "error"]].itertuples(index=False):
                if event == "sample_success" and (not done or s > seq):
                    seq, fingerprint, done, error = s, f if isinstance(f, str) else None, True, None
                elif event == "sample_failure" and not done and s > seq:
                    seq, error = s, e
        state.update((int(seq), fingerprint, bool(done), error))
        yield pd.DataFrame({"sample_id": [key[0]], "seq": [seq], "fingerprint": [fingerprint], "done": [done], "error": [error]})

    return log.groupBy("sample_id").applyInPandasWithState(fold, _OUT, _STATE, "update", GroupStateTimeout.NoTimeout)


_CHUNKS = "array<struct<start_offset:int,fingerprint:string,seq:bigint>>"


def stages(log: DataFrame) -> DataFrame:
    """The stages of every sample as state: the last instruction and the last chunk of each offset. A chunk older than an
    instruction with another fingerprint is void. One updated row per sample and micro-batch: sample_id, chunks.

    What decides is the order of seq, not of arrival: the state keeps of each instruction fingerprint the last seq.
    """

    def fold(key: tuple, parts: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        said, chunks = json.loads(state.get[0]) if state.exists else ([], [])
        said, chunks = {f: s for f, s in said}, {o: (s, f) for o, s, f in chunks}
        for part in parts:
            for seq, event, fingerprint, offset in zip(*(part[c].tolist() for c in ("seq", "event", "fingerprint", "start_offset")), strict=True):
                fingerprint = fingerprint if isinstance(fingerprint, str) else None
                if event == "instruction_success":
                    said[fingerprint] = max(seq, said.get(fingerprint, seq))
                elif event == "reasoning_chunk_success" and seq > chunks.get(offset, (-1, None))[0]:
                    chunks[offset] = (seq, fingerprint)
        state.update((json.dumps([list(said.items()), [(o, *c) for o, c in chunks.items()]]),))
        live = [(o, f, s) for o, (s, f) in sorted(chunks.items()) if not any(at > s and other != f for other, at in said.items())]
        yield pd.DataFrame({"sample_id": [key[0]], "chunks": [[{"start_offset": o, "fingerprint": f, "seq": s} for o, f, s in live]]})

    return log.groupBy("sample_id").applyInPandasWithState(fold, f"sample_id string, chunks {_CHUNKS}", "stages string", "update", GroupStateTimeout.NoTimeout)

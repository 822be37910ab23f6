"""File sources and sinks."""

from __future__ import annotations

import hashlib
import json
import os

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F


def read_splits(spark: SparkSession, paths: dict[str, str]) -> DataFrame:
    """One Parquet file or folder per split, told apart by a split column; columns missing in some are null there."""
    out = None
    for name, path in paths.items():
        part = spark.read.parquet(path).withColumn("split", F.lit(name))
        out = part if out is None else out.unionByName(part, allowMissingColumns=True)
    if out is None:
        raise ValueError("no splits")
    return out


def write_records(df: DataFrame, path: str) -> bool:
    """Parquet, written only if there is a record; says whether.

    The plan runs once: it is written beside the place, looked at there, and moved or taken away.
    """
    spark, aside = df.sparkSession, f"{path.rstrip('/')}.new"
    df.write.mode("overwrite").parquet(aside)
    some = not spark.read.schema(df.schema).parquet(aside).isEmpty()
    target, source = (spark._jvm.org.apache.hadoop.fs.Path(x) for x in (path, aside))
    system = target.getFileSystem(spark._jsc.hadoopConfiguration())
    if some:
        system.delete(target, True)
        system.rename(source, target)
    else:
        system.delete(source, True)
    return some


def as_json_lines(df: DataFrame) -> DataFrame:
    return df.select(F.to_json(F.struct(*df.columns), {"ignoreNullFields": "false"}).alias("value"))


def write_jsonl(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """One JSON object a line, nulls written; mode append adds files beside those there."""
    as_json_lines(df).write.mode(mode).text(path)


def numbered_lines(spark: SparkSession, path: str) -> DataFrame:
    """value, line_no: the lines of text files with their 1-based place in their file.

    A file is read in blocks: lines are counted within a block in the order they are read, and offset by the lines of
    the blocks before, of which there is one row each.
    """
    lines = spark.read.text(path).select("value", "_metadata.file_path", "_metadata.file_block_start", F.monotonically_increasing_id().alias("_at"))
    file, block = ["file_path"], ["file_path", "file_block_start"]
    blocks = lines.groupBy(*block).agg(F.min("_at").alias("_first"), F.count("*").alias("_n"))
    before = Window.partitionBy(*file).orderBy("file_block_start").rowsBetween(Window.unboundedPreceding, -1)
    blocks = blocks.withColumn("_before", F.coalesce(F.sum("_n").over(before), F.lit(0)))
    return lines.join(blocks, block).select("value", (F.col("_at") - F.col("_first") + F.col("_before") + 1).alias("line_no"))


def read_jsonl(spark: SparkSession, path: str, schema: str, numbered: bool = False) -> DataFrame:
    """The objects of JSON lines; blank lines are skipped, unreadable ones come with bad = true and, if asked for, their
    line number (which costs a second look at the files)."""
    lines = numbered_lines(spark, path) if numbered else spark.read.text(path).withColumn("line_no", F.lit(None).cast("bigint"))
    bad = F.try_parse_json("value").isNull()
    parsed = lines.filter(F.trim("value") != "").select(F.from_json("value", schema).alias("x"), bad.alias("bad"), "value", "line_no")
    return parsed.select("x.*", "bad", F.when(F.col("bad"), F.col("value")).alias("bad_line"), F.when(F.col("bad"), F.col("line_no")).alias("bad_line_no"))


def require_readable(log: DataFrame) -> DataFrame:
    """The rows of read_jsonl; an unreadable line raises when the plan runs, with its number if that is known."""
    where = F.coalesce(F.concat(F.lit(" in line "), F.col("bad_line_no").cast("string")), F.lit(""))
    message = F.concat(F.lit("Not a JSON object"), where, F.lit(": "), F.col("bad_line"))
    return log.filter(F.when(F.col("bad"), F.raise_error(message).cast("boolean")).otherwise(F.lit(True))).drop("bad", "bad_line", "bad_line_no")


def write_document(value: dict, path: str) -> None:
    """A small driver-side report: indented, with a trailing newline, replaced in one step."""
    with open(f"{path}.new", "w", encoding="utf-8") as f:
        json.dump(value, f, ensure_ascii=False, indent=2)
        f.write("\n")
    os.replace(f"{path}.new", path)


def read_document(path: str) -> dict:
    with open(path, encoding="utf-8") as f:
        return json.load(f)


def digest(value: object) -> str:
    """SHA-256 over canonical JSON: sorted keys, no spaces."""
    return hashlib.sha256(json.dumps(value, ensure_ascii=False, sort_keys=True, separators=(",", ":")).encode()).hexdigest()


def fingerprint(path: str, block: int = 1 << 20) -> str:
    """SHA-256 of a file's bytes; of a folder over its sorted (name, digest) pairs."""
    if os.path.isdir(path):
        names = sorted(n for n in os.listdir(path) if not n.startswith(("_", ".")))
        return digest([[n, fingerprint(os.path.join(path, n), block)] for n in names])
    h = hashlib.sha256()
    with open(path, "rb") as f:
        while part := f.read(block):
            h.update(part)
    return h.hexdigest()


def read_env(path: str) -> dict[str, str]:
    """KEY=value lines of an environment file; blank lines and # comments are skipped, quotes around a value taken off."""
    out = {}
    with open(path, encoding="utf-8") as f:
        for line in f:
            key, equals, value = line.strip().removeprefix("export ").partition("=")
            if equals and not key.startswith("#"):
                out[key.strip()] = value.strip().strip("'\"")
    return out


def endpoints_from_env(env: dict[str, str], prefix: str = "ENDPOINT") -> list[dict]:
    """One plain endpoint (PREFIX_URL) or several numbered ones (PREFIX_1_URL ..), never both; URLs must be http(s)."""
    plain = env.get(f"{prefix}_URL")
    numbered = {}
    for key, url in env.items():
        parts = key.split("_")
        if len(parts) == 3 and parts[0] == prefix and parts[1].isdigit() and parts[2] == "URL":
            numbered[int(parts[1])] = url
    if plain and numbered:
        raise ValueError("plain and numbered endpoints are mixed")
    urls = {1: plain} if plain else numbered
    if not urls:
        raise ValueError("no endpoint")
    if sorted(urls) != list(range(1, len(urls) + 1)):
        raise ValueError("endpoint numbers must run from 1 without a gap")
    for n, url in urls.items():
        if not url.startswith(("http://", "https://")):
            raise ValueError(f"endpoint {n} is no URL")
    return [
        {"endpoint_id": f"endpoint_{n}", "url": urls[n], "api_key": _of(env, prefix, n, "KEY"), "model": _of(env, prefix, n, "MODEL"), "max_concurrency": _positive(env.get(f"{prefix}_{n}_MAX", env.get(f"{prefix}_MAX", "8")))} for n in sorted(urls)
    ]


def _of(env: dict[str, str], prefix: str, n: int, what: str) -> str | None:
    """The endpoint's own setting, else the one for all."""
    return env.get(f"{prefix}_{n}_{what}", env.get(f"{prefix}_{what}")) or None


def append_event(event: dict, path: str, version: int | None = 3) -> None:
    """One JSON line added to a driver-side log and flushed; version None leaves it without one, as old logs are."""
    row = event if version is None else {"checkpoint_version": version} | event
    with open(path, "a", encoding="utf-8") as f:
        f.write(json.dumps(row, ensure_ascii=False) + "\n")
        f.flush()
        os.fsync(f.fileno())


def read_events(path: str) -> list[dict]:
    """The events of a driver-side log; blank lines are skipped, an unreadable one raises with its 1-based number."""
    out = []
    with open(path, encoding="utf-8") as f:
        for n, line in enumerate(f, 1):
            if line.strip():
                try:
                    out.append(json.loads(line))
                except json.JSONDecodeError as e:
                    raise ValueError(f"{path}: not a JSON object in line {n}") from e
    return out


def _positive(text: str) -> int:
    n = int(text)
    if n < 1:
        raise ValueError(f"must be at least 1: {n}")
    return n

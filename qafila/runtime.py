"""Session, table and lineage helpers shared by every operator."""

from __future__ import annotations

import atexit
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def build_session(master: str | None = "local[8]", shuffle: int = 8, app: str = "qafila") -> SparkSession:
    """A local session with the settings the engine is tested under; with no master the one of the launcher, whose
    settings then hold."""
    common = {"spark.sql.adaptive.enabled": "true", "spark.sql.session.timeZone": "UTC", "spark.sql.execution.arrow.pyspark.enabled": "true"}
    if master is None:
        builder = SparkSession.builder.appName(app)
        for key, value in common.items():
            builder = builder.config(key, value)
        return builder.getOrCreate()
    return (
        SparkSession.builder.master(master)
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(shuffle))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.driver.memory", "12g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors share: the session's spark.checkpoint.dir.

    Only in local mode, where one machine is all there is, a temporary folder is made and set if none is named; a cluster
    that names none is refused.
    """
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not named:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        named = tempfile.mkdtemp(prefix="qafila-")
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(named)
    return named


def scratch_path(spark: SparkSession, label: str) -> str:
    """A new path in the shared folder, removed when the application ends."""
    path = f"{shared_dir(spark).rstrip('/')}/{label}-{uuid.uuid4().hex}"
    _SCRATCH.append((spark, path))
    return path


_SCRATCH: list[tuple[SparkSession, str]] = []


@atexit.register
def _clear() -> None:
    for spark, path in _SCRATCH:
        try:
            where = spark._jvm.org.apache.hadoop.fs.Path(path)
            where.getFileSystem(spark._jsc.hadoopConfiguration()).delete(where, True)
        except Exception:  # the session has gone; the folder is its owner's to clear
            return


def cut(df: DataFrame) -> DataFrame:
    """Write to the shared folder and read back: cuts the lineage and survives lost executors."""
    path = scratch_path(df.sparkSession, "cut")
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def spread(df: DataFrame) -> DataFrame:
    """Spread the rows of a small or unsplittable input before heavy per-row work.

    Only for plans without a shuffle. An input that already has a task for every second core is left as it is, so at
    scale nothing is shuffled.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df if df.rdd.getNumPartitions() * 2 >= cores else df.repartition(2 * cores)


#: Rows of a few short columns that may be broadcast (about 20 MB).
BROADCAST_ROWS = 200_000


def small(df: DataFrame, rows: int = BROADCAST_ROWS) -> DataFrame:
    """df with a broadcast hint if a count shows it is small; else as it is, for a shuffle join that AQE may split."""
    return F.broadcast(df) if df.limit(rows + 1).count() <= rows else df

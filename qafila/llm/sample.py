"""Problem 1: a sample that is the same on every run and keeps its members as data grows.

Method: permanent random numbers. Every identifier gets a uniform number when it is first seen, by an anti-join insert
into a persisted registry; a sample is everyone whose number lies under a threshold. As numbers are never reassigned and
thresholds of a registry never fall (the highest is stored with it; `select` alone reads under any), members stay members. The number is a hash of the identifier and a seed, so two registries, two
layouts or two reruns agree without having met.

Scale: the registry is partitioned by a prefix of the number, so selecting under a threshold prunes to the folders below
it, and an insert is one shuffle on the identifier after a map-side distinct. Rows that repeat an identifier are
collapsed before the shuffle, however many there are.

Defined results: null identifiers are not sampled; repeated rows count once; the share 0 selects nobody, 1 everybody; an
empty input leaves the registry as it is. Extra columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from qafila.runtime import scratch_path

SEED = "qafila-prn-1"
#: Folders of the registry: the first bits of the number.
FOLDERS = 16
_SCALE = float(1 << 52)


def permanent_number(sample_id: Column, seed: str = SEED) -> Column:
    """Uniform in [0, 1): the first 52 bits of SHA-256 of seed and identifier."""
    return F.conv(F.substring(F.sha2(F.concat(F.lit(seed + ":"), sample_id), 256), 1, 13), 16, 10).cast("bigint").cast("double") / F.lit(_SCALE)


class Registry:
    """The persisted numbers, one row per identifier: sample_id, prn, first_seen."""

    SCHEMA = "sample_id string, prn double, first_seen timestamp, folder int"

    def __init__(self, spark: SparkSession, path: str | None = None, seed: str = SEED) -> None:
        self.spark, self.seed = spark, seed
        self.path = path or scratch_path(spark, "prn")

    def _stored(self) -> DataFrame | None:
        """The rows as written; None before the first insert."""
        try:
            return self.spark.read.schema(self.SCHEMA).parquet(self.path)
        except Exception as e:
            if "PATH_NOT_FOUND" not in str(e):
                raise
            return None

    def read(self) -> DataFrame:
        """All numbers; of an identifier written twice by a job that was repeated, the first sight."""
        stored = self._stored()
        if stored is None:
            return self.spark.createDataFrame([], self.SCHEMA)
        return stored.groupBy("sample_id", "prn", "folder").agg(F.min("first_seen").alias("first_seen"))

    def threshold(self, asked: float = 0.0) -> float:
        """The highest share ever asked for, kept beside the numbers so that a member is never dropped."""
        path = f"{self.path}/_threshold"
        try:
            highest = self.spark.read.schema("share double").parquet(path).agg(F.max("share")).first()[0] or 0.0
        except Exception as e:  # none yet
            if "PATH_NOT_FOUND" not in str(e):
                raise
            highest = 0.0
        if asked > highest:
            self.spark.range(1).select(F.lit(float(asked)).alias("share")).coalesce(1).write.mode("append").parquet(path)
        return max(asked, highest)

    def insert(self, records: DataFrame) -> None:
        """Register identifiers not seen before by an anti-join; those seen keep their number and first sight.

        The folder follows from the identifier and is a key of the join too. New rows are placed by folder before they are
        written, so that a load adds about a file a task, not a file for each folder and task.
        """
        asked = records.filter(F.col("sample_id").isNotNull()).groupBy("sample_id").agg(F.min("loaded_at").cast("timestamp").alias("first_seen"))
        asked = asked.withColumn("prn", permanent_number(F.col("sample_id"), self.seed)).withColumn("folder", F.floor(F.col("prn") * FOLDERS).cast("int"))
        known = self._stored()
        fresh = asked if known is None else asked.join(known.select("sample_id", "folder"), ["sample_id", "folder"], "left_anti")
        tasks = int(self.spark.conf.get("spark.sql.shuffle.partitions"))
        placed = fresh.repartition(tasks, "folder", F.pmod(F.xxhash64("sample_id"), F.lit(max(1, tasks // FOLDERS))))
        placed.select("sample_id", "prn", "first_seen", "folder").write.mode("append").partitionBy("folder").parquet(self.path)

    def select(self, share: float) -> DataFrame:
        """sample_id, prn, first_seen of everyone under the threshold."""
        return (
            self.read()
            .filter((F.col("folder") <= int(share * FOLDERS)) & (F.col("prn") < F.lit(float(share))))
            .select("sample_id", "prn", "first_seen")
        )

    def sample(self, share: float) -> DataFrame:
        """The same under the highest threshold asked for so far, so a lower share drops nobody."""
        return self.select(self.threshold(float(share)))


def growing_sample(loads: DataFrame | list[DataFrame], share: float, seed: str = SEED, path: str | None = None) -> DataFrame:
    """Register the loads in turn and return the sample of the given share, or of the highest asked of this registry
    before. Records that came with an earlier load keep their number and first sight."""
    loads = loads if isinstance(loads, list) else [loads]
    registry = Registry(loads[0].sparkSession, path, seed)
    for records in loads:
        registry.insert(records.select("sample_id", "loaded_at"))
    return registry.sample(share)

"""Which poems and work items a run takes, and in what order."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from qafila.functions import seeded
from qafila.functions import text as X

# Work-item templates with their metadata field, in order.
TEMPLATES = (("poem_meter", "meter_name"), ("poem_theme", "poem_theme"), ("poem_title", "poem_title"))


def latest(df: DataFrame, key: str, *order: str) -> DataFrame:
    """The last row of each key by the order columns. Aggregates before the shuffle, so a hot key costs no more."""
    rest = [c for c in df.columns if c != key]
    return df.groupBy(key).agg(F.max_by(F.struct(*rest), F.struct(*order)).alias("x")).select(key, "x.*")


def measured(poems: DataFrame) -> DataFrame:
    return poems.withColumns({"couplet_count": X.couplet_count(F.col("verses")), "poem_text": X.format_poem(F.col("verses"))})


def cap_then_limit(poems: DataFrame, max_couplets: int | None, limit: int | None, order: str) -> DataFrame:
    """The cap comes first, then the first `limit` poems in source order; expansion comes after both."""
    kept = poems if max_couplets is None else poems.filter(F.col("couplet_count") <= max_couplets)
    return kept if limit is None else kept.orderBy(order).limit(limit)


def work_items(poems: DataFrame) -> DataFrame:
    """One row per poem and template whose metadata is not blank: work_id, sample_id, template_no, template_id, ground_truth."""
    each = F.array(*(F.struct(F.lit(i).alias("template_no"), F.lit(t).alias("template_id"), X.blank_to_null(F.col(c)).alias("ground_truth")) for i, (t, c) in enumerate(TEMPLATES)))
    return (
        poems.select("sample_id", F.explode(each).alias("x"))
        .select("sample_id", "x.*")
        .filter("ground_truth is not null")
        .withColumn("work_id", F.concat_ws(":", F.lit("mcq"), "sample_id", "template_id"))
    )


def with_prompt(items: DataFrame) -> DataFrame:
    """The seeded prompt of each work item, 1-based."""
    return items.withColumn("prompt_no", seeded.prompt_index("sample_id", "template_id") + 1)


def packed_chunks(lines: Column, max_chars: int) -> Column:
    """Couplets packed greedily into chunks of at most max_chars, newlines counted; a longer couplet stands alone."""
    empty = F.struct(F.array().cast("array<string>").alias("done"), F.lit(None).cast("string").alias("open"))

    def step(acc: Column, line: Column) -> Column:
        fits = F.length(acc["open"]) + 1 + F.length(line) <= max_chars
        return (
            F.when(acc["open"].isNull(), F.struct(acc["done"].alias("done"), line.alias("open")))
            .when(fits, F.struct(acc["done"].alias("done"), F.concat(acc["open"], F.lit("\n"), line).alias("open")))
            .otherwise(F.struct(F.concat(acc["done"], F.array(acc["open"])).alias("done"), line.alias("open")))
        )

    return F.aggregate(lines, empty, step, lambda acc: F.when(acc["open"].isNull(), acc["done"]).otherwise(F.concat(acc["done"], F.array(acc["open"]))))


def couplet_chunks(lines: Column, offset: Column, n: int = 3) -> Column:
    """The couplets from offset on, n at a time: start (from 0), couplets, the neighbours before and after, first."""
    starts = F.when(offset < F.size(lines), F.sequence(offset, F.size(lines) - 1, F.lit(n))).otherwise(F.array().cast("array<int>"))
    return F.transform(
        starts,
        lambda s: F.struct(s.alias("start"), F.slice(lines, s + 1, F.lit(n)).alias("couplets"), F.when(s > 0, F.get(lines, s - 1)).alias("before"), F.get(lines, s + n).alias("after"), (s == offset).alias("first")),
    )


def estimate(poems: DataFrame, max_source_chars: int, chunk_chars: int) -> DataFrame:
    """Requests each of the four tasks needs for a poem; the completion estimate knows the seeded prefix."""
    lines = X.couplets(F.col("verses"))
    n = F.col("couplet_count")
    chunks = F.when(F.length("poem_text") > max_source_chars, F.size(packed_chunks(lines, chunk_chars))).otherwise(0)
    return poems.select(
        "sample_id",
        (2 + 2 * F.ceil(n / 3) + chunks).cast("bigint").alias("generation"),
        F.when(n >= 2, 2 + 2 * F.ceil((n - seeded.prefix_length("sample_id", "couplet_count")) / 3)).cast("bigint").alias("completion"),
        F.lit(2).cast("bigint").alias("mcq"),
        F.lit(2).cast("bigint").alias("reconstruction"),
    )


def ranked(items: DataFrame, cost: str, key: str) -> DataFrame:
    """Schedule rank, shortest first, key on ties.

    Ranks are made inside range partitions and offset by the rows before them, so no task holds all rows.
    """
    tasks = int(items.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    from qafila.runtime import cut

    placed = cut(items.repartitionByRange(tasks, cost, key).withColumn("_task", F.spark_partition_id()))
    before = (
        placed.groupBy("_task")
        .agg(F.count("*").alias("n"))
        .select("_task", F.coalesce(F.sum("n").over(Window.orderBy("_task").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("_before"))
    )
    local = F.row_number().over(Window.partitionBy("_task").orderBy(cost, key))
    return placed.withColumn("_r", local).join(F.broadcast(before), "_task").withColumn("rank", F.col("_r") + F.col("_before")).drop("_task", "_r", "_before")


def first_per_stratum(df: DataFrame, stratum: str, quotas: dict[str, int], *order: Column | str) -> DataFrame:
    """The first rows of each stratum by the order, as many as its quota; stratum_rank tells the place.

    Strata are few and may be huge: rows are cut to the largest quota per input task before the window, which then sees
    at most quota rows of each task.
    """
    largest = max(quotas.values(), default=0)
    local = Window.partitionBy(stratum, "_p").orderBy(*order)
    w = Window.partitionBy(stratum).orderBy(*order)
    quota = F.element_at(F.create_map(*(F.lit(x) for kv in quotas.items() for x in kv)), F.col(stratum))
    tasks = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    kept = df.filter(F.col(stratum).isin(*quotas)).withColumn("_p", F.pmod(F.xxhash64(*[c for c in df.columns if c != stratum]), F.lit(tasks)))
    kept = kept.withColumn("_r", F.row_number().over(local)).filter(F.col("_r") <= largest).drop("_r", "_p")
    return kept.withColumn("stratum_rank", F.row_number().over(w)).filter(F.col("stratum_rank") <= quota)


def shortfalls(df: DataFrame, stratum: str, quotas: dict[str, int]) -> DataFrame:
    """Strata with fewer rows than their quota."""
    spark = df.sparkSession
    wanted = spark.createDataFrame(list(quotas.items()), f"{stratum} string, quota int")
    have = df.groupBy(stratum).agg(F.count("*").alias("have"))
    return wanted.join(have, stratum, "left").select(stratum, "quota", F.coalesce("have", F.lit(0)).alias("have")).filter("have < quota")

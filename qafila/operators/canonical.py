"""Exact deduplication of poems with majority meter, best metadata and full provenance.

One shuffle for the poem groups: votes and best rows are aggregated per poem and meter before it, so a poem that holds a
third of all rows arrives as a few partial rows. Its sources, which no aggregation shrinks, are a table of rows; gathered
into arrays only where these are asked for. Poems are keyed by a hash of an injective encoding of the verse list, so the
lists themselves never are shuffle keys and lists that only join to the same text stay apart.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from qafila.functions import text as X

FIELDS = ("poem_title", "poem_theme", "poet_name", "poem_url")


def populated() -> Column:
    """How many of the four metadata fields are filled; an empty string is not, white space is."""
    return sum((F.when(F.col(f) != "", 1).otherwise(0) for f in FIELDS), F.lit(0))


def invalid_rows(source: DataFrame) -> DataFrame:
    """row_idx, reason of the rows a load must refuse."""
    size = F.coalesce(F.size("poem_verses"), F.lit(-1))
    reason = F.when(size < 1, "no verses").when(size % 2 == 1, "odd verses").when(F.col("poem_meter").isNull(), "no meter")
    return source.select("row_idx", reason.alias("reason")).filter("reason is not null")


def valid_rows(source: DataFrame, on_invalid: str = "error") -> DataFrame:
    """The rows that can be loaded; on_invalid is error (raise on the first, by row) or drop."""
    good = X.valid_verses(F.col("poem_verses")) & F.col("poem_meter").isNotNull()
    if on_invalid == "error":
        bad = F.raise_error(F.concat(F.lit("Source row "), F.col("row_idx").cast("string"), F.lit(" has an invalid poem_verses list or meter")))
        return source.filter(F.when(good, F.lit(True)).otherwise(bad.cast("boolean")))
    return source.filter(good)


def meter_votes(source: DataFrame, arrays: bool = True) -> DataFrame:
    """poem key, poem_meter and what each meter's rows bring: votes, best row, first row, and if asked for the sources.

    Map-side combined: but for the sources a meter of a poem is one partial row a task, however many its copies."""
    row = F.struct(populated().alias("filled"), (-F.col("row_idx")).alias("back"), *FIELDS)
    return (
        source.withColumn("key", F.sha2(F.to_json(F.struct("poem_verses")), 256))
        .groupBy("key", "poem_meter")
        .agg(
            F.count("*").alias("votes"),
            F.max(row).alias("best"),
            F.min("row_idx").alias("first_row"),
            F.first("poem_verses").alias("verses"),
            *([F.collect_list(F.struct("row_idx", "poem_url")).alias("sources")] if arrays else []),
        )
    )


def sources(source: DataFrame, on_invalid: str = "error") -> DataFrame:
    """sample_id, row_idx, poem_url: what each poem was made from, a row a source. No poem's sources are gathered."""
    rows = valid_rows(source.select("row_idx", "poem_url", "poem_meter", "poem_verses"), on_invalid)
    return rows.select(X.poem_hash(F.col("poem_verses")).alias("sample_id"), "row_idx", "poem_url")


def canonicalize(source: DataFrame, on_tie: str = "error", on_invalid: str = "error", on_meter: str = "error", arrays: bool = True) -> DataFrame:
    """One row per distinct verse list.

    on_tie: error (raise, naming the first rows), flag (keep the smallest of the tied meters and set tied).
    on_meter: error (raise for an id out of range), flag (a null name). arrays=False leaves out source_row_indices and
    source_urls, which grow with a poem's copies; first_row is there in either case, and sources() has them as rows.
    Ties in metadata go to the first row. source_urls drops null and empty URLs and keeps first-seen order.
    """
    rows = valid_rows(source.select("row_idx", *FIELDS, "poem_meter", "poem_verses"), on_invalid)
    gathered = [F.array_sort(F.flatten(F.collect_list("sources"))).alias("sources")] if arrays else []
    voted = (
        meter_votes(rows, arrays)
        .groupBy("key")
        .agg(F.collect_list(F.struct("votes", "poem_meter", "best")).alias("v"), F.first("verses").alias("verses"), F.min("first_row").alias("first_row"), *gathered)
    )
    top = F.array_max(F.transform("v", lambda x: x.votes))
    winners = F.array_sort(F.transform(F.filter("v", lambda x: x.votes == top), lambda x: x.poem_meter))
    voted = voted.withColumns({"winners": winners, "meter_id": F.get(winners, F.lit(0)).cast("int"), "tied": F.size(winners) > 1})
    if on_tie == "error":
        message = F.concat(F.lit("Tied meters of the poem first seen in row "), F.col("first_row").cast("string"))
        voted = voted.withColumn("tied", F.when(F.col("tied"), F.raise_error(message).cast("boolean")).otherwise(F.lit(False)))
    best = F.array_max(F.transform("v", lambda x: F.struct((x.poem_meter == F.col("meter_id")).cast("int").alias("match"), x.best.alias("b"))))
    lists = []
    if arrays:
        urls = F.filter(F.transform("sources", lambda s: s.poem_url), lambda u: u.isNotNull() & (u != ""))
        lists = [F.transform("sources", lambda s: s.row_idx).alias("source_row_indices"), F.array_distinct(urls).alias("source_urls")]
    name = X.raise_unknown_meter if on_meter == "error" else X.meter_name
    return voted.withColumn("b", best["b"]).select(
        X.poem_hash(F.col("verses")).alias("sample_id"),
        *lists,
        "first_row",
        F.coalesce("b.poet_name", F.lit("")).alias("poet_name"),
        F.col("b.poem_title").alias("poem_title"),
        F.col("b.poem_theme").alias("poem_theme"),
        "meter_id",
        name(F.col("meter_id")).alias("meter_name"),
        "verses",
        (F.size("v") > 1).alias("metadata_conflict"),
        "tied",
    )


def in_source_order(poems: DataFrame) -> DataFrame:
    return poems.orderBy("first_row")

"""Subsets of a raw corpus by metadata, authors and biography text."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# The labels of the source data.
MODERN_ERA = "العصر الحديث"
FORMAL_LABELS = ("فصيح", "فصحى")


def is_classical() -> Column:
    """Era known and not modern, language formal; null language is no."""
    return F.coalesce(F.col("poet_era").isNotNull() & (F.col("poet_era") != MODERN_ERA) & F.col("poem_language_type").isin(*FORMAL_LABELS), F.lit(False))


def word_pattern(terms: list[str]) -> str:
    """Any of the terms between non-letters."""
    import re

    return "(?<![ء-ي])(?:" + "|".join(re.escape(t) for t in sorted(terms, key=len, reverse=True)) + ")(?![ء-ي])"


def authors_at(source: DataFrame, location: str) -> DataFrame:
    """poet_name of every author with a row at the location (null authors are none)."""
    return source.filter((F.col("poet_location") == location) & F.col("poet_name").isNotNull()).select("poet_name").distinct()


def first_texts(source: DataFrame, covered: DataFrame, text: str) -> DataFrame:
    """row_idx, poet_name, text: the first non-null text of each author not covered; null authors are one author."""
    left = source.filter(F.col(text).isNotNull()).join(covered, "poet_name", "left_anti")
    first = left.groupBy("poet_name").agg(F.min_by(F.struct("row_idx", text), "row_idx").alias("x"))
    return first.select("x.row_idx", "poet_name", F.col(f"x.{text}").alias(text))


def trigger_terms(texts: DataFrame, text: str, terms: list[str]) -> DataFrame:
    """The texts that name a term, with the sorted distinct terms found."""
    pattern = word_pattern(terms)
    found = F.array_sort(F.array_distinct(F.regexp_extract_all(F.col(text), F.lit(pattern), F.lit(0))))
    return texts.filter(F.col(text).rlike(pattern)).withColumn("trigger_terms", found)


def flagged(source: DataFrame, authors: DataFrame) -> DataFrame:
    """All rows with is_classic, is_author and is_merged: subsets, overlap and union come from one scan."""
    marked = authors.select("poet_name").distinct().withColumn("is_author", F.lit(True))
    return (
        source.join(marked, "poet_name", "left")
        .withColumns({"is_classic": is_classical(), "is_author": F.coalesce("is_author", F.lit(False))})
        .withColumn("is_merged", F.col("is_classic") | F.col("is_author"))
    )


def distribution(df: DataFrame, column: str) -> DataFrame:
    """column, n, percent of all rows, rounded half to even at two places."""
    counts = df.groupBy(column).agg(F.count("*").alias("n"))
    return counts.withColumn("percent", F.bround(F.col("n") * 100 / F.sum("n").over(Window.partitionBy()), 2))
